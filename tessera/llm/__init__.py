"""Operators for large training-data pipelines (text, pages, vectors).

Nothing outside this subpackage imports it. ``tessera.llm.queries`` holds the
registered queries and their DuckDB SQL.
"""
