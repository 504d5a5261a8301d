"""Independent DuckDB SQL for every registered query (the correctness oracle).

``views.py`` re-derives bronze->silver->gold from the driver tables as CTEs;
``queries.py`` has one SQL string per registered query.
"""
