"""Plans: analytics queries, the end-to-end pipeline, the query registry."""
