"""tessera: a retail medallion pipeline and analytics pack on Spark.

Layers: ``sources`` (bronze landing, driver-table views, sinks),
``functions`` (column helpers), ``operators`` (conform, silver, gold,
sequencing, data quality), ``plans`` (analytics queries, the pipeline and
the query registry) and ``streaming`` (incremental ingestion).
Every operator is a function from DataFrames to a DataFrame.
"""

__version__ = "0.1.0"
