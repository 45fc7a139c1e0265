"""barsmith: daily price-bar analytics on Spark DataFrames.

Layout: ``sources`` (staged payloads, NDJSON, Parquet/table sinks, test-data
bars), ``operators`` (feature and view operators), ``functions`` (column
expressions), ``plans`` (chunked series, ranking, the batch job), ``streaming``
(incremental ingestion of staged files).
"""

__version__ = "0.1.0"
