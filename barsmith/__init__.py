"""barsmith: monthly OHLCV bar jobs written with Spark DataFrames.

Subpackages
-----------
sources    landed JSON payloads, JDBC reads, table previews
functions  column expressions (typed casts, variation, process date)
operators  DataFrame -> DataFrame transforms (normalize, union, quality,
           windows, extremes)
sinks      catalog tables (create, append, partition reload/clear,
           bucketed writes) and JDBC writes
plans      composed jobs (the ETL run) and the query catalogue
"""

__version__ = "0.1.0"
