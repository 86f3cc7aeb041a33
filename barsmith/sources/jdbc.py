"""JDBC reads (SRC-8) through Spark's built-in ``jdbc`` source.

Reads are parallel when a numeric/date ``partition_column`` with bounds is
given; a pushed subquery is passed as ``query`` (Spark wraps it itself).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_read_options(
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetchsize: int | None = None,
) -> dict[str, str]:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    if partition_column is not None and query is not None:
        raise ValueError("partition_column needs table, not query (Spark restriction)")
    if partition_column is not None and None in (lower_bound, upper_bound, num_partitions):
        raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
    opts = {
        "url": url,
        "dbtable": table,
        "query": query,
        "user": user,
        "password": password,
        "driver": driver,
        "partitionColumn": partition_column,
        "lowerBound": lower_bound,
        "upperBound": upper_bound,
        "numPartitions": num_partitions,
        "fetchsize": fetchsize,
    }
    return {k: str(v) for k, v in opts.items() if v is not None}


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(url, **kwargs)).load()
