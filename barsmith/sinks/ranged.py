"""Range layout with per-file bounds (SRT-2): symbol-and-date reads that open only the files they need.

Buckets spread symbols by hash, so a read of one symbol opens a bucket of many,
and a symbol with a large share of the rows fills one file.  ``write_ranged``
deals rows by range of (symbol, date) instead, with Spark's sampled boundaries:
files of even size, a hot symbol over as many as it needs, each sorted.  Beside
them it writes a small table of every file's first and last key, built by one
aggregation over the key columns.  ``read_ranged`` picks files from that table
before it plans the scan; Parquet's own row-group statistics prune inside them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files named one by one in a read; a read that needs more scans the folder with its predicate.
NAMED_FILES = 1000


def write_ranged(df: DataFrame, path: str, symbol: str = "symbol", date: str = "date_from", files: int | None = None) -> str:
    """Write ``df`` to a new folder in ``files`` ranges (default: the shuffle partitions); returns the folder."""
    spark = df.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, symbol, date).sortWithinPartitions(symbol, date)
     .write.parquet(f"{path}/data"))
    key = F.struct(F.col(symbol).alias("symbol"), F.col(date).alias("date"))
    bounds = spark.read.schema(df.schema).parquet(f"{path}/data").groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("rows"))
    bounds.coalesce(1).write.parquet(f"{path}/bounds")
    return path


def ranged_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, first, last, rows``; first and last are (symbol, date) structs, NULL before all values."""
    return spark.read.parquet(f"{path}/bounds")


def _holds(symbol, start, end) -> Column:
    """Files whose range of keys meets the symbol's rows between the dates (both included)."""
    def key(date):
        return F.struct(F.lit(symbol).alias("symbol"), F.lit(date).cast("date").alias("date"))

    low = key(start)  # without a start, NULL: before all dates
    ok = F.col("last") >= low
    return ok & (F.col("first") <= key(end) if end is not None else F.col("first.symbol").isNull() | (F.col("first.symbol") <= F.lit(symbol)))


def read_ranged(spark: SparkSession, path: str, symbol: str, start: str | None = None, end: str | None = None,
                column: str = "symbol", date: str = "date_from") -> DataFrame:
    """One symbol's rows, from ``start`` to ``end`` (``yyyy-MM-dd``, both included)."""
    named = [r["file"] for r in ranged_files(spark, path).where(_holds(symbol, start, end)).select("file").take(NAMED_FILES + 1)]
    whole = spark.read.parquet(f"{path}/data")
    df = whole.limit(0) if not named else whole if len(named) > NAMED_FILES else spark.read.schema(whole.schema).parquet(*named)
    df = df.where(F.col(column) == F.lit(symbol))
    if start is not None:
        df = df.where(F.col(date) >= F.lit(start).cast("date"))
    return df if end is None else df.where(F.col(date) <= F.lit(end).cast("date"))


__all__ = ["NAMED_FILES", "ranged_files", "read_ranged", "write_ranged"]
