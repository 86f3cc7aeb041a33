"""Catalog table management (SNK-1, SNK-2, SNK-5..7, SRT-2, FLT-2, PRJ-8).

The bars table is Parquet, partitioned by ``process_date`` (one partition per
load batch) and bucketed by ``symbol``, sorted by ``date_from`` inside each
bucket: a later per-symbol window reads it without an Exchange.
Writes are Spark jobs whose output committer publishes the files only when
the job succeeds, so a lost executor means a retried task, never half-written
files.  A reload writes a new version of its batch and then moves the
partition's location to it (``versions``): a job or a driver that dies at any
point leaves the batch that was there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barsmith.functions.columns import process_date_literal
from barsmith.operators.transforms import cluster_by
from barsmith.schema import LOADED_DDL, PROCESS_DATE
from barsmith.sinks.versions import publish_version, write_version


def _default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def create_bars_table(
    spark: SparkSession, name: str, buckets: int | None = None,
    ddl: str = LOADED_DDL, location: str | None = None, partitioned: bool = True,
) -> None:
    """CREATE TABLE IF NOT EXISTS; running it again changes nothing (SNK-1).

    Distributed by symbol, sorted by date.  ``partitioned=False`` with a
    ``ddl`` of the plain bar columns gives an append-only bars table (no
    process date), as loaded without the variation.
    """
    n = buckets or _default_buckets(spark)
    loc = f" LOCATION '{location}'" if location else ""
    parts = f"PARTITIONED BY ({PROCESS_DATE}) " if partitioned else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet "
        f"{parts}CLUSTERED BY (symbol) SORTED BY (date_from) "
        f"INTO {n} BUCKETS{loc}"
    )


def table_buckets(spark: SparkSession, name: str) -> int | None:
    """The bucket count of a catalog table, None when it is not bucketed."""
    rows = (spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
            .where("col_name = 'Num Buckets'").select("data_type").take(1))
    return int(rows[0][0]) if rows else None


def cluster_for_table(df: DataFrame, name: str, column: str = "symbol") -> DataFrame:
    """Hash-partition ``df`` by the bucket column into the table's bucket count.

    Every bucket then sits in exactly one write task (AQE may give a task
    several whole buckets), so each bucket is one file per partition;
    without it every task writes one file per bucket it touches.
    """
    n = table_buckets(df.sparkSession, name)
    return cluster_by(df, column, n) if n else df


def _in_table_order(spark: SparkSession, df: DataFrame, name: str,
                    exclude: tuple[str, ...] = ()) -> DataFrame:
    cols = [c for c in spark.table(name).columns if c not in exclude]
    return df.select(*cols)


def append_table(df: DataFrame, name: str, clustered: bool = False) -> None:
    """Append all rows; executors write in parallel (SNK-2, SNK-7).

    ``insertInto`` is positional, so columns are first put in table order.
    Rows are clustered by bucket first, unless ``clustered`` says that they
    already are.  Re-running appends the rows again.
    """
    spark = df.sparkSession
    out = _in_table_order(spark, df, name)
    (out if clustered else cluster_for_table(out, name)).write.insertInto(name)


def reload_process_date(df: DataFrame, name: str, process_date: str, clustered: bool = False) -> None:
    """Replace exactly one batch; other batches are untouched (SNK-6, SNK-7).

    The new batch is written as a version of its own, then the partition is
    pointed to it (see ``versions``).  A failed job or a driver killed before
    that leaves the old batch as it was; lost executors are retried inside the
    job, and re-running is idempotent.  A batch that turns out to be empty --
    its rows are counted while they are written -- is cleared instead.
    ``clustered`` as for :func:`append_table`.  Replaced versions stay until
    :func:`~barsmith.sinks.versions.vacuum_versions`.
    """
    d = process_date_literal(process_date)
    spark = df.sparkSession
    partition = {PROCESS_DATE: d}
    written = Observation()
    out = _in_table_order(spark, df, name, exclude=(PROCESS_DATE,))
    out = (out if clustered else cluster_for_table(out, name)).observe(written, F.count(F.lit(1)).alias("n"))
    folder = write_version(out, name, partition)
    if written.get["n"] == 0:
        clear_process_date(spark, name, d)
    else:
        publish_version(spark, name, partition, folder)


def clear_process_date(spark: SparkSession, name: str, process_date: str) -> None:
    """Remove one batch; a missing batch is not an error (SNK-5, FLT-2)."""
    d = process_date_literal(process_date)
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({PROCESS_DATE} = '{d}')")


def write_bucketed(df: DataFrame, name: str, buckets: int | None = None,
                   mode: str = "overwrite") -> None:
    """Save ``df`` as a table bucketed by symbol, sorted by date (SRT-2).

    Rows are first hash-partitioned into the bucket count (the same hash as
    bucketing), so every bucket is written by one task, as one file.
    """
    n = buckets or _default_buckets(df.sparkSession)
    (cluster_by(df, "symbol", n).write.format("parquet").mode(mode)
       .bucketBy(n, "symbol").sortBy("date_from").saveAsTable(name))


__all__ = [
    "append_table",
    "cluster_for_table",
    "table_buckets",
    "clear_process_date",
    "create_bars_table",
    "reload_process_date",
    "write_bucketed",
]
