"""Versioned batches: write whole files first, then move one pointer (SNK-6, SNK-7).

A partition's files lie in a folder of their own version,
``<table>/_versions/<partition>/<version>``.  Publishing a batch is one change of
the catalog: the partition's location.  Whoever is killed before it -- the
driver between writing and publishing included -- leaves the old batch readable
and, at worst, a folder nobody points to; readers see the old batch or the new
one, never a mixture or a gap.  Two loads of one batch each publish a whole
version and the later one stays.

Versions are named by time, so ``vacuum_versions`` can tell what was written
before the version in use.  It removes unused folders of a minimum age, which
spares loads that are still writing.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

VERSIONS = "_versions"


@dataclass(frozen=True)
class TableLayout:
    location: str
    buckets: int | None
    bucket_columns: tuple[str, ...]
    sort_columns: tuple[str, ...]


def table_layout(spark: SparkSession, name: str) -> TableLayout:
    """Where a catalog table lies and how its files are bucketed."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(
        "col_name IN ('Location', 'Num Buckets', 'Bucket Columns', 'Sort Columns')").take(4)
    told = {r["col_name"]: r["data_type"] for r in rows}

    def columns(key: str) -> tuple[str, ...]:
        return tuple(c.strip(" `") for c in told.get(key, "[]").strip("[]").split(",") if c.strip())

    n = told.get("Num Buckets")
    return TableLayout(told["Location"], int(n) if n else None, columns("Bucket Columns"), columns("Sort Columns"))


def partition_spec(partition: dict[str, str]) -> str:
    """``day = 'd', kind = 'k'``: a partition as SQL."""
    quoted = {k: str(v).replace("\\", "\\\\").replace("'", "\\'") for k, v in partition.items()}
    return ", ".join(f"`{k}` = '{v}'" for k, v in quoted.items())


def partition_location(spark: SparkSession, name: str, partition: dict[str, str]) -> str | None:
    """The folder a partition points to; None when there is no such partition."""
    spec = partition_spec(partition)
    if not spark.sql(f"SHOW PARTITIONS {name} PARTITION ({spec})").take(1):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({spec})").where("col_name = 'Location'").take(1)
    return rows[0]["data_type"]


def _folder(layout: TableLayout, partition: dict[str, str]) -> str:
    # values only name a folder here; the catalog holds the partition's real values
    name = ",".join(f"{k}={v}".replace("/", "%2F") for k, v in partition.items())
    return f"{layout.location.rstrip('/')}/{VERSIONS}/{name}"


def write_version(df: DataFrame, name: str, partition: dict[str, str]) -> str:
    """Write ``df`` (the table's columns without the partition's) as a new version; nobody reads it yet.

    Returns its folder.  The files are bucketed and sorted as the table says."""
    spark = df.sparkSession
    layout = table_layout(spark, name)
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    folder = f"{_folder(layout, partition)}/{version}"
    if layout.buckets is None:
        df.write.parquet(folder)
        return folder
    # only saveAsTable writes buckets: a table definition over the folder, dropped again; its files stay
    database = name.rsplit(".", 1)[0] + "." if "." in name else ""
    stage = f"{database}barsmith_stage_{version.replace('-', '_')}"
    writer = df.write.format("parquet").option("path", folder).bucketBy(layout.buckets, *layout.bucket_columns)
    if layout.sort_columns:
        writer = writer.sortBy(*layout.sort_columns)
    try:
        writer.saveAsTable(stage)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {stage}")
    return folder


def publish_version(spark: SparkSession, name: str, partition: dict[str, str], folder: str) -> None:
    """Point the partition to ``folder``: one change of the catalog, after which readers see the new files."""
    spec, where = partition_spec(partition), folder.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{where}'")
    spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{where}'")


def versions(spark: SparkSession, name: str, partition: dict[str, str]) -> list[str]:
    """The folders of a partition's versions, oldest first (published or not)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_folder(table_layout(spark, name), partition))
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(root):
        return []
    return sorted(s.getPath().toString() for s in store.listStatus(root) if s.isDirectory())


def vacuum_versions(spark: SparkSession, name: str, partition: dict[str, str], keep: int = 1,
                    older_than_hours: float = 24.0) -> list[str]:
    """Remove versions that the partition does not point to; returns the folders removed.

    The newest ``keep`` of them stay for readers that began earlier, and so do all younger than
    ``older_than_hours``, which a load may still be writing."""
    used = partition_location(spark, name, partition)
    short = lambda p: p.rstrip("/").rsplit("/", 1)[-1]
    others = [v for v in versions(spark, name, partition) if used is None or short(v) != short(used)]
    limit = time.time_ns() - int(older_than_hours * 3600e9)
    gone = [v for v in others[:max(len(others) - keep, 0)] if int(short(v).split("-")[1]) <= limit]
    for v in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(v)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone


__all__ = ["TableLayout", "partition_location", "partition_spec", "publish_version", "table_layout",
           "vacuum_versions", "versions", "write_version"]
