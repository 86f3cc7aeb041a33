"""Where jobs may write: the cluster's shared checkpoint folder.

Library code never builds a session or picks a master; the caller passes
one.  Intermediate tables and landed test payloads go under the folder the
cluster names in ``spark.checkpoint.dir`` (shared storage on a cluster).
Only when that setting is absent -- local tests -- do we fall back to a
folder under the session's warehouse directory and register it as the
context's checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

WORK_DATABASE = "barsmith_work"


def _context(spark: SparkSession):
    """The SparkContext, or None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # Connect sessions have no SparkContext
        return None


def shared_dir(spark: SparkSession) -> str:
    sc = _context(spark)
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        # Unset (local tests): a folder derived from the warehouse directory,
        # the same on every call.  spark.checkpoint.dir is a core setting that
        # cannot change at runtime; the context's checkpoint folder can.
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{shared_dir(spark)}/barsmith/{label}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch_path`` named and nothing reads any more."""
    if "/barsmith/" not in path:
        raise ValueError(f"not a scratch path: {path!r}")
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def work_table(spark: SparkSession, label: str) -> str:
    """A fresh table name in a database stored under the shared folder."""
    loc = f"{shared_dir(spark)}/barsmith/{WORK_DATABASE}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {WORK_DATABASE} LOCATION '{loc}'")
    return f"{WORK_DATABASE}.{label}_{uuid.uuid4().hex[:12]}"
