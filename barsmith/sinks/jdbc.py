"""JDBC writes (SNK-3, SNK-4) through Spark's built-in ``jdbc`` sink.

Overwrite uses ``truncate=true`` so the target keeps its DDL (keys, types)
instead of being dropped and recreated.  Each task commits its own rows, so
a JDBC load is atomic only per partition: load a staging table and swap it
in on the database side when all-or-nothing matters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_write_options(
    url: str,
    table: str,
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    truncate: bool = True,
    batchsize: int | None = 10_000,
    num_partitions: int | None = None,
    isolation_level: str | None = None,
) -> dict[str, str]:
    opts = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "truncate": "true" if truncate else "false",
        "batchsize": batchsize,
        "numPartitions": num_partitions,
        "isolationLevel": isolation_level,
    }
    return {k: str(v) for k, v in opts.items() if v is not None}


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **kwargs) -> None:
    if mode not in ("append", "overwrite", "error", "errorifexists", "ignore"):
        raise ValueError(f"unsupported mode {mode!r}")
    df.write.format("jdbc").options(**jdbc_write_options(url, table, **kwargs)).mode(mode).save()
