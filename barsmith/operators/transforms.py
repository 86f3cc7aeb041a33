"""Projections and set operations (PRJ-1..8, SET-1..2, SRC-4, JOB-5)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.functions.columns import as_date, as_double
from barsmith.schema import MEASURES


def cluster_by(df: DataFrame, column: str, partitions: int | None = None) -> DataFrame:
    """Hash-partition ``df`` by ``column`` into ``partitions`` partitions.

    Rows hashed this way line up with Spark's buckets of the same count.
    When the count equals the session's shuffle partition count, the
    exchange is left to AQE, which may merge neighbouring small partitions:
    every key still lands in exactly one task, so bucket files stay one per
    bucket while tiny tasks disappear.  Other counts are fixed.
    """
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if partitions is None or partitions == default:
        return df.repartition(column)
    return df.repartition(partitions, column)


def expand_copies(df: DataFrame, count: str, chunk_rows: int = 100_000) -> DataFrame:
    """Each row as often as its ``count`` column says, without that column.

    A row becomes descriptors of at most ``chunk_rows`` copies each, spread
    over a fixed number of tasks by row and chunk, so no task emits one hot
    row's copies alone."""
    cols = [c for c in df.columns if c != count]
    chunk, i = "__barsmith_chunk", "__barsmith_i"
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = df.withColumn(chunk, F.explode(F.sequence(F.lit(0), F.floor((F.col(count) - 1) / chunk_rows))))
    size = F.least(F.lit(chunk_rows), F.col(count) - F.col(chunk) * chunk_rows)
    return (chunks.repartition(n, *cols, chunk)
            .select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), size)).alias(i)).select(*cols))


def tag(df: DataFrame, column: str, value) -> DataFrame:
    """Add a constant column (PRJ-1)."""
    return df.withColumn(column, F.lit(value))


def normalize(raw: DataFrame, strict: bool = True, keep_pos: bool = False) -> DataFrame:
    """F2 text rows -> F3 typed bars (PRJ-3..5, SCL-1..2).

    strict: a malformed number or date fails the job; lenient: it becomes NULL.
    """
    cols = [F.col("symbol"), as_date("date_from", strict).alias("date_from")]
    cols += [as_double(m, strict).alias(m) for m in MEASURES]
    if keep_pos:
        cols.append(F.col("pos"))
    return raw.select(*cols)


def union_all(frames: Iterable[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Bag union matched by column name (SET-1, SET-2).

    Columns missing from a frame are NULL when ``allow_missing``; frames with
    the same columns in another order line up by name, never by position.
    """
    frames = list(frames)
    if not frames:
        raise ValueError("union_all needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def wide_to_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    name_col: str = "field",
    value_col: str = "value",
) -> DataFrame:
    """Columns -> rows (SRC-4): one output row per input row and value column."""
    return df.unpivot(list(ids), list(values), name_col, value_col)


def long_to_wide(
    df: DataFrame,
    ids: Sequence[str],
    names: Sequence[str],
    name_col: str = "field",
    value_col: str = "value",
) -> DataFrame:
    """Rows -> columns, inverse of :func:`wide_to_long`.

    One conditional aggregate per given name: a single exchange, and partial
    aggregation brings the rows of one key together before it.
    """
    return df.groupBy(*ids).agg(
        *[F.max(F.when(F.col(name_col) == n, F.col(value_col))).alias(n) for n in names])
