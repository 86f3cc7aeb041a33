"""Duplicate report and removal (AGG-1..3).

All three are aggregations, so map-side partial aggregation collapses a hot
group of identical rows inside each task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_check(df: DataFrame) -> DataFrame:
    """One row ``total_rows, distinct_rows, has_duplicates`` in one job.

    Full-row distinct with NULL equal to NULL (grouping semantics), which a
    multi-column ``count(DISTINCT a, b)`` would get wrong.
    """
    n = "__barsmith_copies"
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(n))
    total = F.coalesce(F.sum(n), F.lit(0)).cast("bigint")
    distinct = F.count(F.lit(1))
    return per_row.agg(total.alias("total_rows"), distinct.alias("distinct_rows")).withColumn(
        "has_duplicates", F.col("total_rows") != F.col("distinct_rows")
    )


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Distinct full rows (or first row per ``subset``) (AGG-2)."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per key, the row with the greatest ``order`` (ties: any one).

    An aggregate (``max_by``) rather than a ranking window, so a hot key is
    reduced map-side instead of landing whole in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    picked = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(picked).select(*keys, "__row.*").select(*df.columns)
