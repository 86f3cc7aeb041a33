"""Mergeable per-batch states of a loaded table (AGG-4, AGG-5).

Extremes and symbol sets over many batches are kept as one small state row per
batch and symbol instead of being recomputed from all bars: when a process date
is loaded or reloaded, only its own states are built and replaced, and the
answer over all batches merges states.  A state holds exactly what a merge
needs (the extreme closes with the dates that win their ties, rows, first and
last date), so merging equals a recomputation over all rows, whatever the order
of loads and reloads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.schema import PROCESS_DATE
from barsmith.sinks.tables import clear_process_date, reload_process_date

STATE_DDL = ("symbol STRING, rows BIGINT, first_date DATE, last_date DATE, max_close DOUBLE, max_date DATE, "
             f"min_close DOUBLE, min_date DATE, {PROCESS_DATE} STRING")


def symbol_states(df: DataFrame, value: str = "close", date: str = "date_from") -> DataFrame:
    """One state per symbol of ``df``; NULL and NaN values win no extreme, ties go to the latest date."""
    v = F.col(value)
    ok = v.isNotNull() & ~F.isnan(v)
    return df.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date"),
        F.max(F.when(ok, v)).alias("max_close"),
        F.max_by(F.col(date), F.when(ok, F.struct(v, F.col(date)))).alias("max_date"),
        F.min(F.when(ok, v)).alias("min_close"),
        F.min_by(F.col(date), F.when(ok, F.struct(v, -F.unix_date(F.col(date))))).alias("min_date"))


def merge_states(states: DataFrame) -> DataFrame:
    """The state of each symbol over all the batches of ``states``."""
    high = F.when(F.col("max_close").isNotNull(), F.struct("max_close", "max_date"))
    low = F.when(F.col("min_close").isNotNull(), F.struct("min_close", -F.unix_date("min_date")))
    return states.groupBy("symbol").agg(
        F.sum("rows").alias("rows"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        F.max("max_close").alias("max_close"), F.max_by("max_date", high).alias("max_date"),
        F.min("min_close").alias("min_close"), F.min_by("min_date", low).alias("min_date"))


def create_state_table(spark: SparkSession, name: str) -> None:
    """CREATE TABLE IF NOT EXISTS, one partition per process date."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({STATE_DDL}) USING parquet PARTITIONED BY ({PROCESS_DATE})")


def refresh_states(spark: SparkSession, table: str, states: str, process_date: str) -> None:
    """Build the states of one batch of ``table`` anew and replace those in ``states``.

    Reads that batch alone.  A batch that is gone clears its states."""
    create_state_table(spark, states)
    batch = spark.table(table).where(F.col(PROCESS_DATE) == process_date)
    reload_process_date(symbol_states(batch), states, process_date)


def drop_states(spark: SparkSession, states: str, process_date: str) -> None:
    """Forget a batch that was cleared; a missing one is not an error."""
    clear_process_date(spark, states, process_date)


__all__ = ["create_state_table", "drop_states", "merge_states", "refresh_states", "symbol_states"]
