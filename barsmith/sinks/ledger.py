"""Appends that can be run again (SNK-2): a ledger of loads and an anti-join on row identity.

A load is named by the values of some columns, its *batch* (a process date, or
a date and a source).  ``append_once`` adds to the table only those rows that
its batch does not hold yet, so that a load that was killed half-way, or is run
twice, ends as if it had run once.  Identity is the whole row, copies counted:
a load that brings a row three times leaves three of it.

The ledger, a table of its own, records what each finished load held: its row
count and fingerprints, and how many rows the batch had afterwards.  A load
found there with the same content, whose batch still has that many rows, is
not compared again.  The ledger is written last and only saves work: without
its entry the anti-join finds the rows themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.operators.transforms import expand_copies
from barsmith.schema import PROCESS_DATE
from barsmith.sinks.tables import append_table

LEDGER_DDL = ("target STRING, batch STRING, rows BIGINT, print_a DECIMAL(38,0), print_b DECIMAL(38,0), "
              "batch_rows BIGINT")
_N, _M = "__barsmith_n", "__barsmith_m"


@dataclass(frozen=True)
class AppendReport:
    rows: int      # of the load
    added: int     # to the table
    compared: bool  # False: the ledger knew this load


def create_ledger(spark: SparkSession, name: str) -> None:
    """CREATE TABLE IF NOT EXISTS for the ledger."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({LEDGER_DDL}) USING parquet")


def _in_batch(batch: dict[str, str]) -> Column:
    """The batch's rows; on partition columns this prunes to the batch's folders."""
    where = F.lit(True)
    for c, v in batch.items():
        where = where & (F.col(c) == F.lit(v))
    return where


def _batch_name(batch: dict[str, str]) -> str:
    return "/".join(f"{k}={batch[k]}" for k in sorted(batch))


def _contents(df: DataFrame) -> tuple[int, int, int]:
    """(rows, two order-free fingerprints that count copies)."""
    total = lambda h: F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    r = df.agg(F.count(F.lit(1)), total(F.xxhash64(*df.columns)), total(F.xxhash64(F.lit("b"), *reversed(df.columns)))).first()
    return int(r[0]), int(r[1]), int(r[2])


def missing_rows(df: DataFrame, held: DataFrame) -> DataFrame:
    """The rows of ``df`` that ``held`` (same columns) lacks, as often as they are lacking.

    Both sides are counted by whole row first (map-side combine, so a row of
    many copies is one row before the join); the join compares all columns,
    NULL equal to NULL."""
    cols = df.columns
    wanted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(_N)).alias("w")
    have = held.select(*cols).groupBy(*cols).agg(F.count(F.lit(1)).alias(_M)).alias("h")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"w.`{c}`").eqNullSafe(F.col(f"h.`{c}`"))
    lacking = wanted.join(have, same, "left").select(
        *[F.col(f"w.`{c}`").alias(c) for c in cols], (F.col(_N) - F.coalesce(F.col(_M), F.lit(0))).alias(_N)).where(F.col(_N) > 0)
    return expand_copies(lacking, _N)


def append_once(df: DataFrame, name: str, batch: dict[str, str] | str, ledger: str) -> AppendReport:
    """Append the load ``df`` (the table's columns without the batch's) to the table, once.

    ``batch``: the load's columns and values, or a process date.  Rows that
    another run of the same load has already brought are not added again, and
    rows that it lacks are.  The rows are written by one job whose committer
    publishes them together; if the driver dies while files are being
    published, the next run adds what is missing."""
    spark = df.sparkSession
    batch = {PROCESS_DATE: batch} if isinstance(batch, str) else batch
    cols = [c for c in spark.table(name).columns if c not in batch]
    df = df.select(*cols)
    create_ledger(spark, ledger)
    held = spark.table(name).where(_in_batch(batch))
    rows, a, b = _contents(df)
    known = spark.table(ledger).where((F.col("target") == name) & (F.col("batch") == _batch_name(batch))
                                      & (F.col("rows") == rows) & (F.col("print_a") == F.lit(str(a)).cast("decimal(38,0)"))
                                      & (F.col("print_b") == F.lit(str(b)).cast("decimal(38,0)")))
    before = held.count()
    if known.where(F.col("batch_rows") == before).take(1):
        return AppendReport(rows, 0, False)
    tagged = missing_rows(df, held)
    for c, v in batch.items():
        tagged = tagged.withColumn(c, F.lit(v))
    append_table(tagged, name)
    after = spark.table(name).where(_in_batch(batch)).count()
    entry = spark.createDataFrame([(name, _batch_name(batch), rows, str(a), str(b), after)],
                                  "target string, batch string, rows long, a string, b string, batch_rows long")
    entry.select("target", "batch", "rows", F.col("a").cast("decimal(38,0)").alias("print_a"),
                 F.col("b").cast("decimal(38,0)").alias("print_b"), "batch_rows").write.insertInto(ledger)
    return AppendReport(rows, after - before, True)


__all__ = ["AppendReport", "append_once", "create_ledger", "missing_rows"]
