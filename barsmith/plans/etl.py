"""The monthly ETL as one composed Spark job (JOB-1..6).

extract   landed payloads -> raw rows, reject rows        (sources.payloads)
transform normalize (strict/lenient) -> monthly variation (operators)
load      INSERT OVERWRITE of the batch's partition       (sinks.tables)
quality   duplicate report over the loaded batch          (operators.quality)

One ``process_date`` drives both the batch that is replaced and the value
stamped on its rows; NULL or absent means today in the session time zone.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.functions.columns import process_date_literal
from barsmith.operators.analytics import with_variation
from barsmith.operators.quality import duplicate_check
from barsmith.operators.transforms import normalize
from barsmith.schema import BAR_COLUMNS, PROCESS_DATE
from barsmith.session import shared_dir
from barsmith.sinks.tables import create_bars_table, reload_process_date, table_buckets
from barsmith.sources.payloads import explode_series, read_payloads, split_payloads

REJECT_DDL = "symbol STRING, reason STRING, value STRING, process_date STRING"


@dataclass(frozen=True)
class RunReport:
    process_date: str
    table: str
    loaded_rows: int
    distinct_rows: int
    has_duplicates: bool
    rejected_documents: int | None


def resolve_process_date(spark: SparkSession, param=None, clock: Column | None = None) -> str:
    """The run's process date: the parameter, else today (JOB-2, SCL-5).

    ``clock``: what today is, as a date or timestamp expression; the session's current date if not given."""
    d = process_date_literal(param)
    if d is None:
        today = F.current_date() if clock is None else clock
        d = spark.range(1).select(F.date_format(today, "yyyy-MM-dd").alias("d")).first()["d"]
    return d


def transform(raw: DataFrame, strict: bool = True, partitions: int | None = None, spread: bool = False) -> DataFrame:
    """Raw text rows -> typed bars with ``monthly_variation`` (JOB-4, JOB-5).

    Landed input may repeat documents, so copies are collapsed before the
    window and expanded after it (duplicates are kept, as they were read).
    ``partitions``: the target table's bucket count; ``spread``: for symbols
    with very many distinct rows (see ``with_variation``).
    """
    return raw.transform(normalize, strict=strict).transform(
        with_variation, collapse_copies=True, partitions=partitions, spread=spread)


def load_batch(raw: DataFrame, table: str, process_date: str, *, strict: bool = True,
               buckets: int | None = None, spread: bool = False) -> None:
    """Create the table if missing, then replace one batch with ``raw``
    transformed (JOB-3).  The variation's exchange takes the table's
    bucket count, so the write needs no further shuffle.
    """
    n = prepare_table(raw.sparkSession, table, buckets)
    reload_process_date(transform(raw, strict, partitions=n, spread=spread), table, process_date, clustered=True)


def prepare_table(spark: SparkSession, table: str, buckets: int | None = None) -> int | None:
    """Create the table if missing; return its bucket count."""
    create_bars_table(spark, table, buckets)
    return table_buckets(spark, table)


def quality_report(spark: SparkSession, table: str, process_date: str) -> DataFrame:
    """Duplicate report over one loaded batch (reads that partition only).

    Only the bar columns count: copies of a bar differ in the computed
    variation, so including it would hide them.
    """
    batch = spark.table(table).where(F.col(PROCESS_DATE) == process_date)
    return duplicate_check(batch.select(*BAR_COLUMNS))


def run(
    spark: SparkSession,
    payload_path: str | list[str],
    table: str,
    process_date=None,
    *,
    strict: bool = True,
    wholetext: bool = False,
    symbols: Iterable[str] | None = None,
    buckets: int | None,
    reject_table: str | None = None,
    fail_if_empty: bool = True,
    spread: bool = False,
) -> RunReport:
    """Extract -> transform -> load one batch (JOB-1).

    ``buckets``: bucket count of a table created here -- and so the number of
    write tasks; choose it for the table's volume (about 128 MB a bucket and
    batch).  An existing table keeps its own.  ``spread``: symbols may hold very
    many distinct rows (see ``with_variation``).  Rejects are written before a
    run without any accepted document raises.
    """
    d = resolve_process_date(spark, process_date)
    symbols = None if symbols is None else list(symbols)
    shared_dir(spark)
    # One JSON pass: both outputs are taken from the parsed documents.  Rejects
    # are never filtered by symbol, so only a run without them may prune the scan.
    parsed = read_payloads(spark, payload_path, wholetext=wholetext,
                           symbols=None if reject_table else symbols).checkpoint()
    accepted, rejected = split_payloads(parsed, symbols)

    n_rejected = None
    if reject_table is not None:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {reject_table} ({REJECT_DDL}) USING parquet "
            f"PARTITIONED BY ({PROCESS_DATE})"
        )
        reload_process_date(rejected, reject_table, d)
        n_rejected = spark.table(reject_table).where(F.col(PROCESS_DATE) == d).count()
    if fail_if_empty and not accepted.take(1):
        raise ValueError(f"no accepted payload under {payload_path}; batch {d} left as it was")

    load_batch(explode_series(accepted), table, d, strict=strict, buckets=buckets, spread=spread)
    q = quality_report(spark, table, d).first()
    return RunReport(d, table, int(q["total_rows"]), int(q["distinct_rows"]),
                     bool(q["has_duplicates"]), n_rejected)
