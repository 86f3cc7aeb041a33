"""Registered queries of repeatable and incremental loads, with their DuckDB oracles.

As in ``catalogue``, every query reads the whole given tables and writes only
to fresh paths and tables under the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.functions.columns import pct_change
from barsmith.operators.analytics import previous_over_ranges
from barsmith.operators.transforms import normalize
from barsmith.plans.catalogue import (
    _BARS, _BEFORE, _VARIATION, BUCKETS, D1, D2, SPLIT_DATE, Query, _bars, _before_split, _from_split, _loaded_table, _read,
    _two_batches, _varied_bars, _with,
)
from barsmith.plans.fixtures import land_payloads
from barsmith.plans.states import merge_states, refresh_states
from barsmith.schema import MEASURES, PAYLOAD_FIELDS, PROCESS_DATE, SERIES_KEY
from barsmith.session import scratch_path, shared_dir, work_table
from barsmith.sinks.ledger import append_once
from barsmith.sinks.ranged import read_ranged, write_ranged
from barsmith.sinks.tables import reload_process_date
from barsmith.sinks.versions import vacuum_versions, write_version
from barsmith.sources.drift import drift_report, landed_fields, read_documents_as_variants
from barsmith.sources.payloads import explode_series, split_payloads
from barsmith.sources.tables import profile
from barsmith.streaming.intake import intake, read_intake

BIG_VOLUME = 50
ONE_SYMBOL, LAST_DATE = "S000001", "1999-12-31"
LINE_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice")


def q_versioned_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches; a reload of D1 that dies before it is published, and one of D2 that is.

    The table shows D1 as first loaded and the new D2 (SNK-6, SNK-7)."""
    table, buckets = _loaded_table(spark, "versioned")
    bars = _varied_bars(spark, sf_dir, buckets)
    _two_batches(table, bars)
    write_version(bars.where(_before_split() & (F.col("volume") > BIG_VOLUME)), table, {PROCESS_DATE: D1})
    reload_process_date(bars.where(_from_split() & (F.col("volume") > BIG_VOLUME)), table, D2)
    vacuum_versions(spark, table, {PROCESS_DATE: D2}, keep=0, older_than_hours=0)
    return spark.table(table)


def q_hot_series_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines as two long series (by line status): each line's price against the one before it (WIN-2, JOB-4).

    Either series holds about half of all rows, and no task holds a series."""
    lines = _read(spark, sf_dir, "lineitem").select("l_linestatus", *LINE_ORDER)
    lagged = previous_over_ranges(lines, "l_extendedprice", "prev_price", "l_linestatus", LINE_ORDER)
    return lagged.withColumn("price_change", pct_change(F.col("l_extendedprice"), F.col("prev_price")))


def q_append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that arrives in part, then whole, then again; and a second batch: every row once (SNK-2)."""
    table, buckets = _loaded_table(spark, "once")
    ledger = work_table(spark, "ledger")
    bars = _varied_bars(spark, sf_dir, buckets)
    append_once(bars.where(_before_split()), table, D1, ledger)
    for _ in range(2):
        append_once(bars, table, D1, ledger)
    append_once(bars.where(_from_split()), table, D2, ledger)
    return spark.table(table)


def q_incremental_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing that grows between two runs: each takes the files that are new; together, all bars (SRC-1, JOB-3)."""
    shared_dir(spark)
    bars = _bars(spark, sf_dir).checkpoint()
    landing, target = scratch_path(spark, "growing"), scratch_path(spark, "intake")
    for day, part in (("day1", bars.where(_before_split())), ("day2", bars.where(_from_split()))):
        land_payloads(part, f"{landing}/{day}")
        intake(spark, landing, target)
    accepted, _ = split_payloads(read_intake(spark, target))
    return explode_series(accepted).transform(normalize)


def q_merged_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol states of two batches, merged, after one batch was reloaded with fewer rows (AGG-4, AGG-5)."""
    table, buckets = _loaded_table(spark, "stated")
    states = work_table(spark, "states")
    bars = _varied_bars(spark, sf_dir, buckets)
    _two_batches(table, bars)
    for d in (D1, D2):
        refresh_states(spark, table, states, d)
    reload_process_date(bars.where(_from_split() & (F.col("volume") > BIG_VOLUME)), table, D2)
    refresh_states(spark, table, states, D2)
    return merge_states(spark.table(states))


def _land_variant(bars: DataFrame, path: str, fields, entry) -> str:
    """JSON Lines of one document per symbol and year, entries as ``entry`` builds them."""
    entries = F.map_from_entries(F.collect_list(F.struct(F.date_format("date_from", "yyyy-MM-dd").alias("k"), entry.alias("v"))))
    docs = bars.where(F.col("date_from").isNotNull()).groupBy("symbol", F.year("date_from").alias("y")).agg(entries.alias(SERIES_KEY))
    docs.select(F.to_json(F.struct("symbol", SERIES_KEY, *fields)).alias("value")).write.text(path)
    return path


def q_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of two landings (before and from SPLIT_DATE): the later one drops the volume, adds a note to
    each document and sends the close as a number (SRC-5, SET-2)."""
    shared_dir(spark)
    bars = _bars(spark, sf_dir).checkpoint()
    text = {m: F.col(m).cast("decimal(18,4)").cast("string").alias(f) for m, f in zip(MEASURES, PAYLOAD_FIELDS)}
    whole = F.struct(*text.values())
    changed = F.struct(*[F.col(m).alias(dict(zip(MEASURES, PAYLOAD_FIELDS))[m]) if m == "close" else t
                         for m, t in text.items() if m != "volume"])
    landings = {
        "early": _land_variant(bars.where(_before_split()), scratch_path(spark, "early"), (), whole),
        "late": _land_variant(bars.where(_from_split()), scratch_path(spark, "late"), (F.lit("x").alias("Note"),), changed)}
    return drift_report(landed_fields(read_documents_as_variants(spark, landings)))


def q_ranged_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bars in a range layout; one symbol's bars of some years, read from the files that hold them (SRT-2, FLT-1)."""
    path = write_ranged(_bars(spark, sf_dir), scratch_path(spark, "ranged"))
    return read_ranged(spark, path, ONE_SYMBOL, SPLIT_DATE, LAST_DATE)


def q_loaded_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loaded table inspected: its columns, types and NULLs (JOB-6)."""
    table, buckets = _loaded_table(spark, "profiled")
    _two_batches(table, _varied_bars(spark, sf_dir, buckets))
    return profile(spark.table(table)).drop("least", "greatest")  # their text differs between engines


QUERIES: dict[str, Query] = {
    "versioned_reload": q_versioned_reload,
    "hot_series_lag": q_hot_series_lag,
    "append_once": q_append_once,
    "incremental_intake": q_incremental_intake,
    "merged_extremes": q_merged_extremes,
    "schema_drift": q_schema_drift,
    "ranged_read": q_ranged_read,
    "loaded_profile": q_loaded_profile,
}

_RELOADED = (f"loaded AS (SELECT *, '{D1}' AS process_date FROM varied WHERE {_BEFORE} "
             f"UNION ALL SELECT *, '{D2}' AS process_date FROM varied "
             f"WHERE date_from >= DATE '{SPLIT_DATE}' AND volume > {BIG_VOLUME})")


def _drift_sql() -> str:
    """Field counts follow from the bars: one document per symbol and year, one entry per bar."""
    n = "landings AS (SELECT CASE WHEN date_from < DATE '" + SPLIT_DATE + "' THEN 'early' ELSE 'late' END AS landing, " \
        "count(*) AS bars, count(DISTINCT (symbol, year(date_from))) AS docs FROM bars WHERE date_from IS NOT NULL GROUP BY 1)"
    row = "SELECT landing, '{}' AS level, '{}' AS field, '{}' AS status, {} AS type, {} AS occurrences FROM landings{}"
    rows = [row.format("document", "symbol", "expected", "'STRING'", "docs", ""),
            row.format("document", SERIES_KEY, "expected", "'OBJECT'", "docs", ""),
            row.format("document", "Note", "new", "'STRING'", "docs", " WHERE landing = 'late'")]
    for m, f in zip(MEASURES, PAYLOAD_FIELDS):
        late = {"close": ("retyped", "'NUMBER'"), "volume": ("missing", "CAST(NULL AS VARCHAR)")}.get(m, ("expected", "'STRING'"))
        rows.append(row.format("entry", f, "expected", "'STRING'", "bars", " WHERE landing = 'early'"))
        rows.append(row.format("entry", f, *late, "bars", " WHERE landing = 'late'"))
    return _with(_BARS, n) + " UNION ALL ".join(rows)


def _profile_sql() -> str:
    both = (f"loaded AS (SELECT *, CASE WHEN {_BEFORE} THEN '{D1}' ELSE '{D2}' END AS process_date FROM varied)")
    columns = [("symbol", "string"), ("date_from", "date"), *[(m, "double") for m in MEASURES],
               ("monthly_variation", "double"), (PROCESS_DATE, "string")]
    rows = [f"SELECT {i} AS position, '{c}' AS col_name, '{t}' AS data_type, count({c}) AS non_null, "
            f"count(*) - count({c}) AS nulls FROM loaded" for i, (c, t) in enumerate(columns)]
    return _with(_BARS, _VARIATION, both) + " UNION ALL ".join(rows)


ORACLES: dict[str, str] = {
    "loaded_profile": _profile_sql(),
    "versioned_reload": _with(_BARS, _VARIATION, _RELOADED) + "SELECT * FROM loaded",
    "hot_series_lag": "SELECT l_linestatus, " + ", ".join(LINE_ORDER) + ", prev_price, "
    "(l_extendedprice - prev_price) / nullif(prev_price, 0) * 100 AS price_change FROM (SELECT *, "
    f"lag(l_extendedprice) OVER (PARTITION BY l_linestatus ORDER BY {', '.join(LINE_ORDER)}) AS prev_price FROM lineitem)",
    "append_once": _with(_BARS, _VARIATION)
    + f"SELECT *, '{D1}' AS process_date FROM varied UNION ALL SELECT *, '{D2}' AS process_date FROM varied "
    + f"WHERE date_from >= DATE '{SPLIT_DATE}'",
    "incremental_intake": _with(_BARS) + "SELECT * FROM bars",
    "merged_extremes": _with(
        _BARS, _VARIATION, _RELOADED,
        "hi AS (SELECT symbol, date_from AS max_date, close AS max_close, "
        "row_number() OVER (PARTITION BY symbol ORDER BY close DESC, date_from DESC) AS rn FROM loaded)",
        "lo AS (SELECT symbol, date_from AS min_date, close AS min_close, "
        "row_number() OVER (PARTITION BY symbol ORDER BY close, date_from DESC) AS rn FROM loaded)")
    + 'SELECT l.symbol, count(*) AS "rows", min(date_from) AS first_date, max(date_from) AS last_date, any_value(max_close) AS max_close, '
    "any_value(max_date) AS max_date, any_value(min_close) AS min_close, any_value(min_date) AS min_date "
    "FROM loaded l JOIN hi ON hi.symbol = l.symbol AND hi.rn = 1 JOIN lo ON lo.symbol = l.symbol AND lo.rn = 1 GROUP BY l.symbol",
    "schema_drift": _drift_sql(),
    "ranged_read": _with(_BARS)
    + f"SELECT * FROM bars WHERE symbol = '{ONE_SYMBOL}' AND date_from BETWEEN DATE '{SPLIT_DATE}' AND DATE '{LAST_DATE}'",
}
