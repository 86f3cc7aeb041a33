"""Registered queries: ``(spark, sf_dir) -> DataFrame`` plus DuckDB oracles.

Every query reads the given tables under ``sf_dir`` (the bar series is
derived from all of ``lineitem``); queries that exercise sinks write only
to fresh paths or tables under the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.functions.columns import as_double
from barsmith.operators.analytics import (
    symbol_extremes,
    symbol_list,
    symbol_series,
    with_previous_close,
    with_variation,
)
from barsmith.operators.quality import drop_duplicates, duplicate_check, last_per_key
from barsmith.operators.transforms import (
    long_to_wide,
    normalize,
    tag,
    union_all,
    wide_to_long,
)
from barsmith.plans.fixtures import bars_from_lineitem, land_payloads, lines_of
from barsmith.plans.etl import prepare_table, run
from barsmith.schema import MEASURES, PROCESS_DATE
from barsmith.session import drop_path, scratch_path, shared_dir, work_table
from barsmith.sinks.tables import (
    append_table,
    clear_process_date,
    create_bars_table,
    reload_process_date,
    write_bucketed,
)
from barsmith.sources.payloads import ingest_payloads
from barsmith.sources.tables import preview, table_preview

# Fixed values used by the queries and their oracles.
D1 = "2023-07-11"
D2 = "2023-07-12"
SPLIT_DATE = "1996-01-01"
VOLUME_TEXT_FROM = 200.0
HASH_FOLDERS = 16
BUCKETS = 16

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_from_lineitem(_read(spark, sf_dir, "lineitem"))


def _before_split():
    """Dates before SPLIT_DATE; rows without a date go with them, so no row is lost."""
    return F.col("date_from").isNull() | (F.col("date_from") < F.lit(SPLIT_DATE).cast("date"))


def _from_split():
    return F.col("date_from") >= F.lit(SPLIT_DATE).cast("date")


def _landed(spark: SparkSession, sf_dir: str) -> str:
    return land_payloads(_bars(spark, sf_dir), scratch_path(spark, "landing"))


# --------------------------------------------------------------------------- queries


def q_etl_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: land payloads, run the ETL for D1 (rejects kept in their own
    table, duplicate report over the batch), read the loaded batch back."""
    landing = _landed(spark, sf_dir)
    table = work_table(spark, "bars")
    rejects = work_table(spark, "rejects")
    run(spark, landing, table, D1, buckets=BUCKETS, reject_table=rejects)
    spark.sql(f"DROP TABLE {rejects}")
    drop_path(spark, landing)  # loaded: neither is needed any more
    return spark.table(table).where(F.col(PROCESS_DATE) == D1)


def _landed_twice(spark: SparkSession, sf_dir: str) -> list[str]:
    """The same payloads landed on two days: every bar arrives twice."""
    shared_dir(spark)
    bars = _bars(spark, sf_dir).checkpoint()
    return [land_payloads(bars, scratch_path(spark, f"landing-day{i}")) for i in (1, 2)]


def q_etl_relanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ETL over two landings: copies are kept, each compared like a window would."""
    table = work_table(spark, "relanded")
    landings = _landed_twice(spark, sf_dir)
    run(spark, landings, table, D1, buckets=BUCKETS)
    for landing in landings:
        drop_path(spark, landing)
    return spark.table(table).where(F.col(PROCESS_DATE) == D1)


def q_relanded_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate report over the raw rows of two landings (AGG-1, AGG-3)."""
    raw, _ = ingest_payloads(spark, _landed_twice(spark, sf_dir))
    return duplicate_check(raw.drop("pos"))


def q_monthly_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with their month-over-month change (WIN-3)."""
    return _bars(spark, sf_dir).transform(with_variation)


def q_previous_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each bar's previous close in its symbol's date order (WIN-1, WIN-2)."""
    return (_bars(spark, sf_dir).transform(with_previous_close)
            .select("symbol", "date_from", "close", "prev_close"))


def q_bucketed_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variation over a table bucketed by symbol: the window needs no Exchange."""
    table = work_table(spark, "bucketed")
    write_bucketed(_bars(spark, sf_dir), table, BUCKETS)
    return spark.table(table).transform(with_variation)


def q_json_series_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed JSON Lines -> raw text rows (SRC-1..3, SRC-5, SRC-7)."""
    raw, _ = ingest_payloads(spark, _landed(spark, sf_dir))
    return raw.drop("pos")


def q_json_folder_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same ingest from folders by a hash of the symbol: their number does not grow with the symbols."""
    landing = land_payloads(_bars(spark, sf_dir), scratch_path(spark, "folders"), hash_folders=HASH_FOLDERS)
    raw, _ = ingest_payloads(spark, landing)
    return raw.drop("pos")


def q_payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reject rows of the landed documents, counted per symbol and reason (SRC-6)."""
    _, rejected = ingest_payloads(spark, _landed(spark, sf_dir))
    return rejected.groupBy("symbol", "reason").agg(F.count(F.lit(1)).alias("documents"))


def q_normalize_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed rows typed strictly: dates and doubles (PRJ-2..5, JOB-5)."""
    raw, _ = ingest_payloads(spark, _landed(spark, sf_dir))
    return raw.transform(normalize, strict=True)


def q_lenient_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed volumes of VOLUME_TEXT_FROM and above arrive as text ``n/a``;
    a lenient read keeps those bars with a NULL volume (Q10, PRJ-3)."""
    landing = land_payloads(_bars(spark, sf_dir), scratch_path(spark, "landing-na"),
                            malformed_volume_from=VOLUME_TEXT_FROM)
    raw, _ = ingest_payloads(spark, landing)
    return raw.transform(normalize, strict=False)


def q_wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per bar and measure (SRC-4)."""
    return wide_to_long(_bars(spark, sf_dir), ["symbol", "date_from"], list(MEASURES))


def q_long_to_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip: bars -> one row per measure -> bars again (pivot)."""
    ids = ["symbol", "date_from"]
    long = wide_to_long(_bars(spark, sf_dir), ids, list(MEASURES))
    return long_to_wide(long, ids, list(MEASURES))


def q_last_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's latest event (ties: highest id), kept by an aggregate."""
    ev = _read(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return last_per_key(ev, ["user_id"], ["ts", "event_id"])


def q_lenient_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lenient string -> double: failures become NULL (PRJ-3, SCL-1).

    The text is the event's value; errors carry a type suffix (``12.5d``) and
    signups their event type, which are not numbers.
    """
    ev = _read(spark, sf_dir, "events")
    value = F.col("value").cast("string")
    text = (F.when(F.col("event_type") == "error", F.concat(value, F.lit("d")))
            .when(F.col("event_type") == "signup", F.col("event_type")).otherwise(value))
    return ev.select("event_id", as_double(text, strict=False).alias("a"), F.col("value").alias("b"))


def q_union_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three frames with different column sets and orders, matched by name.

    All are date ranges of one frame of bars (rows without a date are in the
    first), which is checkpointed: the scan and its exchange run once.
    """
    shared_dir(spark)
    bars, year = _bars(spark, sf_dir).checkpoint(), F.year("date_from")
    early = bars.where(year.isNull() | (year < 1997)).transform(tag, "batch", "early")
    middle = (bars.where((year >= 1997) & (year < 2000))
              .select("volume", "close", "low", "high", "open", "date_from", "symbol")
              .transform(tag, "batch", "middle"))
    late = bars.where(year >= 2000).drop("volume").transform(tag, "batch", "late")
    return union_all([early, middle, late])


def q_duplicate_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total vs distinct rows of (user_id, event_type) (AGG-1, AGG-3)."""
    return duplicate_check(_read(spark, sf_dir, "events").select("user_id", "event_type"))


def q_drop_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (user_id, event_type) rows (AGG-2)."""
    return drop_duplicates(_read(spark, sf_dir, "events").select("user_id", "event_type"))


def q_symbol_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date and close of each symbol's highest and lowest close (AGG-5)."""
    return symbol_extremes(_bars(spark, sf_dir))


def q_symbol_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct symbols (AGG-4)."""
    return symbol_list(_bars(spark, sf_dir))


def q_symbol_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One symbol's closes; the symbol predicate is pushed into the scan."""
    symbol = "S000001"
    li = lines_of(_read(spark, sf_dir, "lineitem"), symbols=[symbol])
    return symbol_series(bars_from_lineitem(li), symbol)


def q_preview_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ten bars by (symbol, date): the top-k is the feature (LIM-1)."""
    return preview(_bars(spark, sf_dir), 10, ["symbol", "date_from"])


def q_loaded_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ten rows, in order, of a table that was just loaded (SRC-9, JOB-6)."""
    table, buckets = _loaded_table(spark, "previewed")
    reload_process_date(_bars(spark, sf_dir).transform(with_variation, partitions=buckets), table, D1, clustered=True)
    return table_preview(spark, table, 10, ["symbol", "date_from"])


def q_ingested_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extremes over ingested rows; ties go to the first entry of a payload (AGG-5)."""
    raw, _ = ingest_payloads(spark, _landed(spark, sf_dir))
    return symbol_extremes(raw.transform(normalize, keep_pos=True), tie="pos")


def _two_batches(table: str, bars: DataFrame) -> None:
    reload_process_date(bars.where(_before_split()), table, D1, clustered=True)
    reload_process_date(bars.where(_from_split()), table, D2, clustered=True)


def _loaded_table(spark, label: str) -> tuple[str, int]:
    table = work_table(spark, label)
    return table, prepare_table(spark, table, BUCKETS)


def _varied_bars(spark, sf_dir, buckets: int) -> DataFrame:
    """Bars with variation for the several loads of one query.

    The window's exchange matches the table's buckets (one file per bucket
    and batch).  The frame is computed once, into a checkpoint in the shared
    folder, and dealt to the buckets again by each load.
    """
    shared_dir(spark)
    return _bars(spark, sf_dir).transform(with_variation, partitions=buckets).checkpoint()


def q_process_date_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load D1 and D2, then reload D2 with fewer rows: D2 holds only those."""
    table, buckets = _loaded_table(spark, "loaded")
    bars = _varied_bars(spark, sf_dir, buckets)
    _two_batches(table, bars)
    reload_process_date(bars.where(_from_split() & (F.col("volume") > 50)), table, D2)
    return spark.table(table)


def q_clear_process_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load D1 and D2, then drop D2 (twice: a missing batch is fine)."""
    table, buckets = _loaded_table(spark, "loaded")
    _two_batches(table, _varied_bars(spark, sf_dir, buckets))
    clear_process_date(spark, table, D2)
    clear_process_date(spark, table, D2)  # a missing batch is not an error
    return spark.table(table)


def q_append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appending the same batch twice keeps both copies."""
    table, buckets = _loaded_table(spark, "appended")
    create_bars_table(spark, table, BUCKETS)  # a second create changes nothing
    bars = _varied_bars(spark, sf_dir, buckets).transform(tag, PROCESS_DATE, D1)
    append_table(bars, table)
    append_table(bars, table)
    return spark.table(table)


QUERIES: dict[str, Query] = {
    "etl_monthly": q_etl_monthly,
    "etl_relanded": q_etl_relanded,
    "relanded_duplicates": q_relanded_duplicates,
    "monthly_variation": q_monthly_variation,
    "previous_close": q_previous_close,
    "bucketed_variation": q_bucketed_variation,
    "json_series_ingest": q_json_series_ingest,
    "json_folder_ingest": q_json_folder_ingest,
    "payload_rejects": q_payload_rejects,
    "normalize_types": q_normalize_types,
    "lenient_ingest": q_lenient_ingest,
    "wide_to_long": q_wide_to_long,
    "long_to_wide": q_long_to_wide,
    "last_per_key": q_last_per_key,
    "lenient_cast": q_lenient_cast,
    "union_symbols": q_union_symbols,
    "duplicate_check": q_duplicate_check,
    "drop_duplicates": q_drop_duplicates,
    "symbol_extremes": q_symbol_extremes,
    "symbol_list": q_symbol_list,
    "symbol_series": q_symbol_series,
    "preview_top_n": q_preview_top_n,
    "loaded_preview": q_loaded_preview,
    "ingested_extremes": q_ingested_extremes,
    "process_date_reload": q_process_date_reload,
    "clear_process_date": q_clear_process_date,
    "append_load": q_append_load,
}

# --------------------------------------------------------------------------- oracles

_BARS = """bars AS (
  SELECT printf('S%06d', l_suppkey) AS symbol,
         CAST(max(l_shipdate) AS DATE) AS date_from,
         arg_min(l_extendedprice, row(l_shipdate, l_orderkey, l_linenumber, l_partkey)) AS open,
         max(l_extendedprice) AS high,
         min(l_extendedprice) AS low,
         arg_max(l_extendedprice, row(l_shipdate, l_orderkey, l_linenumber, l_partkey)) AS close,
         sum(l_quantity) AS volume
  FROM lineitem
  GROUP BY l_suppkey, date_trunc('month', l_shipdate))"""

_VARIATION = """varied AS (
  SELECT *, (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) * 100 AS monthly_variation
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date_from))"""

_NOTICED = "CAST(substr(symbol, 2) AS BIGINT) % 10 = 0"
_BEFORE = f"(date_from IS NULL OR date_from < DATE '{SPLIT_DATE}')"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _dec(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,4)) AS VARCHAR) AS {c}"


ORACLES: dict[str, str] = {
    "etl_monthly": _with(_BARS, _VARIATION)
    + f"SELECT *, '{D1}' AS process_date FROM varied",
    "etl_relanded": _with(_BARS, "twice AS (SELECT * FROM bars UNION ALL SELECT * FROM bars)",
                          _VARIATION.replace("FROM bars WINDOW", "FROM twice WINDOW"))
    + f"SELECT *, '{D1}' AS process_date FROM varied",
    "relanded_duplicates": _with(
        _BARS,
        "raw AS (SELECT symbol, strftime(date_from, '%Y-%m-%d') AS date_from, "
        + ", ".join(_dec(m) for m in MEASURES) + f" FROM bars)",
        "twice AS (SELECT * FROM raw UNION ALL SELECT * FROM raw)",
    )
    + "SELECT count(*) AS total_rows, "
    "(SELECT count(*) FROM (SELECT DISTINCT * FROM twice)) AS distinct_rows, "
    "count(*) <> (SELECT count(*) FROM (SELECT DISTINCT * FROM twice)) AS has_duplicates "
    "FROM twice",
    "monthly_variation": _with(_BARS, _VARIATION) + "SELECT * FROM varied",
    "previous_close": _with(_BARS)
    + "SELECT symbol, date_from, close, lag(close) OVER (PARTITION BY symbol ORDER BY date_from) AS prev_close FROM bars",
    "bucketed_variation": _with(_BARS, _VARIATION) + "SELECT * FROM varied",
    "json_series_ingest": _with(_BARS)
    + "SELECT symbol, strftime(date_from, '%Y-%m-%d') AS date_from, "
    + ", ".join(_dec(m) for m in MEASURES)
    + " FROM bars",
    "json_folder_ingest": _with(_BARS)
    + "SELECT symbol, strftime(date_from, '%Y-%m-%d') AS date_from, "
    + ", ".join(_dec(m) for m in MEASURES)
    + " FROM bars",
    "payload_rejects": _with(_BARS)
    + "SELECT symbol, 'missing_series' AS reason, count(DISTINCT year(date_from)) AS documents "
    + f"FROM bars WHERE {_NOTICED} GROUP BY symbol",
    "normalize_types": _with(_BARS) + f"SELECT * FROM bars",
    "lenient_ingest": _with(_BARS)
    + "SELECT symbol, date_from, open, high, low, close, "
    + f"CASE WHEN volume >= {VOLUME_TEXT_FROM} THEN NULL ELSE volume END AS volume "
    + "FROM bars",
    "wide_to_long": _with(_BARS)
    + " UNION ALL ".join(
        f"SELECT symbol, date_from, '{m}' AS field, {m} AS value FROM bars" for m in MEASURES
    ),
    "long_to_wide": _with(_BARS) + "SELECT * FROM bars",
    "last_per_key": "SELECT user_id, ts, event_id, event_type, value FROM ("
    "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn "
    "FROM events) WHERE rn = 1",
    "lenient_cast": "SELECT event_id, CASE WHEN event_type NOT IN ('error', 'signup') THEN value END AS a, value AS b FROM events",
    "union_symbols": _with(_BARS)
    + "SELECT symbol, date_from, open, high, low, close, "
    "CASE WHEN year(date_from) >= 2000 THEN NULL ELSE volume END AS volume, "
    "CASE WHEN year(date_from) IS NULL OR year(date_from) < 1997 THEN 'early' WHEN year(date_from) < 2000 THEN 'middle' "
    "ELSE 'late' END AS batch FROM bars",
    "duplicate_check": "SELECT count(*) AS total_rows, "
    "(SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) AS distinct_rows, "
    "count(*) <> (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) "
    "AS has_duplicates FROM events",
    "drop_duplicates": "SELECT DISTINCT user_id, event_type FROM events",
    "symbol_extremes": _with(_BARS)
    + """, hi AS (SELECT symbol, date_from AS max_date, close AS max_close,
                row_number() OVER (PARTITION BY symbol ORDER BY close DESC, date_from DESC) AS rn FROM bars),
     lo AS (SELECT symbol, date_from AS min_date, close AS min_close,
                row_number() OVER (PARTITION BY symbol ORDER BY close ASC, date_from DESC) AS rn FROM bars)
SELECT hi.symbol, max_date, max_close, min_date, min_close
FROM hi JOIN lo ON hi.symbol = lo.symbol AND hi.rn = 1 AND lo.rn = 1""",
    "symbol_list": _with(_BARS) + "SELECT DISTINCT symbol FROM bars",
    "symbol_series": _with(_BARS) + "SELECT date_from, close FROM bars WHERE symbol = 'S000001'",
    "preview_top_n": _with(_BARS) + "SELECT * FROM bars ORDER BY symbol, date_from LIMIT 10",
    "loaded_preview": _with(_BARS, _VARIATION)
    + f"SELECT *, '{D1}' AS process_date FROM varied ORDER BY symbol, date_from LIMIT 10",
    "ingested_extremes": _with(
        _BARS,
        "placed AS (SELECT *, row_number() OVER (PARTITION BY symbol, year(date_from) ORDER BY date_from DESC) AS pos FROM bars)")
    + """, hi AS (SELECT symbol, date_from AS max_date, close AS max_close,
                row_number() OVER (PARTITION BY symbol ORDER BY close DESC, pos, date_from DESC) AS rn FROM placed),
     lo AS (SELECT symbol, date_from AS min_date, close AS min_close,
                row_number() OVER (PARTITION BY symbol ORDER BY close, pos, date_from DESC) AS rn FROM placed)
SELECT hi.symbol, max_date, max_close, min_date, min_close
FROM hi JOIN lo ON hi.symbol = lo.symbol AND hi.rn = 1 AND lo.rn = 1""",
    "process_date_reload": _with(_BARS, _VARIATION)
    + f"SELECT *, '{D1}' AS process_date FROM varied WHERE {_BEFORE} "
    + f"UNION ALL SELECT *, '{D2}' AS process_date FROM varied "
    + f"WHERE date_from >= DATE '{SPLIT_DATE}' AND volume > 50",
    "clear_process_date": _with(_BARS, _VARIATION)
    + f"SELECT *, '{D1}' AS process_date FROM varied WHERE {_BEFORE}",
    "append_load": _with(_BARS, _VARIATION)
    + f"SELECT *, '{D1}' AS process_date FROM varied UNION ALL SELECT *, '{D1}' AS process_date FROM varied",
}
