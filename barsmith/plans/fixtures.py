"""Monthly bars and landed payloads derived from the ``lineitem`` table.

The given tables hold no price series, so one is derived: one symbol per
supplier, one bar per calendar month of ship dates.  ``open``/``close`` are
the prices of the month's first/last line by
(l_shipdate, l_orderkey, l_linenumber, l_partkey) -- unique within a supplier
in the given data -- ``high``/``low`` the extreme prices, ``volume`` the
summed quantity, ``date_from`` the month's last ship date.

The derivation is one aggregation with partial (map-side) combine, so a
supplier holding a third of all lines is reduced inside each task before
the shuffle.  The struct ordering keys of ``min_by``/``max_by`` are not
hash-mutable buffers, so Spark plans a sort-based aggregate here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.functions.columns import symbol_from_key
from barsmith.operators.transforms import cluster_by
from barsmith.schema import MEASURES, PAYLOAD_FIELDS, SERIES_KEY

LINE_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")


def symbol_key(symbol: str, prefix: str = "S") -> int:
    """Inverse of ``symbol_from_key`` for one symbol: ``S000001`` -> 1."""
    if not symbol.startswith(prefix) or not symbol[len(prefix):].isdigit():
        raise ValueError(f"not a derived symbol: {symbol!r}")
    return int(symbol[len(prefix):])


def lines_of(lineitem: DataFrame, symbols=None, start: str | None = None,
             end: str | None = None) -> DataFrame:
    """Restrict ``lineitem`` before the bar aggregation.

    Symbols map one-to-one to supplier keys and a month never straddles a
    year boundary, so these predicates select whole bars; written on the
    raw columns they reach the Parquet scan (``PushedFilters``) instead of
    running after the aggregation.
    """
    if symbols is not None:
        lineitem = lineitem.where(F.col("l_suppkey").isin([symbol_key(s) for s in symbols]))
    if start is not None:
        lineitem = lineitem.where(F.col("l_shipdate") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        lineitem = lineitem.where(F.col("l_shipdate") < F.lit(end).cast("timestamp_ntz"))
    return lineitem


def bars_from_lineitem(lineitem: DataFrame) -> DataFrame:
    first_last = F.struct(*LINE_ORDER)
    month = F.trunc(F.to_date("l_shipdate"), "MM")
    return (
        lineitem.groupBy("l_suppkey", month.alias("_month"))
        .agg(
            F.to_date(F.max("l_shipdate")).alias("date_from"),
            F.min_by("l_extendedprice", first_last).alias("open"),
            F.max("l_extendedprice").alias("high"),
            F.min("l_extendedprice").alias("low"),
            F.max_by("l_extendedprice", first_last).alias("close"),
            F.sum("l_quantity").alias("volume"),
        )
        .select(symbol_from_key("l_suppkey").alias("symbol"), "date_from", *MEASURES)
    )


def symbol_number(symbol="symbol"):
    """The integer behind a symbol such as ``S000010`` (10)."""
    return F.expr(f"try_cast(substr({symbol}, 2) AS BIGINT)")


def notice_symbols(symbol="symbol", every: int | None = 10):
    """Fault injection for the landed fixture: these symbols also get notice bodies.

    Every symbol's series is landed; the notices come on top, so the reject
    path sees real traffic.  ``None``: none.
    """
    if not every:
        return F.lit(False)
    return (symbol_number(symbol) % every) == 0


def payload_documents(bars: DataFrame, notice_every: int | None = 10,
                      fixed_writers: bool = False,
                      malformed_volume_from: float | None = None) -> DataFrame:
    """Bars -> payload documents ``symbol, `Monthly Time Series`, Note``.

    One document per symbol and year, entries newest first, every measure
    as ``decimal(18,4)`` text, like the monthly-series API.  A document
    holds at most twelve entries (one bar per month), so no group grows
    with the data.  For symbols picked by :func:`notice_symbols` each document
    is followed by another that holds only a ``Note``.  ``fixed_writers`` keeps
    the session's shuffle partition count (no AQE merging): for folder output,
    where the cost is folders per writer rather than bytes.  ``malformed_volume_from``
    writes the volume as the text ``n/a`` for bars at or above that volume
    (fault injection for the lenient read).
    """
    def text(m: str):
        t = F.col(m).cast("decimal(18,4)").cast("string")
        if m == "volume" and malformed_volume_from is not None:
            t = F.when(F.col(m) >= F.lit(malformed_volume_from), F.lit("n/a")).otherwise(t)
        return t

    fields = F.struct(*[text(m).alias(f) for m, f in zip(MEASURES, PAYLOAD_FIELDS)])
    entry = F.struct(F.date_format("date_from", "yyyy-MM-dd").alias("k"), fields.alias("v"))
    # Hash-partition by symbol once: the per-(symbol, year) aggregate reuses
    # it (no second exchange), and all of a symbol's documents are written by
    # one task (one file per symbol folder in the folder layout).
    if fixed_writers:
        n = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        clustered = bars.repartition(n, "symbol")
    else:
        clustered = cluster_by(bars, "symbol")
    docs = clustered.groupBy("symbol", F.year("date_from").alias("_year")).agg(
        F.sort_array(F.collect_list(entry), asc=False).alias("entries")
    )
    kinds = F.when(notice_symbols("symbol", notice_every), F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False)))
    return docs.select("symbol", "entries", F.explode(kinds).alias("is_notice")).select(
        "symbol",
        F.when(~F.col("is_notice"), F.map_from_entries("entries")).alias(SERIES_KEY),
        F.when(F.col("is_notice"), F.lit("x")).alias("Note"),
    )


def land_payloads(bars: DataFrame, path: str, notice_every: int | None = 10,
                  symbol_folders: bool = False,
                  malformed_volume_from: float | None = None,
                  hash_folders: int | None = None) -> str:
    """Write payload documents as JSON Lines under ``path``.

    By default each document carries its ``symbol`` (flat files, splittable,
    nothing to list per symbol); ``symbol_folders=True`` writes
    ``symbol=<SYM>/`` folders of documents without it instead: a folder per
    symbol, for few symbols.  ``hash_folders`` writes that many ``part=<n>/``
    folders by a hash of the symbol, whatever the number of symbols.  NULL
    fields are omitted, so a notice document has only ``symbol`` and ``Note``.
    """
    docs = payload_documents(bars, notice_every, fixed_writers=symbol_folders,
                             malformed_volume_from=malformed_volume_from)
    if hash_folders:
        docs = docs.withColumn("part", F.pmod(F.hash("symbol"), F.lit(hash_folders)))
        docs.write.partitionBy("part").json(path)
    else:
        (docs.write.partitionBy("symbol") if symbol_folders else docs.write).json(path)
    return path
