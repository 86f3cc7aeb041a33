"""Landed monthly-series payloads -> raw bar rows (SRC-1..3, 5..7, SCL-6).

Two landing layouts are read by the same code:

* JSON Lines where each document names its symbol next to its series
  (``{"symbol": "IBM", "Monthly Time Series": {...}}``), many documents per
  file.  Files split across tasks like any text input and no per-symbol
  folder has to be listed -- the layout for many symbols.
* ``symbol=<SYM>/`` folders holding documents without a symbol field, the
  way single API responses are saved; ``symbol`` is then the partition
  column.  With ``wholetext=True`` each file is one (possibly pretty-printed)
  document.

The JSON source parses each document once into a typed map; everything
after the scan is narrow (no shuffle): duplicate-key resolution inside each
document with higher-order array functions, then ``explode``.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.schema import ENTRY_TYPE, FIELD_RENAMES, PAYLOAD_TYPE, SERIES_KEY

# Reject reasons.
REASON_MALFORMED = "malformed_json"
REASON_MISSING = "missing_series"
REASON_EMPTY = "empty_series"
REASON_NO_SYMBOL = "missing_symbol"
REASON_ENTRY = "malformed_entry"

CORRUPT = "_corrupt_record"


def read_payloads(
    spark: SparkSession,
    path: str | list[str],
    *,
    wholetext: bool = False,
    symbols: Iterable[str] | None = None,
) -> DataFrame:
    """Scan all landed documents under ``path`` (one or several landings)
    in one distributed read.

    Returns ``symbol, series, bad, _corrupt_record``: ``series`` is the typed
    MAP<date string, STRUCT<five strings>> or NULL when the document has
    none; ``bad`` maps dates to the text of entries that are not objects;
    ``_corrupt_record`` holds the text of a document that cannot be read.
    The JSON source parses each document once, during the scan, and reads
    only the fields of the explicit schema (so symbol text such as ``0001``
    stays a string); only a document that this fails on is parsed again,
    entry by entry.  ``symbols`` restricts the scan, rejects included; with
    symbol folders the predicate prunes directories (``PartitionFilters``),
    with JSON Lines it is pushed into the JSON parser.
    """
    reader = _json_options(spark.read, wholetext)
    # Each landing root is its own scan: roots holding symbol= folders cannot
    # share one partition discovery.
    roots = [path] if isinstance(path, str) else list(path)
    if not roots:
        raise ValueError("no landing path given")
    df = reduce(DataFrame.unionByName, [reader.json(p) for p in roots])
    if symbols is not None:
        df = df.where(F.col("symbol").isin(list(symbols)))
    return _by_entry(df.select("symbol", F.col(SERIES_KEY).alias("series"), CORRUPT))


def _json_options(reader, wholetext: bool):
    schema = (
        T.StructType(list(PAYLOAD_TYPE.fields))
        .add(CORRUPT, T.StringType())
        .add("symbol", T.StringType())
    )
    return (
        reader.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", wholetext)
    )


def payload_stream(spark: SparkSession, path: str, *, wholetext: bool = False,
                   max_files: int | None = None) -> DataFrame:
    """The documents under ``path`` as a stream of files, subfolders included, parsed as
    ``read_payloads`` parses them, plus ``landed_file``.  ``symbol`` is a field of the document:
    folder names are not read."""
    reader = _json_options(spark.readStream, wholetext).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.json(path).select("symbol", F.col(SERIES_KEY).alias("series"), CORRUPT,
                                  F.col("_metadata.file_path").alias("landed_file"))
    return _by_entry(df, "landed_file")


def _by_entry(df: DataFrame, *carried: str) -> DataFrame:
    """Save the good entries of documents that hold a bad one (see ``read_payloads``)."""
    again = F.from_json(F.col(CORRUPT), f"symbol STRING, `{SERIES_KEY}` MAP<STRING, STRING>")
    df = df.withColumn("again", F.when(F.col(CORRUPT).isNotNull(), again))
    texts = F.col("again").getField(SERIES_KEY)
    saved = texts.isNotNull()
    is_object = lambda v: v.isNull() | v.rlike(r"^\s*\{")
    good = F.transform_values(F.map_filter(texts, lambda k, v: is_object(v)), lambda k, v: F.from_json(v, ENTRY_TYPE))
    return df.select(
        F.coalesce("symbol", F.col("again.symbol")).alias("symbol"),
        F.when(saved, good).otherwise(F.col("series")).alias("series"),
        F.map_filter(texts, lambda k, v: ~is_object(v)).alias("bad"),
        F.when(~saved, F.col(CORRUPT)).alias(CORRUPT),
        *carried,
    )


def _reject_reason() -> Column:
    only_bad = F.coalesce(F.size("bad"), F.lit(0)) > 0
    return (
        F.when(F.col(CORRUPT).isNotNull(), F.lit(REASON_MALFORMED))
        .when(F.col("series").isNull(), F.lit(REASON_MISSING))
        .when((F.size("series") == 0) & ~only_bad, F.lit(REASON_EMPTY))
        .when(F.col("symbol").isNull(), F.lit(REASON_NO_SYMBOL))
    )


def split_payloads(parsed: DataFrame, symbols: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted documents, reject rows ``symbol, reason, value``) (SRC-6, SRC-7).

    A document is accepted when it holds a good entry and a symbol (one of
    ``symbols``, if given: rejects are never filtered).  Besides documents
    without these, every bad entry of any document is a reject of its own;
    ``value`` keeps the text of malformed documents and entries.  Request
    failures of a live API have no landed file and therefore no row.
    """
    accepted = parsed.where(F.col(CORRUPT).isNull() & (F.size("series") > 0) & F.col("symbol").isNotNull())
    if symbols is not None:
        accepted = accepted.where(F.col("symbol").isin(list(symbols)))
    whole = F.when(_reject_reason().isNotNull(),
                   F.array(F.struct(_reject_reason().alias("reason"), F.col(CORRUPT).alias("value"))))
    entries = F.transform(F.map_entries("bad"), lambda e: F.struct(
        F.lit(REASON_ENTRY).alias("reason"), F.concat(e["key"], F.lit(": "), e["value"]).alias("value")))
    none = F.array().cast("array<struct<reason:string,value:string>>")
    every = F.concat(F.coalesce(whole, none), F.coalesce(entries, none))
    rejected = parsed.select("symbol", F.explode(every).alias("r")).select("symbol", "r.reason", "r.value")
    return accepted, rejected


def explode_series(parsed: DataFrame) -> DataFrame:
    """One row per (symbol, date) entry: F2 raw rows, all values text.

    Documents without a series yield no row.

    Inside a JSON object a repeated date keeps its last entry, as a parsed
    dictionary would.  Entries are tagged with their position, sorted by
    (date, position) and an entry survives only when the next one has
    another date -- O(n log n) per document, no shuffle.
    ``pos`` is the entry's 0-based position in its document.
    """
    # sort_array compares natively; array_sort would evaluate a comparator
    # lambda per comparison.
    tagged = F.sort_array(
        F.transform(
            F.map_entries("series"),
            lambda e, i: F.struct(
                e["key"].alias("date_from"), i.alias("pos"), e["value"].alias("v")
            ),
        )
    )
    last_wins = F.filter(
        "entries",
        lambda x, i: (i == F.size("entries") - 1)
        | (F.col("entries")[i + 1]["date_from"] != x["date_from"]),
    )
    # explode_outer + explicit filter: a plain explode lets the optimizer
    # infer a size() filter that would re-run the sort inside the lambda.
    return (
        parsed.select("symbol", tagged.alias("entries"))
        .select("symbol", F.explode_outer(last_wins).alias("e"))
        .where(F.col("e").isNotNull())
        .select(
            "symbol",
            F.col("e.date_from").alias("date_from"),
            *[F.col("e.v").getField(f).alias(m) for f, m in FIELD_RENAMES.items()],
            F.col("e.pos").alias("pos"),
        )
    )


def ingest_payloads(
    spark: SparkSession,
    path: str | list[str],
    *,
    wholetext: bool = False,
    symbols: Iterable[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """read -> explode accepted documents (of ``symbols``), and all reject rows."""
    accepted, _ = split_payloads(read_payloads(spark, path, wholetext=wholetext, symbols=symbols), symbols)
    _, rejected = split_payloads(read_payloads(spark, path, wholetext=wholetext))
    return explode_series(accepted), rejected
