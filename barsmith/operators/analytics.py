"""Window and per-symbol analytics (WIN-1..3, AGG-4..5, FLT-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barsmith.functions.columns import pct_change
from barsmith.operators.transforms import cluster_by
from barsmith.schema import VARIATION
from barsmith.session import scratch_path, shared_dir


def series_window(partition: str = "symbol", order: str = "date_from"):
    """Per-symbol, date-ordered window (WIN-1)."""
    return Window.partitionBy(partition).orderBy(order)


def previous_over_ranges(df: DataFrame, value: str, out: str, partition: str = "symbol",
                         order: str | Sequence[str] = "date_from", ranges: int | None = None) -> DataFrame:
    """Previous row's ``value`` per ``partition`` without bringing its rows together (WIN-2).

    For symbols that may hold a large share of all rows, which a window task
    would have to sort alone.  Rows are dealt by range of (symbol, order) into
    ``ranges`` tasks (default: the shuffle partitions) and stored in order; the
    lag runs inside each range, and a range's first row of a symbol takes the
    last value of the symbol's range before it.  Only those border rows, one
    for each range and symbol, meet by symbol.  Ties in ``order`` are broken by
    the other columns; equal rows are spread too, and which of them comes
    first makes no difference.  NULL symbols are one symbol.
    """
    spark = df.sparkSession
    at, part, first, last, tie = (f"__barsmith_{c}" for c in ("at", "part", "first", "last", "tie"))
    cols = [c for c in df.columns if c != out]
    by = [order] if isinstance(order, str) else list(order)
    keys = [partition, *by, *[c for c in cols if c not in (partition, *by)]]
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranges")
    (df.select(*cols, F.monotonically_increasing_id().alias(tie))
     .repartitionByRange(n, *keys, tie).sortWithinPartitions(*keys, tie).drop(tie)
     .withColumn(at, F.monotonically_increasing_id()).write.parquet(path))
    placed = spark.read.parquet(path).withColumn(part, F.shiftright(at, 33))
    inside = Window.partitionBy(part, partition).orderBy(at)
    lagged = placed.withColumn(out, F.lag(value).over(inside)).withColumn(first, F.row_number().over(inside) == 1)
    borders = placed.groupBy(part, partition).agg(F.max_by(F.struct(value), at).alias(last))
    carried = borders.select(F.col(part).alias("__barsmith_p"), F.col(partition).alias("__barsmith_s"),
                             F.lag(last).over(Window.partitionBy(partition).orderBy(part)).alias(last))
    met = lagged.join(carried, (F.col(part) == F.col("__barsmith_p")) & F.col(partition).eqNullSafe(F.col("__barsmith_s")))
    return met.select(*cols, F.when(F.col(first), F.col(last)[value]).otherwise(F.col(out)).alias(out))


def with_previous_close(
    df: DataFrame, value: str = "close", out: str = "prev_close",
    partition: str = "symbol", order: str = "date_from",
    collapse_copies: bool = False, chunk_rows: int = 100_000,
    partitions: int | None = None, spread: bool = False,
) -> DataFrame:
    """Previous row's ``value`` in the symbol's date order; NULL first (WIN-2).

    ``collapse_copies``, ``chunk_rows``, ``partitions`` and ``spread`` as for
    :func:`with_variation`: a further copy of a row gets its twin's value.
    """
    if out in df.columns:  # replace, as withColumn would
        df = df.drop(out)
    if collapse_copies:
        return _over_copies(df, value, out, partition, order, chunk_rows, partitions,
                            lambda cur, prev: prev, spread)
    if spread:
        return previous_over_ranges(df, value, out, partition, order)
    if partitions:
        df = cluster_by(df, partition, partitions)
    return df.withColumn(out, F.lag(value).over(series_window(partition, order)))


def with_variation(
    df: DataFrame, value: str = "close", out: str = VARIATION,
    partition: str = "symbol", order: str = "date_from",
    collapse_copies: bool = False, chunk_rows: int = 100_000,
    partitions: int | None = None, spread: bool = False,
) -> DataFrame:
    """Month-over-month change in percent (WIN-3).

    NULL for a symbol's first month and when the previous close is 0 or NULL.
    Plain form: one shuffle by symbol (none when the input is bucketed by
    symbol).  Use it on frames that hold one row per (symbol, month), such
    as aggregated bars: a symbol's rows are bounded by the calendar.

    ``collapse_copies=True`` is for raw input that may repeat rows, where a
    group of identical copies could hold a large share of all rows.  Copies
    are first counted by an aggregate with map-side combine, the window then
    runs over distinct rows only, and the rows are expanded back: the first
    copy is compared with the previous distinct row, every further copy
    with its twin (0, or NULL for a zero/NULL close) -- what a window over
    the repeated rows yields.  Rows without copies leave the window task
    as they are; copied rows are expanded in chunks of at most
    ``chunk_rows``, spread over tasks by row identity, so no task emits a
    hot group -- or a symbol's many copied rows -- alone.

    Copies are equal under Spark's grouping semantics: ``-0.0`` and ``0.0``
    are the same value (returned as ``0.0``) and every NaN is one NaN.

    ``partitions`` fixes the window's exchange to exactly that many hash
    partitions by symbol -- the bucket count of the target table -- so each
    write task then fills one bucket file instead of one file per bucket.

    ``spread=True`` is for symbols with very many distinct rows: the previous
    value comes from :func:`previous_over_ranges`, whose tasks hold a range of
    rows each, however many of them belong to one symbol.  Without it a
    symbol's rows are sorted by one task.
    """
    if out in df.columns:  # replace, as withColumn would
        df = df.drop(out)
    if spread and not collapse_copies:
        prev, cols = "__barsmith_prev", df.columns
        return previous_over_ranges(df, value, prev, partition, order).select(
            *cols, pct_change(F.col(value), F.col(prev)).alias(out))
    if not collapse_copies:
        if partitions:
            df = cluster_by(df, partition, partitions)
        prev = "__barsmith_prev"
        cols = df.columns
        return (df.select(*cols, F.lag(value).over(series_window(partition, order)).alias(prev))
                  .select(*cols, pct_change(F.col(value), F.col(prev)).alias(out)))
    return _over_copies(df, value, out, partition, order, chunk_rows, partitions, pct_change, spread)


_N, _FIRST, _REST = "__barsmith_n", "__barsmith_first", "__barsmith_rest"


def windowed_copies(df, value, partition, order, partitions, combine, spread=False):
    """Distinct rows of ``df``: how often each occurs and what its first copy,
    and every further one, is combined with."""
    cols, n, first, rest = df.columns, _N, _FIRST, _REST
    tiebreak = [c for c in cols if c not in (partition, order)]
    w = Window.partitionBy(partition).orderBy(order, *tiebreak)
    prev = "__barsmith_prev"
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(n))
    if spread:
        lagged = previous_over_ranges(counted, value, prev, partition, [order, *tiebreak])
    else:
        if partitions:
            counted = cluster_by(counted, partition, partitions)
        lagged = counted.select(*cols, n, F.lag(value).over(w).alias(prev))
    return lagged.select(
        *cols, n,
        combine(F.col(value), F.col(prev)).alias(first),
        combine(F.col(value), F.col(value)).alias(rest),
    )


def _over_copies(df, value, out, partition, order, chunk_rows, partitions, combine, spread=False):
    """``combine(current, previous)`` over the rows of ``df``, copies included,
    with the window run over distinct rows only (see ``with_variation``).

    The windowed frame is checkpointed to the shared folder, so its sort and
    window run once for both branches below."""
    cols, n, first, rest = df.columns, _N, _FIRST, _REST
    chunk, i = "__barsmith_chunk", "__barsmith_i"
    tiebreak = [c for c in cols if c not in (partition, order)]
    shared_dir(df.sparkSession)
    distinct = windowed_copies(df, value, partition, order, partitions, combine, spread).checkpoint()
    pick = F.when(F.col(i) == 1, F.col(first)).otherwise(F.col(rest)).alias(out)
    if spread and partitions:  # the ranges do not follow the target's buckets
        distinct = cluster_by(distinct, partition, partitions)

    # Rows without copies -- the usual case -- leave the window task as they are.
    single = distinct.where(F.col(n) == 1).select(*cols, F.col(first).alias(out))
    # Copied rows become chunk descriptors (at most chunk_rows copies each)
    # spread over a fixed number of tasks (AQE would merge the tiny
    # descriptors back into one task), so neither one hot row nor one
    # symbol's many copied rows expand in a single task.  Spread by row
    # identity; with a target bucket count, by range over (bucket id, row,
    # chunk) instead, so each task also writes only one or two bucket files.
    k = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    descriptors = (
        distinct.where(F.col(n) > 1)
        .select(*cols, n, first, rest,
                F.explode(F.sequence(F.lit(0), F.floor((F.col(n) - 1) / chunk_rows))).alias(chunk))
    )
    if partitions:
        bucket = F.pmod(F.hash(F.col(partition)), F.lit(partitions))
        spread = descriptors.repartitionByRange(k, bucket, partition, order, *tiebreak, chunk)
    else:
        spread = descriptors.repartition(k, *cols, chunk)
    copied = (
        spread
        .select(*cols, first, rest, F.explode(F.sequence(
            F.col(chunk) * chunk_rows + 1,
            F.least((F.col(chunk) + 1) * chunk_rows, F.col(n)),
        )).alias(i))
        .select(*cols, pick)
    )
    return single.unionByName(copied)


def symbol_extremes(df: DataFrame, value: str = "close", date: str = "date_from",
                    tie: str | None = None) -> DataFrame:
    """Per symbol: date and value of the highest and lowest ``value`` (AGG-5).

    NULL and NaN values are skipped.  Ties go to the smallest ``tie`` column
    (the entry's payload position) when given, then to the latest date --
    the first occurrence in a newest-first series.
    An aggregate with partial combine, not a ranking window.
    """
    v = F.col(value)
    ok = v.isNotNull() & ~F.isnan(v)
    if tie is not None:
        hi_key = F.struct(v, -F.col(tie), F.col(date))
        lo_key = F.struct(v, F.col(tie), -F.unix_date(F.col(date)))
    else:
        hi_key = F.struct(v, F.col(date))
        lo_key = F.struct(v, -F.unix_date(F.col(date)))
    return df.groupBy("symbol").agg(
        F.max_by(F.col(date), F.when(ok, hi_key)).alias("max_date"),
        F.max(F.when(ok, v)).alias("max_close"),
        F.min_by(F.col(date), F.when(ok, lo_key)).alias("min_date"),
        F.min(F.when(ok, v)).alias("min_close"),
    )


def symbol_list(df: DataFrame) -> DataFrame:
    """Distinct symbols (AGG-4)."""
    return df.select("symbol").distinct()


def symbol_series(df: DataFrame, symbol: str,
                  columns: Sequence[str] = ("date_from", "close")) -> DataFrame:
    """One symbol's rows, selected columns (FLT-1, PRJ-6)."""
    return df.where(F.col("symbol") == F.lit(symbol)).select(*columns)
