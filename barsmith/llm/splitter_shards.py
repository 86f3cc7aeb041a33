"""Sharding by sampled splitters, law ``bytes`` (operator 5, native).

Records are ordered by (hash of the text, doc_id, row): equal texts are
neighbours.  A size-weighted sample of that key -- ``SAMPLE`` records are
expected, whatever the input's size -- gives quantile boundaries that cut the
hash space into ``RANGES`` ranges of about equal bytes.  Exact byte totals of
the ranges follow; a range above twice the fair share (one hot text, say) is
subdivided on the full key by a second sample of its own records.  Runs of
pieces with exact totals then fill the shards, so shard sizes differ by about
one piece, and groups of equal texts stay together unless they are overfull.

Slots number a shard's records from 0 without gaps: the piece's offset from
exact counts plus the place inside the piece, so no task sorts a whole shard.

Size: UTF-8 bytes plus 1, null text counts as none.  Null doc_ids sort first;
repeated rows differ by their row number.  What the driver holds, and what is
broadcast, is bounded by ``RANGES`` and ``SAMPLE``.  Only DataFrame functions
run here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barsmith.llm.runtime import text_or_empty
from barsmith.session import shared_dir

SHARDS = 16
RANGES = 4096
SAMPLE = 8 * RANGES
_CELL_BITS = 12  # ranges are looked up by the top bits of the key


def _uniform(*cols) -> "F.Column":
    return F.shiftrightunsigned(F.xxhash64(*cols, F.lit("splitters")), 11) / float(1 << 53)


def _weighted_sample(rows: DataFrame, total, expected: int) -> DataFrame:
    """Poisson sample, chance in proportion to size; ``weight``: bytes a row stands for."""
    chance = F.least(F.lit(1.0), expected * F.col("size") / total)
    return (rows.withColumn("chance", chance).where(_uniform("key", "doc_id", "row") < F.col("chance"))
            .withColumn("weight", F.col("size") / F.col("chance")))


def records(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Narrow rows: carried columns, key, size, crc; cut from the texts by a checkpoint."""
    shared_dir(docs.sparkSession)
    text = text_or_empty()
    return docs.select(
        *carry, F.xxhash64(text).alias("key"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("row")).checkpoint()


def _range_table(spark, bounds: list[int]) -> DataFrame:
    """(cell, first, last, range) for every range that meets a cell of the key's top bits."""
    low, high = -(1 << 63), (1 << 63) - 1
    edges = [low, *[b + 1 for b in bounds if b < high]]
    rows = []
    shift = 64 - _CELL_BITS
    for i, first in enumerate(edges):
        last = edges[i + 1] - 1 if i + 1 < len(edges) else high
        rows += [(c, first, last, i) for c in range(first >> shift, (last >> shift) + 1)]
    return spark.createDataFrame(rows, "cell long, first long, last long, range int")


def pieces_of(rows: DataFrame) -> DataFrame:
    """``rows`` with ``range`` and ``sub``: its piece in key order."""
    spark = rows.sparkSession
    total = rows.agg(F.sum("size")).first()[0] or 1
    sample = _weighted_sample(rows, F.lit(float(total)), SAMPLE)
    upto = Window.orderBy("key", "doc_id", "row").rowsBetween(Window.unboundedPreceding, 0)
    quantile = F.floor(F.sum("weight").over(upto) / F.sum("weight").over(
        Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) * RANGES)
    bounds = sorted({r[0] for r in sample.withColumn("q", quantile).groupBy("q").agg(F.max("key")).select("max(key)").collect()})
    table = _range_table(spark, bounds)
    ranged = rows.withColumn("cell", F.shiftright("key", 64 - _CELL_BITS)).join(F.broadcast(table), "cell").where(
        F.col("key").between(F.col("first"), F.col("last"))).drop("cell", "first", "last")

    fair = total / RANGES
    overfull = ranged.groupBy("range").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > 2 * fair)
    inner = _weighted_sample(ranged.join(F.broadcast(overfull), "range"), F.lit(float(total)), SAMPLE)
    own = Window.partitionBy("range").orderBy("key", "doc_id", "row")
    parts = F.ceil(F.col("bytes") / fair)
    q = F.floor(F.sum("weight").over(own.rowsBetween(Window.unboundedPreceding, 0)) / F.col("bytes") * parts)
    splits = (inner.withColumn("q", q).groupBy("range", "q")
              .agg(F.max(F.struct("key", "doc_id", "row")).alias("split"))
              .groupBy("range").agg(F.collect_list("split").alias("splits")))
    sub = F.size(F.filter("splits", lambda s: s < F.struct("key", "doc_id", "row")))
    return ranged.join(F.broadcast(splits), "range", "left").withColumn(
        "sub", F.when(F.col("splits").isNull(), 0).otherwise(sub)).drop("splits")


def assign(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per record: carried columns, size, text_crc32, shard, slot."""
    rows = pieces_of(records(docs, carry))
    totals = rows.groupBy("range", "sub").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("range", "sub")
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    middle = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes") / 2
    shard = F.least(F.floor(middle * SHARDS / F.sum("bytes").over(whole)), F.lit(SHARDS - 1)).cast("int")
    totals = totals.withColumn("shard", shard)
    before = Window.partitionBy("shard").orderBy("range", "sub").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("range", "sub", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("range", "sub").orderBy("key", "doc_id", "row"))
    placed = rows.join(F.broadcast(totals), ["range", "sub"])
    return placed.select(*carry, "size", "text_crc32", "shard",
                         (F.col("offset") + place - 1).cast("long").alias("slot"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document under the law ``bytes``."""
    return assign(docs.select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
