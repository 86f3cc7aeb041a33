"""Merkle manifest of a dataset: a content-addressed DAG with proofs (operator 11).

A row is a leaf: the digest of its doc_id, source, lang, n_chars and text.
Each ``lang`` is a tree over its leaves by doc_id; the subroots, by lang, are
the leaves of one more tree, whose top is the dataset's root.  In a tree every
two consecutive nodes (the last alone, if odd) become their digest until one
is left; digests are hashed as lowercase hex text.

1. Leaves are hashed in the JVM and stored, then dealt by range of
   (lang, doc_id, leaf) and stored in order.  Rows per range and lang add up to
   each leaf's rank: a lang of any size spreads over all tasks.
2. ``build`` climbs ``STRIDE`` levels at a time: a block of ``FAN`` consecutive
   nodes becomes one node and one stored record, digest -> children.  Records
   are addressed by content alone; the levels between are hashed again from
   the children, which also proves the record.
3. ``descend`` starts from the root's digest.  At each record the digits of a
   requested rank say which child is selected on every level; the unselected
   ones are collected on the way down and the segment is reversed, so that
   paths read from the leaf upwards.  Requests that share a prefix share its
   descent; a block's requests meet its record last, one block at a time.

Nulls hash as ``-``; a null lang comes first and is a tree of its own, as null
doc_ids come first in theirs.  Repeated doc_ids are ordered by leaf; equal
rows are equal leaves at neighbouring ranks.  Empty tables have no root and no
rows.  Extra columns are not hashed.  Texts of any length are hashed whole.
Records of equal content are one record; a digest that very many blocks share
makes one key hot in the descent's join, which AQE splits on the requests' side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.llm.runtime import release, ship, shuffle_partitions
from barsmith.session import drop_path, scratch_path

STRIDE = 8
FAN = 1 << STRIDE
_RECORD = "tree string, rank long, n long, digest binary, depth int, children binary"
_FRONTIER = "tree string, rank long, digest binary, subroot binary, path array<string>"


# ------------------------------------------------------------------ digests


def leaf_of(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """A row's leaf: sha256 of ``-`` for each null, else byte count, ``:`` and value."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))

    return F.unhex(F.sha2(F.concat(*[field(c) for c in (doc_id, source, lang, n_chars, text)]).cast("binary"), 256))


def levels_up(foot: list[str], depth: int) -> list[list[str]]:
    """The nodes (hex digests) of ``depth`` levels over ``foot``, which comes first."""
    levels = [foot]
    for _ in range(depth):
        now = levels[-1]
        levels.append([hashlib.sha256("".join(now[i:i + 2]).encode()).hexdigest() for i in range(0, len(now), 2)])
    return levels


def depth_of(n: int) -> int:
    """Levels that a block of a tree with ``n`` nodes climbs."""
    return min(STRIDE, (n - 1).bit_length())


def segment(levels: list[list[str]], digit: int) -> list[str]:
    """Unselected children on the way down to the foot's node ``digit``, reversed.

    One entry a level: ``<`` or ``>`` (the sibling's side) with its digest, empty where the run has no other."""
    down = []
    for height in range(len(levels) - 2, -1, -1):
        own = digit >> height
        other = own ^ 1
        run = levels[height]
        down.append("" if other >= len(run) else ("<" if other < own else ">") + run[other])
    return down[::-1]


def _split(packed: bytes) -> list[str]:
    text = packed.hex()
    return [text[i:i + 64] for i in range(0, len(text), 64)]


def _opened(digest: bytes, depth: int, children: bytes) -> list[list[str]]:
    """A record's levels, proved against its digest."""
    levels = levels_up(_split(children), depth)
    if levels[-1] != [digest.hex()]:
        raise ValueError(f"a record's children do not hash to {digest.hex()}")
    return levels


# ------------------------------------------------------------------ ranks


def _ranked(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` (a stored table with ``tree``) with ``rank`` in their tree's order and its size ``n``."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    tied = rows.withColumn("tie", F.monotonically_increasing_id())  # equal rows spread over ranges too
    keys = ["tree", *order, "tie"]
    (tied.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys).drop("tie")
     .withColumn("at", F.monotonically_increasing_id()).write.parquet(path))
    stored = spark.read.parquet(path).withColumn("part", F.shiftright("at", 33))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = stored.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    pieces = pieces.select("tree", "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
                           F.sum("rows").over(tree).alias("n"))
    return stored.join(pieces, ["tree", "part"]).withColumn("rank", F.col("at") + F.col("shift")).drop("part", "at", "shift")


# ------------------------------------------------------------------ building


def _climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes sorted by (tree, rank) -> one record for each block of FAN."""
    key, foot, size = None, [], 0

    def record():
        levels = levels_up(_split(b"".join(foot)), depth_of(size))
        return key[0], key[1], -(-size // FAN), bytes.fromhex(levels[-1][0]), len(levels) - 1, b"".join(foot)

    for batch in batches:
        out = []
        trees, ranks, sizes, digests = (batch.column(c).to_pylist() for c in ("tree", "rank", "n", "digest"))
        for tree, rank, n, digest in zip(trees, ranks, sizes, digests):
            if key != (tree, rank >> STRIDE):
                if foot:
                    out.append(record())
                key, foot, size = (tree, rank >> STRIDE), [], n
            foot.append(digest)
        yield _rows(out, _RECORD)
    if foot:
        yield _rows([record()], _RECORD)
    release()


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}


def _rows(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [f.split() for f in ddl.split(", ")]
    cols = list(zip(*rows)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


@dataclass(frozen=True)
class Forest:
    """Trees over ranked nodes: ``records[t]`` (digest -> children) lead from height t + 1 to t;
    ``roots``: tree, digest, strides (the records between it and a leaf)."""
    records: list[DataFrame]
    roots: DataFrame


def _forest(nodes: DataFrame, label: str) -> Forest:
    """Climb from ``nodes`` (tree, rank, n, digest) to one node in every tree, records stored by stride."""
    spark = nodes.sparkSession
    n = nodes.agg(F.max("n")).first()[0] or 1
    ends, records, now = [], [], nodes.select("tree", "rank", "n", "digest")
    while True:
        ends.append(now.where("n = 1").select("tree", "digest", F.lit(len(records)).alias("strides")))
        if n == 1:
            break
        path = scratch_path(spark, f"{label}-{len(records)}")
        block = F.shiftright("rank", STRIDE)
        (now.where("n > 1").repartition(shuffle_partitions(spark), F.col("tree"), block)
         .sortWithinPartitions("tree", "rank").mapInArrow(_climb, _RECORD).write.parquet(path))
        records.append(spark.read.parquet(path))
        now, n = records[-1].select("tree", "rank", "n", "digest"), -(-n // FAN)
    roots = ends[0]
    for e in ends[1:]:
        roots = roots.union(e)
    return Forest(records, roots)


@dataclass(frozen=True)
class Manifest:
    leaves: DataFrame  # the columns given, with tree, rank and n
    langs: Forest
    subroots: DataFrame  # tree (lang), rank, digest, strides
    top: Forest
    root: bytes | None  # None: no rows


def tree_key(lang: Column) -> Column:
    """A lang as the name of its tree; null sorts before every lang."""
    return F.when(lang.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), lang))


def build(leaves: DataFrame) -> Manifest:
    """The manifest of ``leaves``: lang, doc_id, digest (see ``leaf_of``) and any further columns."""
    spark = leaves.sparkSession
    ship(spark)
    path = scratch_path(spark, "leaves")
    leaves.withColumn("tree", tree_key(F.col("lang"))).drop("lang").write.parquet(path)
    ranked = _ranked(spark.read.parquet(path), ["doc_id", "digest"], "ordered")
    drop_path(spark, path)
    langs = _forest(ranked, "records")
    path = scratch_path(spark, "subroots")
    langs.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", "strides").write.parquet(path)
    subroots = _ranked(spark.read.parquet(path), ["name"], "ordered-subroots")
    top = _forest(subroots, "top-records")
    root = top.roots.select("digest").first()
    named = subroots.select(F.col("name").alias("tree"), "rank", "digest", "strides")
    return Manifest(ranked, langs, named, top, bytes(root[0]) if root else None)


# ------------------------------------------------------------------ descent


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A node with its record -> its children, one segment of path longer."""
    for batch in batches:
        for r in batch.to_pylist():
            levels = _opened(r["digest"], r["depth"], r["children"])
            yield _rows([(r["tree"], r["rank"] * FAN + i, bytes.fromhex(d), r["subroot"], segment(levels, i) + r["path"])
                         for i, d in enumerate(levels[0])], _FRONTIER)
    release()


def _by_digest(records: DataFrame) -> DataFrame:
    return records.select("digest", "depth", "children").dropDuplicates(["digest"])


def _step(nodes: DataFrame, records: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """From nodes one stride down, to the wanted children (tree, rank)."""
    down = nodes.join(_by_digest(records), "digest").mapInArrow(_expand, _FRONTIER)
    return down if wanted is None else down.join(wanted, ["tree", "rank"], "left_semi")


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (tree, block, node first, rank): each block's node, then its requests."""
    key = levels = above = subroot = None
    names = ("tree", "block", "rank", "digest", "subroot", "depth", "children", "path")
    for batch in batches:
        own, leaves, subroots, paths = [], [], [], []
        for i, (tree, block, rank, digest, sub, depth, children, path) in enumerate(
                zip(*[batch.column(c).to_pylist() for c in names])):
            if rank is None:
                key, above, subroot = (tree, block), path, sub
                levels = _opened(digest, depth, children) if depth else [[digest.hex()]]
                continue
            if key != (tree, block) or rank % FAN >= len(levels[0]):
                raise ValueError(f"a request for a leaf that the manifest does not hold: {tree} {rank}")
            own.append(i)
            leaves.append(levels[0][rank % FAN])
            subroots.append(subroot.hex())
            paths.append(segment(levels, rank % FAN) + above)
        yield pa.RecordBatch.from_arrays(
            [batch.column("asked").take(pa.array(own, pa.int64())), pa.array(leaves, pa.string()),
             pa.array(subroots, pa.string()), pa.array(paths, pa.list_(pa.string()))],
            names=["asked", "leaf", "subroot", "path"])
    release()


def descend(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The way from the root to every requested leaf (all of ``manifest.leaves`` if none are given).

    ``requests`` names leaves by tree and rank and may have more columns.  Per request:
    ``asked`` (its columns), leaf (the digest reached), subroot and path (see ``segment``)
    from the leaf up to the root."""
    leaves = manifest.leaves
    spark = leaves.sparkSession
    asked = leaves if requests is None else requests
    top = spark.createDataFrame([] if manifest.root is None else [("", 0, bytearray(manifest.root), None, [])], _FRONTIER)
    for records in reversed(manifest.top.records):
        top = _step(top, records, None)
    subroots = manifest.subroots.select("rank", F.col("tree").alias("lang"), "strides")
    starts = top.join(subroots, "rank").select(
        F.col("lang").alias("tree"), F.lit(0).cast("long").alias("rank"), "digest", F.col("digest").alias("subroot"), "path", "strides")
    if requests is not None:
        starts = starts.join(asked.select("tree").distinct(), "tree", "left_semi")
    frontier = ["tree", "rank", "digest", "subroot", "path"]
    nodes = None
    for t in range(len(manifest.langs.records), 0, -1):  # nodes t strides above the leaves
        here = starts.where(F.col("strides") == t).select(frontier)
        if nodes is not None:
            prefixes = None if requests is None else asked.select(
                "tree", F.shiftright("rank", STRIDE * t).alias("rank")).distinct()
            here = here.union(_step(nodes, manifest.langs.records[t], prefixes))
        nodes = here
    ends = starts.where("strides = 0").select(*frontier, F.lit(0).alias("depth"), F.lit(None).cast("binary").alias("children"))
    if nodes is not None:
        ends = ends.unionByName(nodes.join(_by_digest(manifest.langs.records[0]), "digest"))
    whole = F.struct(*[F.col(f"`{c}`") for c in asked.columns])
    shape = asked.select(whole.alias("asked")).schema["asked"].dataType
    heads = ends.select("tree", F.col("rank").alias("block"), F.lit(None).cast("long").alias("rank"), "digest", "subroot",
                        "depth", "children", "path", F.lit(None).cast(shape).alias("asked"))
    body = asked.select("tree", F.shiftright("rank", STRIDE).alias("block"), "rank",
                        *[F.lit(None).cast(t).alias(c) for c, t in (
                            ("digest", "binary"), ("subroot", "binary"), ("depth", "int"), ("children", "binary"),
                            ("path", "array<string>"))], whole.alias("asked"))
    met = heads.unionByName(body).repartition(shuffle_partitions(spark), "tree", "block").sortWithinPartitions("tree", "block", "rank")
    return met.mapInArrow(_answer, f"asked {shape.simpleString()}, leaf string, subroot string, path array<string>")


# ------------------------------------------------------------------ proofs


def proof_digest(path: Column) -> Column:
    """sha256 of a path's siblings, leaf level first."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda e: F.substring(e, 2, 64))).cast("binary"), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root (hex) that ``leaf`` (hex) and the siblings of ``path`` hash to."""
    def up(node: Column, e: Column) -> Column:
        other = F.substring(e, 2, 64)
        return F.sha2(F.when(e.startswith("<"), F.concat(other, node)).otherwise(F.concat(node, other)).cast("binary"), 256)

    return F.aggregate(path, leaf, up)


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The row is tampered with (1 added to n_chars) where 7 divides the crc32 of its doc_id."""
    c = {n: F.col(n) for n in ("doc_id", "source", "lang", "n_chars", "text")}
    hit = F.crc32(c["doc_id"].cast("string").cast("binary")) % 7 == 0
    claim = F.when(hit, leaf_of(*[c[n] + 1 if n == "n_chars" else c[n] for n in c]))
    manifest = build(docs.select("lang", "doc_id", leaf_of(*c.values()).alias("digest"), claim.alias("claim")))
    root = F.lit(None if manifest.root is None else manifest.root.hex()).cast("string")
    found = descend(manifest).select(
        "asked.doc_id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce(F.lower(F.hex("asked.claim")), "leaf"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
