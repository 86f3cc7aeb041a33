"""N-gram Jaccard join with a MinHash LSH forest (operator 8).

Documents are sets of ``SHINGLE``-word shingles (a shorter text with words is
one shingle of all of them); two are linked when their Jaccard similarity is
at least ``threshold``.

1. Each document gets ``TREES * DEPTH`` MinHash values.  Documents with equal
   shingle sets collapse into one class; its members are linked to each other.
2. Fixed-depth banding replaces the forest's tries: classes meet where the
   first values of a tree are equal.  Their number is the largest up to
   ``DEPTH`` at which a pair at the threshold meets in some tree with chance
   of at least ``RECALL``: 1 - (1 - t**depth)**TREES.  It follows from these
   constants, not from the data; classes that met nobody get no shorter match.
3. Where classes meet, the share of equal MinHash values rules out pairs far
   below the threshold (``SLACK``: over five standard deviations); the others
   tie their classes into candidate groups, as stars, never as all pairs.
4. Groups gather each member's shingle set once and verify every pair of the
   group exactly; groups over ``BLOCK`` members are split into pairs of blocks,
   each a task of its own.  Only link counts and stars leave a task.

Result: the class of a document is its connected component under the links.
Null and empty texts hold no shingle: no links, a class of their own.  Rows
are numbered, so repeated rows and repeated or null doc_ids are documents of
their own; a class is named by its smallest doc_id (null last).  Rows are
numbered once, in a stored table that every later read takes them from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.anchors import ranges
from barsmith.llm.components import connected, local_labels
from barsmith.llm.runtime import (
    mix64, pack_sorted, release, ship, shuffle_partitions, slices, stored_rows, unpack_sorted, utf8,
)
from barsmith.llm.wordhash import SLICE_BYTES, whole_windows, window_hashes, words
from barsmith.session import shared_dir

SHINGLE = 5
THRESHOLD = 0.8
TREES = 20
DEPTH = 6
RECALL = 0.999
SLACK = 0.2
BLOCK = 2048
_COLUMNS = 4096  # shingles multiplied at a time
_SIGNED = "row long, doc_id long, n_shingles int, key_a long, key_b long, prefixes array<long>, signature binary"
_MULTIPLIERS = mix64(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def prefix_depth(threshold: float = THRESHOLD, trees: int = TREES, deepest: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix that still reaches the recall at the threshold."""
    depth = deepest
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_sets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all documents, range of each document)."""
    w = words(data, offs)
    at = whole_windows(w, SHINGLE)
    doc = w.doc_of()
    size = np.diff(w.docs)
    short = np.flatnonzero((size > 0) & (size < SHINGLE))
    h = [window_hashes(w.hashes, SHINGLE)[at]]
    d = [doc[at]]
    for n in range(1, SHINGLE):  # a short text is one shingle of n words
        some = short[size[short] == n]
        h.append(mix64(window_hashes(w.hashes, n)[w.docs[some]] + np.uint64(n)))
        d.append(some)
    h, d = np.concatenate(h), np.concatenate(d)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[new], d[new]
    return h, np.searchsorted(d, np.arange(len(offs)))


def _sign(depth: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release()
            data, offs = utf8(batch.column("text"))
            for i, j in slices(offs, SLICE_BYTES):
                h, at = shingle_sets(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                n = np.diff(at)
                some = np.flatnonzero(n)
                sig = np.zeros((j - i, len(_MULTIPLIERS)), np.uint32)
                keys = np.zeros((j - i, 2), np.uint64)
                if len(some):
                    for k, m in enumerate(_MULTIPLIERS):
                        values = ((h * m) >> np.uint64(32)).astype(np.uint32)
                        sig[some, k] = np.minimum.reduceat(values, at[some])
                    keys[some, 0] = np.add.reduceat(mix64(h), at[some])
                    keys[some, 1] = np.add.reduceat(mix64(h ^ np.uint64(0x5851F42D4C957F2D)), at[some])
                trees = sig.reshape(j - i, TREES, DEPTH)[:, :, :depth].astype(np.uint64)
                prefix = np.arange(TREES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.zeros((j - i, 1), np.uint64)
                for k in range(depth):
                    prefix = mix64(prefix * np.uint64(0xD6E8FEB86659FD93) + trees[:, :, k])
                flat = pa.array(prefix.reshape(-1).view(np.int64))
                bits = np.ascontiguousarray(sig.astype(np.uint16)).tobytes()
                width = 2 * len(_MULTIPLIERS)
                yield pa.RecordBatch.from_arrays([
                    batch.column("row").slice(i, j - i), batch.column("doc_id").slice(i, j - i),
                    pa.array(n, pa.int32()), pa.array(np.ascontiguousarray(keys[:, 0]).view(np.int64)),
                    pa.array(np.ascontiguousarray(keys[:, 1]).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1) * TREES, pa.int32()), flat),
                    pa.array([bits[x * width:(x + 1) * width] for x in range(j - i)], pa.binary()),
                ], names=[c.split()[0] for c in _SIGNED.split(", ")])

    return sign


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], most: int = 20_000) -> Iterator[pa.Table]:
    """Tables of whole groups (rows sorted by ``keys``), several small groups to a table."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < most:
            continue
        table = pa.Table.from_batches(held)
        last = np.ones(table.num_rows, bool)
        for k in keys:
            c = table.column(k).to_numpy()
            last &= c == c[-1]
        cut = int(np.argmax(last))  # the last group may go on in the next batch
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        if table.num_rows:
            yield table


def _bounds(table: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for k in keys:
        c = table.column(k).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def _meet(threshold: float):
    """Classes under a common prefix -> stars of those that may be similar enough."""
    least = (threshold - SLACK) * len(_MULTIPLIERS)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ("prefix", "x", "y")):
            at = _bounds(table, ("prefix", "x", "y"))
            ids = table.column("row").to_numpy()
            sig = np.frombuffer(utf8(table.column("signature"))[0].tobytes(), np.uint16).reshape(-1, len(_MULTIPLIERS))
            a, b = [], []
            size = np.diff(at)
            small = np.flatnonzero((size > 1) & (size <= 16))
            for gap in range(1, 16):  # pairs of small groups, by distance
                some = small[size[small] > gap]
                i = ranges(at[some], size[some] - gap)
                ok = (sig[i] == sig[i + gap]).sum(1) >= least
                a.append(i[ok])
                b.append(i[ok] + gap)
            for g in np.flatnonzero(size > 16):
                s = sig[at[g]:at[g + 1]]
                for i in range(0, len(s), 64):
                    same = np.zeros((len(s[i:i + 64]), len(s)), np.int16)
                    for k in range(s.shape[1]):
                        same += s[i:i + 64, k, None] == s[None, :, k]
                    p, q = np.nonzero(same >= least)
                    keep = p + i < q
                    a.append(p[keep] + i + at[g])
                    b.append(q[keep] + at[g])
            label = local_labels(len(ids), np.concatenate(a), np.concatenate(b))
            tied = np.flatnonzero(label != np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[tied]), pa.array(ids[label[tied]])], names=["u", "v"])

    return meet


def _block_pairs(members: DataFrame, size: str) -> DataFrame:
    """Adds block numbers x <= y: one pair of blocks per row up to BLOCK members, else the
    member's block with every block of its group."""
    n = F.ceil(F.col(size) / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("row"), n).cast("int")
    return members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1))).withColumn(
        "x", F.least("mine", "other")).withColumn("y", F.greatest("mine", "other"))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> packed shingle sets."""
    for batch in batches:
        data, offs = utf8(batch.column("text"))
        for i, j in slices(offs, SLICE_BYTES):
            h, at = shingle_sets(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            blobs = [pack_sorted(h[p:q]) for p, q in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").slice(i, j - i), batch.column("label").slice(i, j - i),
                 batch.column("docs").slice(i, j - i), batch.column("members").slice(i, j - i), pa.array(blobs, pa.binary())],
                names=["row", "label", "docs", "members", "shingles"])


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs of ``sets`` (sorted distinct hashes) with Jaccard >= threshold."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    _, kind, times = np.unique(every, return_inverse=True, return_counts=True)
    shared = times > 1  # a shingle of one set meets no other
    number = np.cumsum(shared) - 1
    on = shared[kind]
    owner, column = owner[on], number[kind[on]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((n, n), np.float32)
    total = int(shared.sum())
    for c in range(0, total, _COLUMNS):
        lo, hi = np.searchsorted(column, (c, c + _COLUMNS))
        part = np.zeros((n, min(_COLUMNS, total - c)), np.float32)
        part[owner[lo:hi], column[lo:hi] - c] = 1
        common += part @ part.T
    np.fill_diagonal(common, 0)
    either = size[:, None] + size[None, :] - common
    return (common >= threshold * either - 1e-3) & (common.astype(np.float64) / np.maximum(either, 1) >= threshold - 1e-12)


def _verify(threshold: float):
    """Exact links of every pair of a group's block pair: counts per class, and stars."""
    keys = ("label", "x", "y")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, keys, most=2_000):
            at = _bounds(table, keys)
            row, docs, mine, x, y = (table.column(c).to_numpy() for c in ("row", "docs", "mine", "x", "y"))
            blobs = table.column("shingles")
            out = []
            for i, j in zip(at[:-1], at[1:]):
                link = similar([unpack_sorted(b.as_py()) for b in blobs[i:j]], threshold)
                if x[i] != y[i]:  # pairs inside a block are counted with the block itself
                    link &= mine[i:j, None] != mine[None, i:j]
                a, b = np.nonzero(link)
                label = local_labels(j - i, a, b)
                out.append((row[i:j], row[i:j][label], link.sum(1), link @ docs[i:j]))
            cols = [np.concatenate(c) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols],
                                             names=["u", "v", "linked_texts", "linked_docs"])

    return verify


def join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: row, doc_id, class_id, keeper (the class's row that stays), n_links
    (other documents at the threshold or above) and n_linked_texts (their distinct shingle sets,
    its own not counted)."""
    return _join(stored_rows(docs, "doc_id", "text"), threshold)


def _join(stored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``join`` of the rows of ``stored_rows``."""
    spark = stored.sparkSession
    ship(spark)
    shared_dir(spark)
    n = shuffle_partitions(spark)
    numbered = stored.select("row", F.col("whole.doc_id").cast("long").alias("doc_id"), F.col("whole.text").alias("text"))
    signed = numbered.mapInArrow(_sign(prefix_depth(threshold)), _SIGNED).checkpoint()

    same = ["key_a", "key_b", "n_shingles"]
    first = signed.where("n_shingles > 0").groupBy(*same).agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("docs"))
    held = signed.select("row", "prefixes", "signature")
    spread = first.select("row").join(held.select("row", F.explode("prefixes").alias("prefix")), "row")
    crowded = spread.groupBy("prefix").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = spread.join(crowded, "prefix").join(held.select("row", "signature"), "row")
    meeting = _block_pairs(members, "members").select("prefix", "x", "y", "row", "signature").repartition(
        n, "prefix", "x", "y").sortWithinPartitions("prefix", "x", "y")
    groups = connected(meeting.mapInArrow(_meet(threshold), "u long, v long")).checkpoint()

    sizes = groups.groupBy("label").agg(F.count(F.lit(1)).alias("members"))
    candidates = groups.join(sizes, "label").withColumnRenamed("node", "row").join(first.select("row", "docs"), "row")
    sets = candidates.join(numbered.select("row", "text"), "row").select(
        "row", "label", "docs", "members", "text").mapInArrow(
            _sets, "row long, label long, docs long, members long, shingles binary")
    paired = _block_pairs(sets, "members").select("label", "x", "y", "mine", "row", "docs", "shingles").repartition(
        n, "label", "x", "y").sortWithinPartitions("label", "x", "y")
    links = paired.mapInArrow(_verify(threshold), "u long, v long, linked_texts long, linked_docs long").checkpoint()
    counts = links.groupBy(F.col("u").alias("row")).agg(
        F.sum("linked_texts").alias("linked_texts"), F.sum("linked_docs").alias("linked_docs"))
    labels = connected(links.select("u", "v"))

    classes = (first.join(counts, "row", "left").join(labels.withColumnRenamed("node", "row"), "row", "left")
               .select(*same, "docs", F.coalesce("label", "row").alias("class_row"),
                       F.coalesce("linked_texts", F.lit(0)).alias("linked_texts"),
                       F.coalesce("linked_docs", F.lit(0)).alias("linked_docs")))
    placed = signed.select("row", "doc_id", *same).join(classes, same, "left").select(
        "row", "doc_id", F.coalesce("class_row", "row").alias("class_row"),
        (F.coalesce(F.col("docs") - 1, F.lit(0)) + F.coalesce("linked_docs", F.lit(0))).alias("n_links"),
        F.coalesce("linked_texts", F.lit(0)).alias("n_linked_texts"))
    keeper = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("keeper")
    named = placed.groupBy("class_row").agg(keeper)
    return placed.join(named, "class_row").select(
        "row", "doc_id", F.col("keeper.doc_id").alias("class_id"), F.col("keeper.row").alias("keeper"),
        "n_links", "n_linked_texts")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, n_linked_texts."""
    return join(docs.select("doc_id", "text")).select("doc_id", "class_id", "n_links", "n_linked_texts")


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, all columns."""
    stored = stored_rows(docs)
    stay = _join(stored).where("row = keeper").select("row")
    return stored.join(stay, "row").select("whole.*")
