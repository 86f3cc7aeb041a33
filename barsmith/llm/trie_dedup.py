"""Exact dedup: Patricia tries own each distinct text (operator 4).

Texts are equal when identical after deleting every character of
``[\\x20\\x09-\\x0D]``.  Of equal texts the row with the most code points in
its original text stays, then the smallest doc_id.

1. Each task normalises its texts and inserts them into a trie that holds up to
   ``TASK_BYTES``, so a group of copies leaves a task as one row (with its size
   and best row) each time the trie is emptied, however large the group is.
   These rows are stored until their owners are.  A text that has more than ``HOT`` of them, because
   very many tasks hold copies, is merged by salted (length, hash) first, so no
   task is sent all its bodies.
2. The rows are hash-partitioned by (length, content hash) and arrive sorted
   by it.  Each task inserts ``length + hash + full bytes`` into a compressed
   radix trie whose terminal nodes hold the best row and the count.  When the
   trie exceeds its byte budget, the subtrees of all keys before the current
   one are complete -- rows arrive in key order -- so they are emitted and
   dropped: memory is bounded, and Spark's sort does the spilling.
3. Owners are joined back to the documents by the SHA-256 of the normalised
   text; AQE splits that join where one text has very many copies.

Null text counts as empty.  A null doc_id sorts after all others.  Rows that
repeat a kept row (same doc_id, same text) are all reported as kept, and
``dedup`` returns one of them, by a hash of their columns: reruns agree.  Extra columns pass through ``dedup``.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm.runtime import SPACE_BYTES, release, ship, shuffle_partitions, stored, text_or_empty, utf8
from barsmith.session import drop_path, scratch_path

TRIE_BYTES = 32 << 20
TASK_BYTES = 16 << 20
HOT = 500   # rows of one text, each from another emptied trie, that may go to one task
SALTS = 64
BROADCAST = 100_000  # hot texts, of about 90 bytes each, that are broadcast
_LAST = 1 << 63  # stands for a null doc_id: after all others

_GROUP_DDL = ("text_len long, text_hash long, body binary, text_sha256 string, "
              "best_chars long, best_id long, n_best long, n long")
_OWNER_DDL = "text_sha256 string, keep_id long, keep_chars long, n_best long, group_size long"


class RadixTrie:
    """Compressed radix trie over byte strings; a terminal holds any value."""

    def __init__(self) -> None:
        self.children: dict[int, list] = {}  # first byte -> [label, children, value]
        self.bytes = 0

    def insert(self, key: bytes, value, merge) -> None:
        """Store ``value`` at ``key``; a present one becomes ``merge(old, value)``."""
        level, at = self.children, 0
        while True:
            node = level.get(key[at])
            if node is None:
                level[key[at]] = [key[at:], None, value]
                self.bytes += len(key) - at
                return
            label = node[0]
            if not key.startswith(label, at):
                same = _common(label, key, at)
                # split the edge: the old node goes below the shared part
                below = [label[same:], node[1], node[2]]
                node[0], node[1], node[2] = label[:same], {label[same]: below}, None
                label = node[0]
            at += len(label)
            if at == len(key):
                node[2] = value if node[2] is None else merge(node[2], value)
                return
            if node[1] is None:
                node[1] = {}
            level = node[1]

    def items(self, level=None, prefix: bytes = b""):
        """(key, value) in key order."""
        todo = [(self.children if level is None else level, prefix, None)]
        while todo:
            level, prefix, keys = todo.pop()
            keys = iter(sorted(level)) if keys is None else keys
            for k in keys:
                label, below, value = level[k]
                key = prefix + label
                if value is not None:
                    yield key, value
                if below:
                    todo.append((level, prefix, keys))
                    todo.append((below, key, None))
                    break


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the longest prefix of ``label`` found in ``key`` at ``at``."""
    lo, hi = 0, min(len(label), len(key) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if label[lo:mid] == key[at + lo:at + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _merge(a: tuple, b: tuple) -> tuple:
    """Values (minus code points, doc_id, rows equal to that best, rows, digest)."""
    if a[:2] == b[:2]:
        return (*a[:2], a[2] + b[2], a[3] + b[3], a[4])
    best, other = (a, b) if a[:2] < b[:2] else (b, a)
    return (*best[:3], best[3] + other[3], best[4])


def _key(body: bytes, digest: bytes) -> bytes:
    return struct.pack(">Q", len(body)) + digest[:8] + body


def _id(i: int) -> int | None:
    return None if i == _LAST else i


def _groups(trie: RadixTrie) -> pa.RecordBatch:
    """A trie's texts as rows: how they are sent and stored."""
    out = list(trie.items())
    return pa.RecordBatch.from_arrays([
        pa.array([len(k) - 16 for k, _ in out], pa.int64()),
        pa.array([struct.unpack(">q", k[8:16])[0] for k, _ in out], pa.int64()),
        pa.array([k[16:] for k, _ in out], pa.binary()),
        pa.array([v[4].hex() for _, v in out], pa.string()),
        pa.array([-v[0] for _, v in out], pa.int64()),
        pa.array([_id(v[1]) for _, v in out], pa.int64()),
        pa.array([v[2] for _, v in out], pa.int64()),
        pa.array([v[3] for _, v in out], pa.int64()),
    ], names=[c.split()[0] for c in _GROUP_DDL.split(", ")])


def _owners(trie: RadixTrie) -> pa.RecordBatch:
    """A trie's texts as owner rows."""
    values = [v for _, v in trie.items()]
    return pa.RecordBatch.from_arrays([
        pa.array([v[4].hex() for v in values], pa.string()),
        pa.array([_id(v[1]) for v in values], pa.int64()),
        pa.array([-v[0] for v in values], pa.int64()),
        pa.array([v[2] for v in values], pa.int64()),
        pa.array([v[3] for v in values], pa.int64()),
    ], names=[c.split()[0] for c in _OWNER_DDL.split(", ")])


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents -> one row per distinct normalised text, each time the trie is full."""
    trie = RadixTrie()
    for batch in batches:
        release()
        data, offs = utf8(batch.column("text"))
        raw = data.tobytes()
        chars = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
        for i, doc in enumerate(batch.column("doc_id").to_pylist()):
            body = raw[offs[i]:offs[i + 1]].translate(None, SPACE_BYTES)
            digest = hashlib.sha256(body).digest()
            trie.insert(_key(body, digest), (-chars[i], _LAST if doc is None else doc, 1, 1, digest), _merge)
            if trie.bytes > TASK_BYTES:
                yield _groups(trie)
                trie = RadixTrie()
    if trie.children:
        yield _groups(trie)


def _merging(emit):
    """Rows sorted by (length, hash) -> ``emit`` of their merged texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, last = RadixTrie(), None
        for batch in batches:
            for r in batch.to_pylist():
                prefix = (r["text_len"], r["text_hash"])
                if prefix != last and trie.bytes > TRIE_BYTES:
                    yield emit(trie)
                    trie = RadixTrie()
                last = prefix
                digest = bytes.fromhex(r["text_sha256"])
                doc = _LAST if r["best_id"] is None else r["best_id"]
                trie.insert(_key(r["body"], digest), (-r["best_chars"], doc, r["n_best"], r["n"], digest), _merge)
        if trie.children:
            yield emit(trie)

    return run


_own = _merging(_owners)


def text_digest(c: str = "text"):
    """SHA-256 (hex) of the normalised text, as a JVM expression."""
    return F.sha2(F.translate(text_or_empty(c), SPACE_BYTES.decode(), ""), 256)


def owners(docs: DataFrame) -> DataFrame:
    """One row per distinct text: its digest, the row that stays, the group's size."""
    ship(docs.sparkSession)
    spark = docs.sparkSession
    n, path = shuffle_partitions(spark), scratch_path(spark, "texts")
    docs.select(_doc_id(), "text").mapInArrow(_collapse, _GROUP_DDL).write.option("compression", "zstd").parquet(path)
    groups = spark.read.schema(_GROUP_DDL).parquet(path)
    by_text = ["text_len", "text_hash", "text_sha256"]
    hot = stored(groups.groupBy(*by_text).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > HOT).select(*by_text), "hot")
    some = hot.count()
    if not some:
        keyed = groups
    else:  # too many to broadcast: all rows take the way over the salt
        few = some <= BROADCAST
        chosen = groups.join(F.broadcast(hot), by_text, "left_semi") if few else groups
        merged = (chosen.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
                  .repartition(n, "text_len", "text_hash", "salt").sortWithinPartitions("text_len", "text_hash")
                  .mapInArrow(_merging(_groups), _GROUP_DDL))
        rest = groups.join(F.broadcast(hot), by_text, "left_anti") if few else groups.where("false")
        keyed = rest.select(*merged.columns).union(merged)
    keyed = keyed.repartition(n, "text_len", "text_hash").sortWithinPartitions("text_len", "text_hash")
    own = stored(keyed.mapInArrow(_own, _OWNER_DDL), "owners")
    drop_path(spark, path)  # the bodies; owners hold digests
    return own


def _doc_id():
    return F.col("doc_id").cast("long").alias("doc_id")


def _stays(doc_id, chars):
    return doc_id.eqNullSafe(F.col("keep_id")) & (chars == F.col("keep_chars"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    members = docs.select(_doc_id(), F.length(text_or_empty()).alias("__chars"), text_digest().alias("text_sha256"))
    return members.join(owners(docs), "text_sha256").select(
        "doc_id", "keep_id", "group_size", _stays(F.col("doc_id"), F.col("__chars")).alias("kept"), "text_sha256")


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one per distinct text, with all their columns.

    Only where the row that stays is itself repeated must one be chosen; that
    aggregate moves those rows alone.
    """
    cols = [F.col(f"`{c}`") for c in docs.columns]
    row = F.struct(*cols).alias("__row")
    mine = docs.select(row, _doc_id().alias("__id"), F.length(text_or_empty()).alias("__chars"),
                       text_digest().alias("__sha"))
    own = owners(docs)
    stay = mine.join(own, mine["__sha"] == own["text_sha256"]).where(_stays(F.col("__id"), F.col("__chars")))
    order = F.xxhash64(*[F.col(f"__row.`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)])
    again = stay.where("n_best > 1").groupBy("__sha").agg(F.min_by("__row", order).alias("__row"))
    return stay.where("n_best = 1").select("__row").unionByName(again.select("__row")).select("__row.*")
