"""Substring dedup over bytes with longest-previous-factor arrays (operator 3).

Every byte covered by a ``SPAN``-byte string that also starts in a document
with a smaller doc_id is removed; strings are judged on the input.

1. Blocks of documents find the anchors of their windows (see ``anchors``) and
   learn which anchors occur in another document.
2. Only contexts of such anchors travel, once per block for equal contexts,
   with the smallest doc_id of the block that holds them.
3. A bucket sorts the suffixes of its contexts (first ``SPAN`` bytes decide;
   ties by document), computes the LCP of neighbours and, by previous and next
   smaller documents in suffix order, the longest previous factor of each
   suffix.  LPF = SPAN marks a window that starts in an earlier document.
4. The blocks read the marks back and remove what the marked windows cover.

Bytes of contexts are compared in full.  A context that very many documents
share arrives once per block.  Null text counts as empty; a null doc_id is
larger than all others; rows that repeat a doc_id are not earlier than each
other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.anchors import (ASK, REPEATED, Anchors, ask_repeated, find_anchors, find_repeated, part_windows,
                                  ranges, repeated_of)
from barsmith.llm.blocks import blocked, bucket_rows, tidy
from barsmith.llm.runtime import mix64, pack, slices, unpack, utf8
from barsmith.llm.wordhash import _BYTE, SLICE_BYTES, per_doc, span_hashes, under_spans

SPAN = 50
GRAM = 20
SORT_WINDOWS = 40_000  # windows sorted at a time
_LAST = np.iinfo(np.int64).max  # a null doc_id
_CONTEXTS = "bucket int, g int, keys binary, lead binary, size binary, owner binary, bytes binary"


def _doc_ids(column) -> np.ndarray:
    return np.array([_LAST if d is None else d for d in column.to_pylist()], np.int64)


def _anchors(data: np.ndarray, offs: np.ndarray) -> tuple[Anchors, np.ndarray]:
    """Anchors of a whole block, found slice by slice, and a hash of each one's context."""
    parts, kinds = [], []
    for i, j in slices(offs, SLICE_BYTES):
        part = data[offs[i]:offs[j]]
        a = find_anchors(_BYTE[part], offs[i:j + 1] - offs[i], SPAN, GRAM)
        kinds.append(_kind(part, a.first, a.last + SPAN, a.at - a.first))
        parts.append(a.moved(offs[i], i))
    return Anchors.join(parts), np.concatenate(kinds)


def _kind(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Contexts are equal if their bytes are, and the anchor's place in them."""
    return mix64(span_hashes(data, starts, ends) + lead.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _kinds(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """``_kind`` of spans anywhere in a block, by the slice of text that they start in."""
    out = np.empty(len(starts), np.uint64)
    slot = starts // SLICE_BYTES
    order = np.argsort(slot, kind="stable")
    at = np.searchsorted(slot[order], np.arange(int(slot.max()) + 2 if len(slot) else 0))
    for i, j in zip(at[:-1], at[1:]):
        some = order[i:j]
        if len(some):
            base = starts[some].min()
            out[some] = _kind(data[base:ends[some].max()], starts[some] - base, ends[some] - base, lead[some])
    return out


class _Contexts:
    """Distinct contexts of a block's repeated anchors, in key order, and which one each anchor has."""

    def __init__(self, a: Anchors, kind: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((ids[a.doc], kind, a.key))  # the smallest doc_id of equal contexts comes first
        new = np.ones(len(order), bool)
        new[1:] = (a.key[order[1:]] != a.key[order[:-1]]) | (kind[order[1:]] != kind[order[:-1]])
        self.a, self.head = a, order[new]  # one anchor for each distinct context
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.owner = ids[a.doc[self.head]]
        self.windows = (a.last - a.first + 1)[self.head]


def _repeats(docs: pa.Table, told: pa.Table, n_buckets: int):
    """(data, offs, doc_ids, contexts of the anchors that occur again) of a block."""
    data, offs = utf8(docs.column("text"))
    ids = _doc_ids(docs.column("doc_id"))
    a, _ = _anchors(data, offs)
    again, hot = repeated_of(a.key, told, n_buckets)
    a = a.take(again)
    if hot[again].any():
        a = part_windows(a, hot[again], lambda s: _kinds(data, s, s + SPAN, np.zeros(len(s), np.int64)))
    return data, offs, ids, _Contexts(a, _kinds(data, a.first, a.last + SPAN, a.at - a.first), ids)


def _ask(n_buckets: int):
    def ask(docs: pa.Table) -> pa.Table:
        data, offs = utf8(docs.column("text"))
        a, kind = _anchors(data, offs)
        return ask_repeated(a.key, _doc_ids(docs.column("doc_id"))[a.doc], kind, docs.column("g")[0].as_py(), n_buckets)

    return ask


def _send(n_buckets: int):
    def send(docs: pa.Table, told: pa.Table) -> pa.Table:
        rows = []
        if docs.num_rows and told.num_rows:
            import zstandard

            data, offs, ids, c = _repeats(docs, told, n_buckets)
            a, g = c.a.take(c.head), docs.column("g")[0].as_py()
            for b, s in bucket_rows(a.key, n_buckets):
                text = data[ranges(a.first[s], a.last[s] + SPAN - a.first[s])]
                rows.append((b, g, pack(a.key[s]), pack((a.at - a.first)[s].astype(np.uint8)),
                             pack(c.windows[s].astype(np.uint8)), pack(c.owner[s]),
                             zstandard.ZstdCompressor(level=1).compress(text.tobytes())))
        names = [x.split()[0] for x in _CONTEXTS.split(", ")]
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, types))})

    return send


def previous_smaller(value: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each i, the least lcp[j + 1 .. i] where j is the nearest position before i with a
    smaller value; 0 where there is none.  Pointer jumping: what lies between i and its
    candidate is never smaller, so candidates may skip to their own candidates."""
    n = len(value)
    at = np.arange(-1, n - 1)
    common = lcp.copy()
    todo = np.arange(n)
    while len(todo):
        todo = todo[at[todo] >= 0]
        todo = todo[(value[at[todo]] >= value[todo]) & (common[todo] > 0)]
        common[todo], at[todo] = np.minimum(common[todo], common[at[todo]]), at[at[todo]]
    common[at < 0] = 0
    return common


def longest_previous_factor(owner: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """LPF of suffixes in suffix order; lcp[i] is shared by suffixes i - 1 and i.

    A neighbour of a run with a smaller document is the earlier match."""
    after = np.concatenate([[0], lcp[:0:-1]]) if len(lcp) else lcp
    return np.maximum(previous_smaller(owner, lcp), previous_smaller(owner[::-1], after)[::-1])


def _earlier(key, lead, size, owner, data, offs):
    """Tells, for a run of contexts, a bit for each window: does it start in a document before the owner?

    Contexts that are equal share one place in the suffix order; its smallest owner stands for it."""
    n = len(key)
    kind = np.concatenate([_kind(data[offs[i]:offs[j]], offs[i:j] - offs[i], offs[i + 1:j + 1] - offs[i], lead[i:j])
                           for i, j in slices(offs, SLICE_BYTES)])
    order = np.lexsort((owner, kind, key))
    new = np.ones(n, bool)
    new[1:] = (key[order[1:]] != key[order[:-1]]) | (kind[order[1:]] != kind[order[:-1]])
    head = order[new]
    of = np.empty(n, np.int64)
    of[order] = np.cumsum(new) - 1
    # contexts whose anchor has no other context have no other match
    _, group, times = np.unique(key[head], return_inverse=True, return_counts=True)
    counts = size[head]
    at = np.concatenate([[0], np.cumsum(counts)])
    marks = np.zeros(int(at[-1]), bool)
    todo = np.flatnonzero(times[group] > 1)
    upto = np.concatenate([[0], np.cumsum(counts[todo])])
    i = 0
    while i < len(todo):  # whole anchors at a time
        j = int(np.searchsorted(upto, upto[i] + SORT_WINDOWS, "right")) - 1
        j = max(j, i + 1)
        while j < len(todo) and group[todo[j]] == group[todo[j - 1]]:
            j += 1
        part = todo[i:j]
        marks[ranges(at[part], counts[part])] = _lpf_marks(
            group[part], lead[head[part]], counts[part], owner[head[part]], offs[head[part]], data)
        i = j
    whole = owner > owner[head][of]  # an equal context in an earlier document

    def bits(s: slice) -> np.ndarray:
        return np.repeat(whole[s], size[s]) | marks[ranges(at[of[s]], size[s])]

    return bits


def _lpf_marks(group, lead, counts, owner, first, data) -> np.ndarray:
    """LPF = SPAN for every window of the contexts, in their order."""
    ctx = np.repeat(np.arange(len(group)), counts)
    step = ranges(np.zeros(len(counts), np.int64), counts)
    suffix = np.empty((len(ctx), SPAN + 5), np.uint8)
    suffix[:, :4] = group[ctx].astype(">u4").view(np.uint8).reshape(-1, 4)
    suffix[:, 4] = lead[ctx] - step  # equal windows have the anchor at the same offset
    suffix[:, 5:] = data[(first[ctx] + step)[:, None] + np.arange(SPAN)]
    by_owner = np.argsort(owner[ctx], kind="stable")
    order = by_owner[np.argsort(suffix[by_owner].reshape(-1).view(f"S{SPAN + 5}"), kind="stable")]
    differ = suffix[order[1:]] != suffix[order[:-1]]
    lcp = np.where(differ.any(1), differ.argmax(1) - 5, SPAN)
    lpf = longest_previous_factor(owner[ctx][order], np.concatenate([[0], np.maximum(lcp, 0)]))
    out = np.empty(len(ctx), bool)
    out[order] = lpf >= SPAN
    return out


def _resolve(table: pa.Table) -> pa.Table:
    import zstandard

    rows = table.select(["keys", "lead", "size", "owner", "bytes"]).to_pylist()
    key = [unpack(r["keys"], np.uint64) for r in rows]
    lead, size = (np.concatenate([unpack(r[c], np.uint8) for r in rows]).astype(np.int64) for c in ("lead", "size"))
    owner = np.concatenate([unpack(r["owner"], np.int64) for r in rows])
    data = np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(r["bytes"]), np.uint8) for r in rows])
    offs = np.concatenate([[0], np.cumsum(size + SPAN - 1)])
    earlier = _earlier(np.concatenate(key), lead, size, owner, data, offs)
    ends = np.cumsum([len(k) for k in key])
    bits = [np.packbits(earlier(slice(e - len(k), e))).tobytes() for k, e in zip(key, ends)]
    return pa.table({"g": table.column("g"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                  ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _digest(n_buckets: int, with_text: bool):
    schema = _OUT if with_text else pa.schema(list(_OUT)[:-1])

    def digest(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        kinds = told.column("kind").to_numpy()
        data, offs, ids, c = _repeats(docs, told.filter(pa.array(kinds == 0)), n_buckets)
        marks = np.zeros(int(c.windows.sum()), bool)
        at = np.concatenate([[0], np.cumsum(c.windows)])
        answers = told.filter(pa.array(kinds == 1))
        bits = dict(zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()))
        for b, s in bucket_rows(c.a.key[c.head], n_buckets):
            x, y = at[s.start], at[s.stop]
            marks[x:y] = np.unpackbits(np.frombuffer(bits[b], np.uint8))[:y - x]
        # an anchor's windows: those marked for its context, or all, if it is not in the context's first document
        size = c.windows[c.of]
        hit = marks[ranges(at[c.of], size)] | np.repeat(ids[c.a.doc] > c.owner[c.of], size)
        start = ranges(c.a.first, size)[hit]
        gone = under_spans(len(data), start, start + SPAN)
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = offs[:-1][offs[:-1] < len(data)]
        begins[inner] = gone[inner]
        removed, spans = per_doc(gone, offs), per_doc(begins, offs)
        left = np.concatenate([[0], np.cumsum(np.diff(offs) - removed)])
        raw = data[~gone].tobytes()
        kept = [raw[x:y] for x, y in zip(left[:-1], left[1:])]
        cols = [docs.column("doc_id"), pa.array(np.diff(offs)), pa.array(removed), pa.array(spans),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
        if with_text:
            cols.append(pa.array(kept, pa.binary()))
        return pa.table(cols, names=schema.names)

    return digest


def dedup(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the bytes kept."""
    blocks, n, _ = blocked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    asked = blocks.groupBy("g").applyInArrow(tidy(_ask(n)), ASK)
    again = asked.groupBy("bucket").applyInArrow(tidy(find_repeated), REPEATED)
    contexts = blocks.groupBy("g").cogroup(again.groupBy("g")).applyInArrow(tidy(_send(n)), _CONTEXTS)
    earlier = contexts.groupBy("bucket").applyInArrow(tidy(_resolve), REPEATED)
    told = again.withColumn("kind", F.lit(0)).unionByName(earlier.withColumn("kind", F.lit(1)))
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return blocks.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(
        tidy(_digest(n, with_text)), ddl + (", kept binary" if with_text else ""))


def report(docs: DataFrame) -> DataFrame:
    return dedup(docs, with_text=False)
