"""Anchored windows: which windows of L units may occur elsewhere?

Each window of ``span`` consecutive units (bytes or words) is keyed by its
*anchor*: the q-gram with the smallest hash inside it, leftmost on ties.
Equal windows have equal anchors at equal offsets, and neighbouring windows
mostly share theirs, so a text has far fewer anchors than windows.  Blocks ask
the buckets which anchor keys occur again (``ask_repeated``); only windows of
such anchors need a closer look, and their texts alone travel, as *contexts*:
the units from an anchor's first window to the end of its last.

Equal contexts travel once per block.  An anchor whose contexts differ from
document to document (the ends of a line that very many documents share) is
*hot*: its windows travel one by one, keyed by their own hash.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa

from barsmith.llm.blocks import bucket_rows, key_blob
from barsmith.llm.runtime import pack, unpack, unpack_sorted
from barsmith.llm.wordhash import window_hashes

ASK = "bucket int, g int, keys binary, multi binary, contexts binary"
HOT = 1000  # contexts of one anchor, beyond two a block, that may meet in one bucket
REPEATED = "g int, bucket int, bits binary"


@dataclass
class Anchors:
    key: np.ndarray    # uint64
    at: np.ndarray     # unit position of the anchor
    first: np.ndarray  # its windows start at first .. last
    last: np.ndarray
    doc: np.ndarray    # document number

    def take(self, i) -> "Anchors":
        return Anchors(*[getattr(self, f.name)[i] for f in fields(self)])

    def moved(self, units: int, docs: int) -> "Anchors":
        """Positions as they are ``units`` and ``docs`` further on."""
        return Anchors(self.key, self.at + units, self.first + units, self.last + units, self.doc + docs)

    @staticmethod
    def join(parts: list["Anchors"]) -> "Anchors":
        return Anchors(*[np.concatenate([getattr(p, f.name) for p in parts]) for f in fields(Anchors)])


def find_anchors(units: np.ndarray, docs: np.ndarray, span: int, gram: int) -> Anchors:
    """Anchors of the documents units[docs[d]:docs[d + 1]]; ``units`` are 64-bit hashes."""
    n = len(units) - span + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return Anchors(np.zeros(0, np.uint64), none, none, none, none)
    grams = window_hashes(units, gram)
    low = np.uint64(0xFFFFFFFF)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width, cover = span - gram + 1, 1
    while cover * 2 <= width:
        least = np.minimum(least[:-cover], least[cover:])
        cover *= 2
    if cover < width:
        least = np.minimum(least[:len(least) - (width - cover)], least[width - cover:])
    inside = np.arange(n) + span <= np.repeat(docs[1:], np.diff(docs))[:n]
    start = np.flatnonzero(inside)
    if not len(start):
        return Anchors(np.zeros(0, np.uint64), none, none, none, none)
    at = (least[start] & low).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(start)) - 1
    return Anchors(grams[at[head]], at[head], start[head], start[tail],
                   np.searchsorted(docs, start[head], "right") - 1)


def ask_repeated(keys: np.ndarray, owner: np.ndarray | None, kind: np.ndarray, g: int, n_buckets: int) -> pa.Table:
    """One row per bucket: the block's distinct keys, which of them already occur twice in the block
    (under different owners, if ``owner`` is given), and how many contexts (``kind``) each has."""
    order = np.lexsort((kind, keys))
    ordered, kinds = keys[order], kind[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    head = np.flatnonzero(new)
    contexts = new.copy()
    contexts[1:] |= kinds[1:] != kinds[:-1]
    if not len(head):
        multi, n = np.zeros(0, bool), np.zeros(0, np.uint32)
    else:
        n = np.add.reduceat(contexts, head, dtype=np.uint32)
        if owner is None:
            multi = np.diff(np.append(head, len(keys))) > 1
        else:
            mine = owner[order]
            multi = np.minimum.reduceat(mine, head) != np.maximum.reduceat(mine, head)
    distinct = ordered[head]
    rows = [(b, key_blob(distinct[s]), np.packbits(multi[s]).tobytes(), pack(n[s])) for b, s in bucket_rows(distinct, n_buckets)]
    return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "g": pa.array([g] * len(rows), pa.int32()),
                     "keys": pa.array([r[1] for r in rows], pa.binary()), "multi": pa.array([r[2] for r in rows], pa.binary()),
                     "contexts": pa.array([r[3] for r in rows], pa.binary())})


def find_repeated(table: pa.Table) -> pa.Table:
    """A bucket's answer: for each block, two bits per key it asked about: does the anchor occur
    again, and has it so many different contexts (``HOT``) that its windows must part ways?"""
    asked = [unpack_sorted(b) for b in table.column("keys").to_pylist()]
    multi = [np.unpackbits(np.frombuffer(b, np.uint8))[:len(a)] for a, b in zip(asked, table.column("multi").to_pylist())]
    n = np.concatenate([unpack(b, np.uint32) for b in table.column("contexts").to_pylist()])
    distinct, place = np.unique(np.concatenate(asked), return_inverse=True)
    seen = np.bincount(place, weights=1 + np.concatenate(multi), minlength=len(distinct)) > 1
    blocks = np.bincount(place, minlength=len(distinct))
    contexts = np.bincount(place, weights=n, minlength=len(distinct))
    hot = (contexts > HOT) & (contexts > 2 * blocks)
    ends = np.cumsum([len(a) for a in asked])
    bits = [np.packbits(np.concatenate([seen[place[e - len(a):e]], hot[place[e - len(a):e]]])).tobytes()
            for a, e in zip(asked, ends)]
    return pa.table({"g": table.column("g"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})


def repeated_of(keys: np.ndarray, answers: pa.Table, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the block's ``keys`` (one per anchor) occur again, and which are hot."""
    distinct, place = np.unique(keys, return_inverse=True)
    told = np.zeros((2, len(distinct)), bool)
    bits = dict(zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()))
    for b, s in bucket_rows(distinct, n_buckets):
        n = s.stop - s.start
        told[:, s] = np.unpackbits(np.frombuffer(bits[b], np.uint8))[:2 * n].reshape(2, n)
    return told[0][place], told[1][place]


def part_windows(a: Anchors, hot: np.ndarray, window_hash) -> Anchors:
    """Anchors with each window of a hot one as an anchor of its own, keyed by the window itself:
    however many contexts the anchor has, equal windows meet and different ones spread.

    ``window_hash(starts)`` hashes whole windows."""
    hot_ones = np.flatnonzero(hot)
    size = (a.last - a.first + 1)[hot_ones]
    start = ranges(a.first[hot_ones], size)
    which = np.repeat(hot_ones, size)
    own = Anchors(window_hash(start), a.at[which], start, start, a.doc[which])
    return Anchors.join([a.take(np.flatnonzero(~hot)), own])


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenation of first[i] .. first[i] + size[i] - 1."""
    ends = np.cumsum(size)
    n = int(ends[-1]) if len(ends) else 0
    return np.arange(n) + np.repeat(first - (ends - size), size)
