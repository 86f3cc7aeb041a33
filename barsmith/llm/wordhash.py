"""Vectorised words of Arrow text: 64-bit hashes, windows, coverage.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]``.  Hashes are
polynomials modulo 2**64 over random byte values, finalised with ``mix64``:
equal words have equal hashes everywhere, in every task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from barsmith.llm.runtime import SPACE_BYTES, mix64, slices

SLICE_BYTES = 1 << 19  # text handled at a time: its arrays stay in the CPU's cache

_P = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2**64
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACE_BYTES)] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def powers(n: int, base: int = _P) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for later calls."""
    key = f"{base}"
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(n, 1024)
        out = np.empty(size, np.uint64)
        out[0], done = 1, 1
        while done < size:  # doubling: the next block is the last one times base**done
            step = np.uint64(pow(base, done, 1 << 64))
            more = min(done, size - done)
            out[done:done + more] = out[:more] * step
            done += more
        _powers[key] = have = out
    return have[:n]


@dataclass
class Words:
    hashes: np.ndarray  # uint64, one per word
    starts: np.ndarray  # byte position of each word in the slice
    ends: np.ndarray
    docs: np.ndarray    # word range of document d: docs[d] .. docs[d + 1]

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.docs) - 1), np.diff(self.docs))


def words(data: np.ndarray, offs: np.ndarray, lower: bool = False) -> Words:
    """Words of the documents data[offs[d]:offs[d+1]] (offs[0] must be 0)."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(offs), np.int64))
    inside = np.zeros(n + 2, bool)
    np.logical_not(_SPACE[data], out=inside[1:-1])
    cut = offs[1:-1]  # a word ends where its document does
    edges = inside[1:] != inside[:-1]
    starts = np.flatnonzero(edges & inside[1:])
    ends = np.flatnonzero(edges & inside[:-1])
    cut = np.unique(cut[(cut > 0) & (cut < n)])
    cut = cut[inside[cut] & inside[cut + 1]]
    if len(cut):  # words that run on across a document boundary
        starts = np.sort(np.concatenate([starts, cut]))
        ends = np.sort(np.concatenate([ends, cut]))
    return Words(span_hashes(data, starts, ends, lower), starts, ends, np.searchsorted(starts, offs))


def words_of_all(data: np.ndarray, offs: np.ndarray) -> Words:
    """``words`` of many documents, taken slice by slice to bound the memory."""
    parts, upto = [], 0
    for i, j in slices(offs, SLICE_BYTES):
        w = words(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        parts.append((w.hashes, w.starts + offs[i], w.ends + offs[i], w.docs[:-1] + upto))
        upto += len(w.hashes)
    if not parts:
        return words(data, offs)
    hashes, starts, ends, docs = (np.concatenate(p) for p in zip(*parts))
    return Words(hashes, starts, ends, np.append(docs, upto))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hash of each byte span data[starts[i]:ends[i]]."""
    table = _BYTE[_LOWER] if lower else _BYTE
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(table[data] * powers(len(data)), out=sums[1:])
    inverse = powers(len(data) + 1, pow(_P, -1, 1 << 64))
    return mix64((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every window of ``k`` consecutive entries of ``h`` (mod 2**64 polynomial)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    part, length, out, at = h, 1, None, 0
    while True:  # binary composition: windows of 1, 2, 4, ... entries
        if k & length:
            if out is None:
                out = part.copy()
            else:
                m = len(part) - at
                out = out[:m] * np.uint64(pow(_P, length, 1 << 64)) + part[at:at + m]
            at += length
        length *= 2
        if length > k:
            return mix64(out[:n])
        half = length // 2
        part = part[:-half] * np.uint64(pow(_P, half, 1 << 64)) + part[half:]


def whole_windows(w: Words, k: int) -> np.ndarray:
    """Start positions (word index) of the windows of ``k`` words inside one document."""
    room = np.diff(w.docs)
    ok = np.ones(max(len(w.hashes) - k + 1, 0), bool)
    for a, b, r in zip(w.docs[:-1], w.docs[1:], room):
        ok[max(a, b - k + 1):b] = False
    return np.flatnonzero(ok)


def covered(n: int, starts: np.ndarray, k: int) -> np.ndarray:
    """Which of ``n`` positions lie in a window of ``k`` beginning at one of ``starts``."""
    return under_spans(n, starts, np.minimum(starts + k, n))


def under_spans(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` positions lie in one of the spans starts[i] .. ends[i] - 1."""
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, starts, 1)
    np.subtract.at(depth, ends, 1)
    return np.cumsum(depth[:-1], dtype=np.int32, out=depth[:-1]) > 0


def per_doc(values: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each document's range."""
    out = np.zeros(len(docs) - 1, np.int64)
    some = docs[1:] > docs[:-1]
    if some.any():
        out[some] = np.add.reduceat(values, docs[:-1][some], dtype=np.int64)
    return out
