"""Periodic runs of words, found in a Re-Pair grammar (operator 13).

A run is a stretch of consecutive words of smallest period q and of at least
``max(LEAST, 2 q)`` words that no neighbouring word extends.  Texts are
independent of each other, so they are read once, in slices, without a shuffle;
per slice and on whole arrays:

1. **Re-Pair.**  Adjacent symbols of a document that occur twice or more become
   a nonterminal.  In one step every occurrence is replaced whose pair is more
   frequent than the two it overlaps (ties: a fixed order; ``aaaa`` takes every
   other place), so the most frequent pair always goes, and pairs that do not
   touch go together.  A pair seen once never comes back and is left out of
   later steps.  What remains is the start rule, cut into a balanced tree.
2. **Boundary runs.**  Every nonterminal is looked at once, at one occurrence:
   runs that cross the boundary of its two halves, inside its expansion.  A run
   has six equal words in a row at distance q, three of them on one side of the
   boundary, so q is the distance from the boundary to another occurrence of the
   three words beside it; extensions are found by binary search over prefix
   hashes.  Of several periods of one stretch the smallest counts.
3. **Translation.**  The replaced places are all positions of a nonterminal in
   the derivation; its runs move there.  Every run of the text lies inside, and
   crosses the boundary of, exactly one node of the derivation, so it is found
   whole; stretches of the same period inside it are merged into it.

A document without five repeated pairs in a row cannot hold six equal words at
a distance twice; it leaves after the first count of pairs.  Every run is
compared word by word at the end.

Null and empty texts and texts of fewer than ``LEAST`` words hold no run.
Repeated rows and doc_ids are documents of their own; extra columns are not
read.  Long texts are held whole, one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.anchors import ranges
from barsmith.llm.runtime import mix64, release, ship, slices, utf8
from barsmith.llm.wordhash import Words, under_spans, window_hashes, words

LEAST = 12
GRAM = LEAST // 4  # 3: equal words on one side of a boundary that a run's period shows
SLICE = 1 << 20
_CANDIDATES = 1 << 20  # handled at a time
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PRIMES = (2147483647, 2147483629)
_BASES = (1103515245, 1566083941)


# ------------------------------------------------------------------ the grammar


class Grammar:
    """Nonterminals at their places: ``rule`` (number of the nonterminal), ``start``, and for
    each nonterminal the place ``at`` of one occurrence, its boundary ``cut`` and ``size``."""

    def __init__(self, rule, start, at, cut, size) -> None:
        self.rule, self.start = rule, start
        self.at, self.cut, self.size = at, cut, size


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * _A + mix64(b) * _B)


def _counted(keys: np.ndarray) -> np.ndarray:
    """How often each key occurs."""
    order = np.argsort(keys)
    s = keys[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    n = np.diff(np.append(np.flatnonzero(new), len(s)))
    out = np.empty(len(s), np.int64)
    out[order] = np.repeat(n, n)
    return out


def live_pairs(symbols: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Counts of the pairs (i, i + 1); 0 where i ends a document or the pair occurs once."""
    n = np.zeros(len(symbols), np.int64)
    at = np.flatnonzero(~last)
    if len(at):
        n[at] = _counted(_pair(symbols[at], symbols[at + 1]))
    n[n < 2] = 0
    return n


def repair(symbols: np.ndarray, docs: np.ndarray) -> Grammar:
    """The grammar of the documents symbols[docs[d]:docs[d + 1]]; symbols differ between documents."""
    total = len(symbols)
    last = np.zeros(total, bool)
    last[docs[1:][docs[1:] > docs[:-1]] - 1] = True
    sym, start, end = symbols, np.arange(total), np.arange(1, total + 1)
    done, found = [], []  # symbols no live pair holds; replaced places
    while len(sym):
        n = live_pairs(sym, last)
        alive = n > 0
        held = alive.copy()
        held[1:] |= alive[:-1]
        done.append(start[~held])
        if not held.any():
            break
        # live stretches only, apart from each other
        keep = np.flatnonzero(held)
        sym, start, end, n = sym[keep], start[keep], end[keep], n[keep]
        last = n == 0
        key = np.zeros(len(sym), np.uint64)
        at = np.flatnonzero(n)
        key[at] = _pair(sym[at], sym[at + 1])
        same = np.zeros(len(sym), bool)
        same[1:] = (key[1:] == key[:-1]) & (n[1:] > 0)
        head = np.maximum.accumulate(np.where(~same, np.arange(len(sym)), 0))
        even = (np.arange(len(sym)) - head) % 2 == 0
        higher = np.zeros(len(sym), bool)  # than the next pair
        higher[:-1] = (n[:-1] > n[1:]) | ((n[:-1] == n[1:]) & (key[:-1] > key[1:]))
        higher[-1:] = True
        over_next = higher.copy()
        over_next[:-1] |= same[1:]
        over_before = np.ones(len(sym), bool)
        over_before[1:] = same[1:] | (n[:-1] == 0) | ~(higher[:-1] | (key[:-1] == key[1:]))
        take = np.flatnonzero((n > 0) & even & over_next & over_before)
        found.append((key[take], start[take], end[take], end[take + 1]))
        sym, end = sym.copy(), end.copy()
        sym[take], end[take] = key[take], end[take + 1]
        last[take] = last[take + 1]
        gone = np.ones(len(sym), bool)
        gone[take + 1] = False
        sym, start, end, last = sym[gone], start[gone], end[gone], last[gone]
    if found:
        key, place, middle, stop = (np.concatenate(c) for c in zip(*found))
        _, one, rule = np.unique(key, return_index=True, return_inverse=True)
    else:
        place = middle = stop = one = rule = np.zeros(0, np.int64)
    # the start rule of every document as a balanced tree: each node a nonterminal of its own
    left = np.sort(np.concatenate(done)) if done else np.zeros(0, np.int64)
    doc = np.searchsorted(docs, left, "right") - 1
    right = np.append(left, total)[1:]
    ends = np.flatnonzero(np.append(doc, -1)[1:] != doc)
    right[ends] = docs[doc[ends] + 1]
    tops = []
    while len(left):
        first = np.ones(len(left), bool)
        first[1:] = doc[1:] != doc[:-1]
        head = np.maximum.accumulate(np.where(first, np.arange(len(left)), 0))
        even = (np.arange(len(left)) - head) % 2 == 0
        joined = np.flatnonzero(even[:-1] & ~first[1:])
        if not len(joined):
            break
        tops.append((left[joined], right[joined], right[joined + 1]))
        right[joined] = right[joined + 1]
        stay = np.ones(len(left), bool)
        stay[joined + 1] = False
        left, right, doc = left[stay], right[stay], doc[stay]
    at, cut, size = place[one], middle[one] - place[one], stop[one] - place[one]
    if tops:
        a, m, b = (np.concatenate(c) for c in zip(*tops))
        rule = np.concatenate([rule, len(at) + np.arange(len(a))])
        place = np.concatenate([place, a])
        at, cut, size = np.concatenate([at, a]), np.concatenate([cut, m - a]), np.concatenate([size, b - a])
    return Grammar(rule, place, at, cut, size)


# ------------------------------------------------------------------ extensions


class Prefixes:
    """Prefix hashes of a word array modulo two primes: equality of stretches."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.n = len(hashes)
        self.sums, self.powers = [], []
        for p, base in zip(_PRIMES, _BASES):
            power = _modular_powers(self.n + 1, base, p)
            sums = np.zeros(self.n + 1, np.int64)
            np.cumsum((hashes % np.uint64(p)).astype(np.int64) * power[:self.n] % p, out=sums[1:])
            self.sums.append(sums)
            self.powers.append(power)

    def equal(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Are the stretches at i and j (i < j) of that size equal?"""
        ok = np.ones(len(i), bool)
        for p, sums, power in zip(_PRIMES, self.sums, self.powers):
            a = (sums[i + size] - sums[i]) % p * power[j - i] % p
            ok &= a == (sums[j + size] - sums[j]) % p
        return ok

    def forward(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the longest common extension to the right of i < j, up to ``most``."""
        return self._extend(i, j, most, 0)

    def backward(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The same to the left: of the words before i and before j."""
        return self._extend(i, j, most, 1)

    def _extend(self, i, j, most, back) -> np.ndarray:
        low, high = np.zeros(len(i), np.int64), most.copy()
        while (open_ := low < high).any():
            at = np.flatnonzero(open_)
            mid = (low[at] + high[at] + 1) // 2
            ok = self.equal(i[at] - back * mid, j[at] - back * mid, mid)
            low[at[ok]] = mid[ok]
            high[at[~ok]] = mid[~ok] - 1
        return low


_kept_powers: dict[int, np.ndarray] = {}


def _modular_powers(n: int, base: int, p: int) -> np.ndarray:
    have = _kept_powers.get(p)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.ones(size, np.int64)
        done = 1
        while done < size:
            more = min(done, size - done)
            have[done:done + more] = have[:more] * pow(base, done, p) % p
            done += more
        _kept_powers[p] = have
    return have[:n]


# ------------------------------------------------------------------ runs


def _suspects(n: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words that begin 2 * GRAM words of live pairs only, documents that have some)."""
    live = (n > 0).astype(np.int8)
    row = np.zeros(len(n), bool)
    k = 2 * GRAM - 1
    if len(n) >= k:
        all_ = live[:len(n) - k + 1].copy()
        for s in range(1, k):
            all_ &= live[s:len(n) - k + 1 + s]
        row[:len(all_)] = all_ > 0
    upto = np.concatenate([[0], np.cumsum(row)])
    return row, upto[docs[1:]] > upto[docs[:-1]]


def boundary_runs(g: Grammar, hashes: np.ndarray, row: np.ndarray):
    """(rule, offset, size, period) of the runs that cross each nonterminal's boundary, inside it."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    near = np.concatenate([[0], np.cumsum(row)])
    b = g.at + g.cut
    lo = np.maximum(b - 2 * GRAM, g.at)
    rules = np.flatnonzero((g.size >= LEAST) & (near[np.minimum(b + 1, len(row))] > near[lo]))
    if not len(rules):
        return none
    prefixes = Prefixes(hashes)
    grams = window_hashes(hashes, GRAM)
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    kind = np.empty(len(grams), np.int64)
    kind[order] = np.cumsum(new) - 1
    spots = kind[order] * np.int64(len(hashes) + 1) + order  # sorted by (kind, place)
    asked = []
    for side in (0, GRAM):  # the words after the boundary, the words before it
        r = rules[(g.cut[rules] >= side) & (g.size[rules] - g.cut[rules] >= GRAM - side)]
        at = g.at[r] + g.cut[r] - side
        base = kind[at] * np.int64(len(hashes) + 1)
        first = np.searchsorted(spots, base + g.at[r])
        stop = np.searchsorted(spots, base + g.at[r] + g.size[r] - GRAM, "right")
        asked.append((r, at, first, stop - first))
    r, at, first, n = (np.concatenate(c) for c in zip(*asked))
    out = [none]
    for i, j in slices(np.concatenate([[0], np.cumsum(n)]), _CANDIDATES):
        place = order[ranges(first[i:j], n[i:j])]
        who, here = np.repeat(r[i:j], n[i:j]), np.repeat(at[i:j], n[i:j])
        q = np.abs(place - here)
        ok = (q > 0) & (2 * q <= g.size[who])
        who, q = _distinct(who[ok], q[ok])
        out.append(_crossing(g, prefixes, who, q))
    who, a, size, q = (np.concatenate(c) for c in zip(*out))
    order = np.lexsort((q, size, a, who))  # the smallest period of a stretch
    who, a, size, q = who[order], a[order], size[order], q[order]
    new = np.ones(len(who), bool)
    new[1:] = (who[1:] != who[:-1]) | (a[1:] != a[:-1]) | (size[1:] != size[:-1])
    return who[new], a[new], size[new], q[new]


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _crossing(g: Grammar, prefixes: Prefixes, who: np.ndarray, q: np.ndarray):
    """Runs of period q at the boundary of each nonterminal: words after it repeat, or words before it."""
    out = []
    low, b = g.at[who], g.at[who] + g.cut[who]
    high = low + g.size[who]
    for i, j in ((b, b + q), (b - q, b)):
        ok = np.flatnonzero((j <= high) & (i >= low))
        x, y = i[ok], j[ok]
        after = prefixes.forward(x, y, high[ok] - y)
        before = prefixes.backward(x, y, x - low[ok])
        size = before + after + q[ok]
        some = size >= np.maximum(LEAST, 2 * q[ok])
        out.append((who[ok][some], (x - before - low[ok])[some], size[some], q[ok][some]))
    return tuple(np.concatenate(c) for c in zip(*out))


def translate(g: Grammar, runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of nonterminals at all their places -> (start, size, period), maximal ones only."""
    who, a, size, q = runs
    keep = np.isin(g.rule, who)
    rule, place = g.rule[keep], g.start[keep]
    first, stop = np.searchsorted(who, rule), np.searchsorted(who, rule, "right")
    each = stop - first
    pick = ranges(first, each)
    start = np.repeat(place, each) + a[pick]
    size, q = size[pick], q[pick]
    order = np.lexsort((-size, start, q))
    start, size, q = start[order], size[order], q[order]
    # inside a period, a stretch that ends no later than an earlier one lies in it
    big = np.int64(1) << 40
    ends = start + size + q * big
    reach = np.maximum.accumulate(ends) if len(ends) else ends
    new = np.ones(len(start), bool)
    new[1:] = ends[1:] > reach[:-1]
    start, size, q = start[new], size[new], q[new]
    order = np.lexsort((q, start))
    return start[order], size[order], q[order]


def find_runs(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, period) of all runs, by start and period; starts are word indexes of the slice."""
    none = np.zeros(0, np.int64)
    if not len(w.hashes):
        return none, none, none
    doc = w.doc_of()
    symbols = mix64(w.hashes ^ mix64(doc.astype(np.uint64) * _A + _B))
    last = np.zeros(len(symbols), bool)
    last[w.docs[1:][w.docs[1:] > w.docs[:-1]] - 1] = True
    row, some = _suspects(live_pairs(symbols, last), w.docs)
    some &= np.diff(w.docs) >= LEAST
    if not some.any():
        return none, none, none
    size = np.diff(w.docs)
    at = ranges(w.docs[:-1][some], size[some])  # the documents that go on
    docs = np.concatenate([[0], np.cumsum(size[some])])
    g = repair(symbols[at], docs)
    start, length, period = translate(g, boundary_runs(g, symbols[at], row[at]))
    for s, n, q in zip(start.tolist(), length.tolist(), period.tolist()):
        run = symbols[at[s:s + n]]
        if (run[q:] != run[:-q]).any():
            raise ValueError("a prefix hash failed: words at a run's distance differ")
    return at[start] if len(start) else start, length, period


def repeats(w: Words, runs) -> np.ndarray:
    """Which words a run contains after its first period."""
    start, size, period = runs
    return under_spans(len(w.hashes), start + period, start + size)


def planted(w: Words, key: np.ndarray, has_key: np.ndarray) -> np.ndarray:
    """For every word the one that stands there: a document whose key ends in 0 repeats
    a stretch of it from some word to its end."""
    out = np.arange(len(w.hashes))
    size = np.diff(w.docs)
    for d in np.flatnonzero(has_key & (key % 10 == 0) & (size > 0)):
        n, k = int(size[d]), int(key[d]) // 10
        a = k % n
        p = 1 + (n - a) // (3 + k % 8)
        out[w.docs[d] + a:w.docs[d] + n] = w.docs[d] + a + np.arange(n - a) % p
    return out


# ------------------------------------------------------------------ DataFrames

_RUNS = "runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _collapse(keyed: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8(batch.column("text"))
            for i, j in slices(offs, SLICE):
                part = batch.slice(i, j - i)
                yield _slice(part, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], keyed)
                release()

    return work


def _slice(part: pa.RecordBatch, data: np.ndarray, offs: np.ndarray, keyed: bool) -> pa.RecordBatch:
    w = words(data, offs)
    place = np.arange(len(w.hashes))
    if keyed:
        key = part.column("key")
        place = planted(w, np.array(key.fill_null(0)), np.array(key.is_valid()))
        w = Words(w.hashes[place], w.starts[place], w.ends[place], w.docs)
    start, size, period = runs = find_runs(w)
    kept = np.flatnonzero(~repeats(w, runs))
    doc = np.searchsorted(w.docs, start, "right") - 1
    first = np.searchsorted(doc, np.arange(len(offs)))
    entries = pa.StructArray.from_arrays(
        [pa.array(start - w.docs[doc]), pa.array(size), pa.array(period)], names=["start", "length", "period"])
    listed = pa.ListArray.from_arrays(pa.array(first, pa.int32()), entries)
    text = _joined(data, w.starts[kept], w.ends[kept], np.searchsorted(kept, w.docs))
    return pa.RecordBatch.from_arrays([part.column("doc_id"), listed, text], names=["doc_id", "runs", "collapsed"])


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, docs: np.ndarray) -> pa.Array:
    """Each document's words, joined by one space, as texts."""
    size = ends - starts + 1  # a space after every word
    spot = np.concatenate([[0], np.cumsum(size)])
    out = np.full(int(spot[-1]), 32, np.uint8)
    body = np.ones(len(out), bool)
    body[spot[1:] - 1] = False
    out[body] = data[ranges(starts, ends - starts)]
    last = spot[docs]
    # the space after a document's last word is no part of its text
    has = docs[1:] > docs[:-1]
    drop = np.zeros(len(out), bool)
    drop[last[1:][has] - 1] = True
    lengths = np.diff(last) - has
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.utf8(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(out[~drop]))])


def runs(docs: DataFrame, key=None) -> DataFrame:
    """Per row: doc_id, runs (start, length, period, by start and period) and collapsed, the text
    without the words that a run repeats.  ``key`` (a long column, may be null) plants runs first."""
    ship(docs.sparkSession)
    taken = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *([] if key is None else [key.alias("key")]))
    return taken.mapInArrow(_collapse(key is not None), f"doc_id long, {_RUNS}")


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_runs, the greatest run, and digests of all runs and of the collapsed text."""
    found = runs(docs, F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")))
    best = F.reduce("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"),
                    lambda a, b: F.when(a.isNull() | (b["length"] > a["length"]), b).otherwise(a))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
