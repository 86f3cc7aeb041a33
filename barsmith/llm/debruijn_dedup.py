"""Substring dedup over words by De Bruijn compaction (operator 6).

Every word covered by a window of ``SPAN`` words whose sequence also starts
anywhere else, in the same document or another, is removed; windows are judged
on the input.

The windows are the edges of a De Bruijn graph, their first and last
``SPAN - 1`` words its nodes.

1. Blocks of documents find the windows' anchors (see ``anchors``) and learn
   which anchors occur again; only these windows can be repeated edges.
2. Their contexts -- runs of windows with one anchor -- travel to the anchor's
   bucket, once per block for equal contexts, with the edges next to them.
3. A bucket counts its edges, keeps the repeated ones and joins neighbours into
   fragments wherever neither edge branches.  Every occurrence of a fragment
   carries its source coordinate (block, context, window), and its words are
   compared in full with the fragment's first source.
4. Spark joins glue fragments across buckets into nonbranching paths: a node
   with one fragment ending and one starting links them, and pointer doubling
   gives each fragment its path and offset.
5. Blocks read back the path occurrences, merge fragments that follow each
   other into spans, and remove the words of the spans.

Fragments that only form a cycle stay paths of their own.  Null text has no
words.  A window that very many documents share arrives once per block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.anchors import ASK, REPEATED, Anchors, ask_repeated, find_anchors, find_repeated, part_windows, ranges, repeated_of
from barsmith.llm.blocks import blocked, bucket_rows, tidy
from barsmith.llm.runtime import mix64, pack, slices, unpack, utf8
from barsmith.llm.wordhash import SLICE_BYTES, per_doc, under_spans, window_hashes, words_of_all
from barsmith.session import drop_path, scratch_path, shared_dir

SPAN = 35
GRAM = 12
_CONTEXTS = "bucket int, g int, windows binary, times binary, before binary, after binary, sizes binary, text binary"
_RUNS = ("g int, bucket int, context int, first int, edges int, fragment long, start_node long, end_node long")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BRANCH = np.uint64(0xB5297A4D3F84C2E1)  # several different edges


class _Block:
    """Words and anchors of a block; positions are word numbers of the block."""

    def __init__(self, docs: pa.Table) -> None:
        self.data, offs = utf8(docs.column("text"))
        w = words_of_all(self.data, offs)
        self.hashes, self.starts, self.ends, self.docs = w.hashes, w.starts, w.ends, w.docs
        parts = []
        for i, j in slices(w.docs, SLICE_BYTES >> 2):
            a = find_anchors(w.hashes[w.docs[i]:w.docs[j]], w.docs[i:j + 1] - w.docs[i], SPAN, GRAM)
            parts.append(a.moved(w.docs[i], i))
        self.anchors = Anchors.join(parts)

    def contexts(self, told: pa.Table, n_buckets: int) -> "_Contexts":
        again, hot = repeated_of(self.anchors.key, told, n_buckets)
        a, hot = self.anchors.take(again), hot[again]
        whole = len(a.key) - int(hot.sum())
        if hot.any():
            edges = window_hashes(self.hashes, SPAN)
            a = part_windows(a, hot, lambda s: edges[s])
        return _Contexts(a, *self.neighbours(a, whole))

    def neighbours(self, a: Anchors, whole: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(kind, edge before, edge after) of each anchor's context; equal contexts have equal kinds.

        The edge before the first and after the last window is 0 at a document's ends.  Anchors from
        number ``whole`` on are single windows of hot anchors: where their neighbours differ inside
        the block, ``_BRANCH`` stands for all, so that such a window leaves the block once."""
        if not len(a.key):
            return a.key, a.key, a.key
        edges = window_hashes(self.hashes, SPAN)
        begin, end = self.docs[a.doc], self.docs[a.doc + 1]
        before = np.where(a.first > begin, edges[np.maximum(a.first - 1, 0)], np.uint64(0))
        after = np.where(a.last + SPAN < end, edges[np.minimum(a.last + 1, len(edges) - 1)], np.uint64(0))
        if whole < len(a.key):
            _, of = np.unique(a.key[whole:], return_inverse=True)
            for side in (before, after):
                side[whole:][_branches(of, int(of.max()) + 1, side[whole:])[of]] = _BRANCH
        # every window of a context lies in its first and last, as these overlap
        kind = mix64(edges[a.first] * _ODD + edges[a.last]) ^ mix64(
            before * _ODD + after + (a.last - a.first).astype(np.uint64)) ^ (a.at - a.first).astype(np.uint64)
        return kind, before, after


class _Contexts:
    """Distinct contexts of repeated anchors, in key order, and which one each anchor has."""

    def __init__(self, a: Anchors, kind: np.ndarray, before: np.ndarray, after: np.ndarray) -> None:
        order = np.lexsort((kind, a.key))
        new = np.ones(len(order), bool)
        new[1:] = (a.key[order[1:]] != a.key[order[:-1]]) | (kind[order[1:]] != kind[order[:-1]])
        at = np.flatnonzero(new)
        self.a, self.head = a, order[new]
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.times = np.diff(np.append(at, len(order)))
        self.before, self.after = before[self.head], after[self.head]


def _branches(edge: np.ndarray, n: int, other: np.ndarray) -> np.ndarray:
    """Which of ``n`` distinct edges meet more than one neighbour on this side."""
    order = np.argsort(edge, kind="stable")
    head = np.flatnonzero(np.append(True, edge[order[1:]] != edge[order[:-1]]))
    mine = other[order]
    return (np.minimum.reduceat(mine, head) != np.maximum.reduceat(mine, head)) | (
        np.add.reduceat(mine == _BRANCH, head) > 0)


def _ask(n_buckets: int):
    def ask(docs: pa.Table) -> pa.Table:
        block = _Block(docs)
        kind, _, _ = block.neighbours(block.anchors, len(block.anchors.key))
        return ask_repeated(block.anchors.key, None, kind, docs.column("g")[0].as_py(), n_buckets)

    return ask


def _send(n_buckets: int):
    def send(docs: pa.Table, told: pa.Table) -> pa.Table:
        import zstandard

        rows = []
        if docs.num_rows and told.num_rows:
            block = _Block(docs)
            c = block.contexts(told, n_buckets)
            a, g = c.a.take(c.head), docs.column("g")[0].as_py()
            for b, s in bucket_rows(a.key, n_buckets):
                # a context's text: its first word to its last, words as they are
                x, y = block.starts[a.first[s]], block.ends[a.last[s] + SPAN - 1]
                text = block.data[ranges(x, y - x)]
                rows.append((b, g, pack((a.last - a.first + 1)[s].astype(np.uint8)), pack(c.times[s].astype(np.uint32)),
                             pack(c.before[s]), pack(c.after[s]), pack((y - x).astype(np.uint32)),
                             zstandard.ZstdCompressor(level=1).compress(text.tobytes())))
        names = [x.split()[0] for x in _CONTEXTS.split(", ")]
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
        return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, types))})

    return send


def _fragments(table: pa.Table) -> pa.Table:
    """A bucket's repeated edges as fragments: one row per occurrence in a context."""
    import zstandard

    rows = table.to_pylist()
    per_row = [unpack(r["windows"], np.uint8).astype(np.int64) for r in rows]
    size = np.concatenate(per_row)
    times = np.concatenate([unpack(r["times"], np.uint32) for r in rows]).astype(np.int64)
    before, after = (np.concatenate([unpack(r[c], np.uint64) for r in rows]) for c in ("before", "after"))
    text = np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(r["text"]), np.uint8) for r in rows])
    offs = np.concatenate([[0], np.cumsum(np.concatenate([unpack(r["sizes"], np.uint32) for r in rows]).astype(np.int64))])
    w = words_of_all(text, offs)
    ctx = np.repeat(np.arange(len(size)), size)
    spot = ranges(w.docs[:-1], size)  # the first word of every window
    edge = window_hashes(w.hashes, SPAN)[spot]
    distinct, of = np.unique(edge, return_inverse=True)
    repeated = (np.bincount(of, weights=times[ctx], minlength=len(distinct)) > 1)[of]
    follows = np.append(ctx[1:] == ctx[:-1], False)  # the next window is of the same context
    nxt = np.where(follows, np.append(edge[1:], np.uint64(0)), after[ctx])
    prv = np.where(np.append(False, follows[:-1]), np.append(np.uint64(0), edge[:-1]), before[ctx])
    split_after = _branches(of, len(distinct), nxt)[of]
    split_before = _branches(of, len(distinct), prv)[of]
    on = follows.copy()  # window i and i + 1 belong to one fragment
    on[:-1] &= repeated[:-1] & repeated[1:] & ~split_after[:-1] & ~split_before[1:]
    first = np.flatnonzero(repeated & ~np.append(False, on[:-1]))
    last = np.flatnonzero(repeated & ~on)
    # the words of every occurrence against the fragment's first source
    raw = text.tobytes()
    begin, end = w.starts[spot[first]], w.ends[spot[last] + SPAN - 1]
    seen: dict[tuple[int, bytes], list] = {}
    for i, (f, x, y) in enumerate(zip(edge[first].tolist(), begin.tolist(), end.tolist())):
        seen.setdefault((f, b" ".join(raw[x:y].split())), []).append(i)
    good = np.zeros(len(first), bool)
    for found in seen.values():
        good[found] = times[ctx[first[found]]].sum() > 1
    first, last = first[good], last[good]
    nodes = window_hashes(w.hashes, SPAN - 1)
    row_of = np.repeat(np.arange(len(rows)), [len(p) for p in per_row])
    row_start = np.cumsum([0] + [len(p) for p in per_row])
    c = ctx[first]
    window = first - (np.cumsum(size) - size)[c]
    signed = lambda x: pa.array(x.view(np.int64))
    return pa.table({
        "g": pa.array(np.array([r["g"] for r in rows], np.int32)[row_of[c]]),
        "bucket": pa.array(np.full(len(c), rows[0]["bucket"], np.int32)),
        "context": pa.array((c - row_start[row_of[c]]).astype(np.int32)),
        "first": pa.array(window.astype(np.int32)), "edges": pa.array((last - first + 1).astype(np.int32)),
        "fragment": signed(edge[first]), "start_node": signed(nodes[spot[first]]),
        "end_node": signed(nodes[spot[last] + 1])})


def compact(fragments: DataFrame) -> DataFrame:
    """``fragment, path, place``: the path each fragment lies on and its offset in edges.

    ``fragments`` holds distinct ``fragment, edges, start_node, end_node``.  A
    node where one fragment ends and one starts links the two; pointers to the
    fragment before double every round until all reach their path's head, so
    rounds grow with the logarithm of the longest path.  Each round is written
    to the shared folder and read again: a checkpoint would carry the joins'
    constraints on, and they double every round.
    """
    spark = fragments.sparkSession

    def stored(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "paths")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    ends = fragments.select(F.col("end_node").alias("node"), F.struct("fragment", "edges").alias("ending"),
                            F.lit(None).cast("long").alias("starting"))
    starts = fragments.select(F.col("start_node").alias("node"), F.lit(None).cast("struct<fragment:long,edges:int>"),
                              F.col("fragment"))
    links = (ends.union(starts).groupBy("node")
             .agg(F.count("ending").alias("n_in"), F.count("starting").alias("n_out"),
                  F.max("ending").alias("ending"), F.max("starting").alias("starting"))
             .where("n_in = 1 AND n_out = 1 AND ending.fragment <> starting")
             .select(F.col("starting").alias("fragment"), F.col("ending.fragment").alias("head"),
                     F.col("ending.edges").cast("long").alias("place")))
    state, last = stored(fragments.select("fragment").join(links, "fragment", "left").select(
        "fragment", F.coalesce("head", "fragment").alias("head"), F.coalesce("place", F.lit(0)).alias("place")))
    rounds = max(state.count(), 2).bit_length() + 1
    for _ in range(rounds):
        ahead = state.select(F.col("fragment").alias("head"), F.col("head").alias("next"), F.col("place").alias("more"))
        before = last
        moved, last = stored(state.join(ahead, "head").select(
            "fragment", F.col("next").alias("head"), (F.col("place") + F.col("more")).alias("place"),
            (F.col("next") != F.col("head")).alias("moved")))
        drop_path(spark, before)
        state = moved.select("fragment", "head", "place")
        if not moved.where("moved").take(1):
            break
    # what still moves, or came back to itself, lies on a cycle
    path = F.when(F.col("moved"), F.col("fragment")).otherwise(F.col("head"))
    return moved.select("fragment", path.alias("path"),
                        F.when(path == F.col("fragment"), 0).otherwise(F.col("place")).alias("place"))


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                  ("kept_sha256", pa.string()), ("kept_text", pa.string()),
                  ("spans", pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("path", pa.int64())])))])
_OUT_DDL = ("doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, "
            "spans array<struct<first_word:long,n_words:long,path:long>>")


def _remove(n_buckets: int):
    def remove(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _OUT.empty_table()
        block = _Block(docs)
        kinds = told.column("bits").is_valid().to_numpy()
        c = block.contexts(told.filter(pa.array(kinds)), n_buckets)
        runs = told.filter(pa.array(~kinds))
        base = {b: s.start for b, s in bucket_rows(c.a.key[c.head], n_buckets)}
        got = {n: runs.column(n).to_numpy() for n in ("bucket", "context", "first", "edges", "path", "place")}
        which = np.array([base[b] for b in got["bucket"].tolist()], np.int64) + got["context"]
        # every anchor has the runs of its context
        order = np.argsort(which, kind="stable")
        lo, hi = (np.searchsorted(which[order], c.of, side) for side in ("left", "right"))
        run = order[ranges(lo, hi - lo)]
        start = np.repeat(c.a.first, hi - lo) + got["first"][run]
        edges, path, place = got["edges"][run].astype(np.int64), got["path"][run], got["place"][run]
        # fragments that follow each other on a path and in the text are one span
        by = np.argsort(start, kind="stable")
        start, edges, path, place = start[by], edges[by], path[by], place[by]
        new = np.ones(len(start), bool)
        new[1:] = (path[1:] != path[:-1]) | (start[1:] != start[:-1] + edges[:-1]) | (place[1:] != place[:-1] + edges[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(start)) - 1 if len(head) else head
        first, length = start[head], start[tail] + edges[tail] - start[head] + SPAN - 1
        gone = under_spans(len(block.hashes), first, first + length)
        raw = block.data.tobytes()
        removed = per_doc(gone, block.docs)
        spans = np.searchsorted(first, block.docs)
        rows = []
        for d, doc in enumerate(docs.column("doc_id").to_pylist()):
            x, y = block.docs[d], block.docs[d + 1]
            kept = np.flatnonzero(~gone[x:y]) + x
            text = b" ".join([raw[p:q] for p, q in zip(block.starts[kept].tolist(), block.ends[kept].tolist())])
            found = [{"first_word": int(first[s] - x), "n_words": int(length[s]), "path": int(path[head[s]])}
                     for s in range(spans[d], spans[d + 1])]
            rows.append((doc, int(y - x), int(removed[d]), hashlib.sha256(text).hexdigest(),
                         text.decode(), found))
        return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_OUT)], names=_OUT.names)

    return remove


def dedup(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, the kept words, and the repeated spans with their path."""
    shared_dir(docs.sparkSession)
    blocks, n, _ = blocked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    asked = blocks.groupBy("g").applyInArrow(tidy(_ask(n)), ASK)
    again = asked.groupBy("bucket").applyInArrow(tidy(find_repeated), REPEATED)
    contexts = blocks.groupBy("g").cogroup(again.groupBy("g")).applyInArrow(tidy(_send(n)), _CONTEXTS)
    runs = contexts.groupBy("bucket").applyInArrow(tidy(_fragments), _RUNS).checkpoint()
    paths = compact(runs.select("fragment", "edges", "start_node", "end_node").distinct())
    told = again.select("g", "bucket", "bits").unionByName(
        runs.join(paths, "fragment").select("g", "bucket", "context", "first", "edges", "path", "place"),
        allowMissingColumns=True)
    return blocks.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(tidy(_remove(n)), _OUT_DDL)


def report(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
