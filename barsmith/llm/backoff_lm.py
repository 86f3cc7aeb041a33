"""Language-model scoring with a weighted backoff automaton (operator 2).

Tokens: words in lower case (A-Z), then one end per document.  The model is an
n-gram one of ``order`` (``ORDER`` by default) learnt from the training documents
(crc32 of the doc_id as text, mod 10, is not 0):

* root state: p(w) = (c(w) - D) / N for known words; what is discounted,
  D * V / N, is the probability of the one unknown word.  D = n1 / (n1 + 2 n2)
  from the counts of words seen once and twice.
* one state per context h of 1 to order - 1 tokens that training documents
  hold (a document's start is a token): an arc to w for each seen n-gram, weight
  log10 (c(hw) + MU p'(w)) / (c(h) + MU), p' being the next shorter context's
  probability, and a failure arc to that context's state, weight
  log10 MU / (c(h) + MU).  Each state's weights sum to one.

Scoring reads a document left to right.  The state carried is the longest
context just read that the model has; a token takes its arc, or failure arcs
down the chain of shorter states until one has the arc, the root at last, and
their weights are added up.  Which state a token leaves behind depends on the
tokens up to it alone, so all tokens of a block take the same link of their
chains together.  The automaton of the corpus does not fit a task, nor is it
broadcast: counts live in buckets of the keys' hashes, and every block of
documents asks for the states and arcs its texts touch (see ``blocks``); that
part of the automaton is built and traversed in the block.  All n-grams of all
training documents are counted; none is pruned.  Keys are hashes, cut to the
bits that the size of the corpus needs (``SPARE_BITS``).

Null text counts as empty (its only token is the end); a null doc_id counts as
the empty text in the crc32.  With no training tokens every probability is 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.blocks import blocked, bucket_rows, key_blob, tidy
from barsmith.llm.runtime import mix64, pack, slices, unpack, unpack_sorted, utf8
from barsmith.llm.wordhash import SLICE_BYTES, per_doc, words

ORDER = 3
MU = 20.0
BLOCK_BYTES = 4 << 20  # larger blocks hold fewer n-grams twice
SPARE_BITS = 22        # of a key, beyond those that number the n-grams: one in 4 million may meet another
END, START = np.uint64(0x8A5CD789635D2DFF), np.uint64(0x121FD2155C472F96)
_GRAM = np.uint64(0x9FB21C651E98DF25)


def _ask_ddl(order: int) -> str:
    return "bucket int, g int, " + ", ".join(f"keys{k} binary, counts{k} binary" for k in range(order))


def _answer_ddl(order: int) -> str:
    return "g int, bucket int, " + ", ".join(f"counts{k} binary" for k in range(order)) + ", n long, v long, n1 long, n2 long"


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 10 == 0


@dataclass
class Tokens:
    """Tokens of a block's documents, each document followed by its end, and the n-grams that end at them."""

    grams: list[np.ndarray]  # grams[k]: key of the k + 1 tokens up to each; grams[0]: of the token
    docs: np.ndarray         # token range of each document
    drop: int = 0            # low bits that keys lack

    def end(self) -> np.uint64:
        return END >> np.uint64(self.drop) << np.uint64(self.drop)

    def place(self) -> np.ndarray:
        """Each token's place in its document."""
        return np.arange(len(self.grams[0])) - np.repeat(self.docs[:-1], np.diff(self.docs))

    def whole(self, k: int) -> np.ndarray:
        """Which tokens end an n-gram of k + 1 tokens; the start of a document counts as one."""
        return self.place() >= k - 1 if k > 1 else np.ones(len(self.grams[0]), bool)


def gram_keys(word: np.ndarray, docs: np.ndarray, order: int) -> list[np.ndarray]:
    """Keys of the n-grams of 1 to ``order`` tokens: an n-gram extends the one that ends before its last token."""
    grams = [word]
    for _ in range(order - 1):
        before = np.empty_like(word)
        before[1:] = grams[-1][:-1]
        if len(grams) == 1:
            before[docs[:-1]] = START
        else:  # no n-gram so long ends at a document's first token
            before[docs[:-1]] = 0
        grams.append(mix64(before * _GRAM + word))
    return grams


def dropped_bits(size: int) -> int:
    """Low bits of keys that a corpus of ``size`` bytes of text, so at most half as many tokens, can do without."""
    return max(64 - SPARE_BITS - max(size // 2, 1).bit_length(), 0)


def tokens_of(text, order: int, drop: int = 0) -> Tokens:
    data, offs = utf8(text)
    parts, sizes = [], []
    for i, j in slices(offs, SLICE_BYTES):
        w = words(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], lower=True)
        parts.append(np.insert(w.hashes, w.docs[1:], END))
        sizes.append(np.diff(w.docs) + 1)
    word = np.concatenate(parts)
    docs = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    low = np.uint64(drop)
    return Tokens([g >> low << low for g in gram_keys(word, docs, order)], docs, drop)


def _ask(n_buckets: int, order: int, drop: int):
    def ask(table: pa.Table) -> pa.Table:
        t = tokens_of(table.column("text"), order, drop)
        learn = np.repeat(~table.column("held_out").to_numpy(), np.diff(t.docs))
        rows: dict[int, dict] = {}
        for k in range(order):
            at = np.flatnonzero(t.whole(k))
            distinct, place = np.unique(t.grams[k][at], return_inverse=True)
            counts = np.bincount(place, weights=learn[at], minlength=len(distinct)).astype(np.uint32)
            for b, s in bucket_rows(distinct, n_buckets):
                rows.setdefault(b, {})[k] = (key_blob(distinct[s]), pack(counts[s]))
        g = table.column("g")[0].as_py()
        cols = {"bucket": pa.array(list(rows), pa.int32()), "g": pa.array([g] * len(rows), pa.int32())}
        for k in range(order):
            for i, name in enumerate(("keys", "counts")):
                cols[f"{name}{k}"] = pa.array([r.get(k, (None, None))[i] for r in rows.values()], pa.binary())
        return pa.table(cols)

    return ask


def _count(order: int):
    """Totals of a bucket's keys, aligned to each block's; one row (g = -1) of unigram statistics."""
    def count(table: pa.Table) -> pa.Table:
        n = table.num_rows
        totals, stats = {}, (0, 0, 0, 0)
        for k in range(order):
            asked = [unpack_sorted(b) if b else np.zeros(0, np.uint64) for b in table.column(f"keys{k}").to_pylist()]
            counts = [unpack(b, np.uint32) if b else np.zeros(0, np.uint32) for b in table.column(f"counts{k}").to_pylist()]
            distinct, place = np.unique(np.concatenate(asked), return_inverse=True)
            total = np.bincount(place, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.uint64)
            ends = np.cumsum([len(a) for a in asked])
            totals[k] = [pack(total[place[e - len(a):e]]) if len(a) else None for a, e in zip(asked, ends)]
            if k == 0:
                stats = tuple(int(x) for x in (total.sum(), (total > 0).sum(), (total == 1).sum(), (total == 2).sum()))
        cols = {"g": pa.array([*table.column("g").to_pylist(), -1], pa.int32()),
                "bucket": pa.array([table.column("bucket")[0].as_py()] * (n + 1), pa.int32())}
        cols |= {f"counts{k}": pa.array([*totals[k], None], pa.binary()) for k in range(order)}
        cols |= {name: pa.array([0] * n + [x], pa.int64()) for name, x in zip(("n", "v", "n1", "n2"), stats)}
        return pa.table(cols)

    return count


@dataclass
class Automaton:
    """The states and arcs that a block touches: per length, n-gram keys, sorted, and training counts."""

    keys: list[np.ndarray]
    counts: list[np.ndarray]
    n: int
    v: int
    discount: float

    def count(self, k: int, t: Tokens) -> np.ndarray:
        """Training count of the n-gram of k + 1 tokens that ends at each token; 0 where there is none so long."""
        out = np.zeros(len(t.grams[0]))
        at = np.flatnonzero(t.whole(k))
        out[at] = self.counts[k][np.searchsorted(self.keys[k], t.grams[k][at])]
        return out

    def traverse(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(training count, log10 weight) of every token, all documents left to right."""
        known = self.count(0, t)
        if not self.n:
            return known, np.zeros(len(known))
        root = np.where(known > 0, (known - self.discount) / self.n, self.discount * self.v / self.n)
        weight, arcs = np.log10(root), known
        place = t.place()
        for k in range(1, len(self.keys)):  # the chain of the state before each token, shortest first
            state = np.zeros(len(known))  # count of the context of k tokens: that of the n-gram ending before
            state[1:] = arcs[:-1]
            # as many starts as ends; no longer context ends where a document begins
            state[place == 0] = self.counts[0][np.searchsorted(self.keys[0], t.end())] if k == 1 else 0
            arcs = self.count(k, t)
            seen = np.log10((arcs + MU * 10.0 ** weight) / (state + MU))
            fails = np.log10(MU / (state + MU)) + weight
            weight = np.where(arcs > 0, seen, np.where(state > 0, fails, weight))
        return known, weight


def _score(order: int, drop: int):
    def score_block(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _scores.empty_table()
        t = tokens_of(docs.column("text"), order, drop)
        kinds = [f"counts{k}" for k in range(order)]
        got = sorted(answers.select(["bucket", *kinds]).to_pylist(), key=lambda r: r["bucket"])
        counts = [np.concatenate([np.zeros(0, np.uint64), *[unpack(r[k], np.uint64) for r in got if r[k]]]) for k in kinds]
        n, v, n1, n2 = answers.column("all")[0].as_py().values()
        discount = min(max(n1 / (n1 + 2 * n2), 0.05), 0.95) if n1 else 0.05
        auto = Automaton([np.unique(t.grams[k][t.whole(k)]) for k in range(order)], counts, n, v, discount)
        known, weight = auto.traverse(t)
        base = np.log10((known + 0.1) / (n + 0.1 * (v + 1)))
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"),
            "n_tokens": pa.array(np.diff(t.docs), pa.int64()), "n_known": pa.array(per_doc(known > 0, t.docs), pa.int64()),
            "train_tokens": pa.array([n] * docs.num_rows, pa.int64()),
            "base_score": pa.array(_sums(base, t.docs)), "score": pa.array(_sums(weight, t.docs))}).cast(_scores)

    return score_block


_scores = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _sums(values: np.ndarray, docs: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, docs[:-1])  # no document is without a token


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out())
    blocks, n, size = blocked(slim, BLOCK_BYTES, store=False)
    drop = dropped_bits(size)
    asked = blocks.groupBy("g").applyInArrow(tidy(_ask(n, order, drop)), _ask_ddl(order))
    answers = asked.groupBy("bucket").applyInArrow(tidy(_count(order)), _answer_ddl(order))
    stats = answers.where("g = -1").agg(
        F.struct(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "n1", "n2")]).alias("stats"))
    told = answers.where("g >= 0").select("g", "bucket", *[f"counts{k}" for k in range(order)], stats.scalar().alias("all"))
    return blocks.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(tidy(_score(order, drop)), _SCORES)
