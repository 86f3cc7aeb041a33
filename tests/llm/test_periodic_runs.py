"""Operator 13 against a plain search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from barsmith.llm import periodic_runs as P
from barsmith.llm.wordhash import words
from tests.llm.conftest import AWKWARD, corpus


def brute(ws):
    """All runs (start, length, period) of a list of words."""
    n, found = len(ws), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and ws[i] == ws[i + q]:
                i += 1
            size = i - s + q
            if size >= max(12, 2 * q):
                found.setdefault((s, size), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def plant(ws, doc_id):
    n = len(ws)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not n:
        return ws
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [ws[a + (i - a) % p] if i >= a else ws[i] for i in range(n)]


def split(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected(doc_id, text):
    ws = plant(split(text), doc_id)
    runs = brute(ws)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(ws) if i not in gone)))


def some_words(rnd):
    k, n = rnd.choice([1, 2, 2, 3, 4, 20]), rnd.choice([0, 3, 11, 12, 13, 40, 100, 300])
    ws = [str(rnd.randrange(k)) for _ in range(n)]
    kind = rnd.randrange(4)
    if kind == 1 and n:
        a = rnd.randrange(n)
        p = rnd.randrange(1, max(2, (n - a) // 2 + 1))
        ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    if kind == 2:
        x, y = "a", "b"
        while len(y) < n:
            x, y = y, y + x
        ws = list(y[:n])
    if kind == 3:
        block = ws[:rnd.randrange(1, 20)]
        ws = block * rnd.randrange(1, 9) + [str(rnd.randrange(k)) for _ in range(5)] + block * rnd.randrange(1, 9)
    return ws


def found(docs):
    texts = [" ".join(d).encode() for d in docs]
    w = words(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    start, size, period = P.find_runs(w)
    out = [[] for _ in docs]
    for d, s, n, q in zip(np.searchsorted(w.docs, start, "right") - 1, start, size, period):
        out[d].append((int(s - w.docs[d]), int(n), int(q)))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(12):
        docs = [some_words(rnd) for _ in range(rnd.randrange(1, 30))]
        assert found(docs) == [brute(d) for d in docs]


def test_every_place_of_a_nonterminal_is_covered():
    """The grammar derives the text: its nodes, at all their places, hold one expansion each."""
    rnd = random.Random(3)
    docs = [some_words(rnd) for _ in range(40)]
    flat = np.array([hash((k, w)) & (2**63 - 1) for k, d in enumerate(docs) for w in d], np.uint64)
    at = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    g = P.repair(flat, at)
    texts = {}
    for rule, start in zip(g.rule, g.start):
        body = flat[start:start + g.size[rule]].tobytes()
        assert texts.setdefault(rule, body) == body
    assert len(g.rule) == sum(max(len(d) - 1, 0) for d in docs)  # a binary tree over every document


def test_report_equals_brute_force(documents):
    rows = AWKWARD + corpus(60) + [(900 + i, "p q r " * i + "tail words of it", "s") for i in range(12)]
    got = sorted((tuple(r) for r in P.report(documents(rows)).collect()), key=str)
    assert got == sorted((expected(d, t) for d, t, _ in rows), key=str)


def test_long_text_and_empty_table(spark, documents):
    ws = [str(i % 977) for i in range(60_000)] + ["end"]
    (row,) = P.runs(documents([(2, " ".join(ws), "s")])).collect()
    assert [tuple(r) for r in row["runs"]] == [(0, 60_000, 977)] and row["collapsed"] == " ".join(ws[:977] + ["end"])
    assert P.report(documents([(1, "a", "s")]).where("false")).collect() == []


def test_prefix_hashes_tell_thue_morse_words_apart():
    """Polynomial hashes modulo 2**64 fail on these; two primes do not."""
    word = "a"
    for _ in range(12):
        word += word.translate(str.maketrans("ab", "ba"))
    half = len(word) // 2
    h = np.array([hash(("x", c)) & (2**63 - 1) for c in word], np.uint64)
    p = P.Prefixes(h)
    one = lambda i: np.array([i])
    assert not p.equal(one(0), one(half), one(half))[0]
    assert p.forward(one(0), one(half), one(half))[0] == 0


def test_joined_texts():
    data = np.frombuffer(b" ab  c d ", np.uint8)
    w = words(data, np.array([0, 0, 6, 6, 9]))
    assert P._joined(data, w.starts, w.ends, w.docs) == pa.array(["", "ab c", "", "d"])
