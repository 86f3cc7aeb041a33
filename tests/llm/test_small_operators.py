"""Exact dedup, sharding, line quality, mixing: against brute force on awkward and random rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from barsmith.llm import entropy_mix, line_quality, splitter_shards, trie_dedup
from tests.llm.conftest import AWKWARD, corpus

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("rows", [AWKWARD, corpus(), []], ids=["awkward", "random", "empty"])
def test_exact_dedup(documents, rows):
    docs = documents(rows)
    groups = defaultdict(list)
    for d, t, _ in rows:
        groups[SPACE.sub("", t or "")].append((-len(t or ""), d is None, d))
    want = []
    for d, t, _ in rows:
        body = SPACE.sub("", t or "")
        best = min(groups[body], key=lambda x: (x[0], x[1], x[2] or 0))
        want.append((d, best[2], len(groups[body]), (-len(t or ""), d is None, d) == best,
                     hashlib.sha256(body.encode()).hexdigest()))
    got = [tuple(r) for r in trie_dedup.report(docs).collect()]
    assert Counter(got) == Counter(want)
    kept = trie_dedup.dedup(docs)
    assert kept.columns == docs.columns
    texts = [SPACE.sub("", r["text"] or "") for r in kept.collect()]
    assert sorted(texts) == sorted(groups)
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} <= {(d, t) for d, t, _ in rows}


def test_trie_keeps_every_key():
    trie = trie_dedup.RadixTrie()
    keys = [b"romane", b"romanus", b"romulus", b"rom", b"r", b"x" * 50, b"x" * 49 + b"y", b"romane"]
    for k in keys:
        trie.insert(k, 1, lambda a, b: a + b)
    assert dict(trie.items()) == Counter(keys)
    assert [k for k, _ in trie.items()] == sorted(set(keys))


def test_trie_flushes_whole_subtrees(monkeypatch, documents):
    monkeypatch.setattr(trie_dedup, "TRIE_BYTES", 10)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "text": ["ab", "a b", "cd", "abc"]})
    rows = pa.Table.from_batches(list(trie_dedup._collapse(iter([batch, batch])))).sort_by(
        [("text_len", "ascending"), ("text_hash", "ascending")])
    out = pa.Table.from_batches(list(trie_dedup._own(iter(rows.to_batches())))).to_pylist()
    assert sorted((r["keep_id"], r["group_size"]) for r in out) == [(2, 4), (3, 2), (4, 2)]


@pytest.mark.parametrize("broadcast", [100, 0])
def test_a_text_of_very_many_tasks_is_merged_by_salt_first(documents, monkeypatch, broadcast):
    monkeypatch.setattr(trie_dedup, "BROADCAST", broadcast)
    monkeypatch.setattr(trie_dedup, "HOT", 1)
    monkeypatch.setattr(trie_dedup, "TASK_BYTES", 0)  # every row leaves alone: each copy is a row
    monkeypatch.setattr(trie_dedup, "SALTS", 3)
    rows = [(i, "hot text" + " " * (i % 5), "s") for i in range(300)] + [(1000 + i, f"own {i % 40}", "s") for i in range(60)]
    got = {r["doc_id"]: r for r in trie_dedup.report(documents(rows).repartition(7)).collect()}
    assert len(got) == 360
    assert {(got[i]["keep_id"], got[i]["group_size"]) for i in range(300)} == {(4, 300)}
    assert [i for i in got if got[i]["kept"]] and sum(r["kept"] for r in got.values()) == 41
    assert {got[1000 + i]["group_size"] for i in range(20)} == {2}


def test_the_row_that_stays_among_equals_is_the_same_in_every_run(spark):
    rows = [(1, "a b", "en", f"s{i}", 3) for i in range(40)]
    want = {tuple(r) for r in trie_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)).collect()}
    again = {tuple(r) for r in trie_dedup.dedup(spark.createDataFrame(rows[::-1], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)).collect()}
    assert want == again and len(want) == 1


def test_many_lines_are_cut_in_linear_time(documents):
    """Boilerplate documents of thousands of lines: the cut texts hold the other lines, in order."""
    common = [f"common{i} line{i} here{i}" for i in range(4000)]
    rows = [(i, "\n".join(common + [f"own{i}x{k} words{i}x{k} there{k}" for k in range(4000)]), "s") for i in range(24)]
    out = line_quality.apply(documents(rows)).collect()
    assert len(out) == 24
    for r in out:
        assert r["text"].split("\n") == rows[r["doc_id"]][1].split("\n")[4000:] and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("rows", [AWKWARD, corpus(), []], ids=["awkward", "random", "empty"])
def test_sharding(documents, rows):
    got = splitter_shards.report(documents(rows)).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 16
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_evens_out_a_hot_text(spark, documents):
    rows = [(i, "the same text " * 20 if i % 3 else f"text {i} " * 20, "s") for i in range(3000)]
    got = splitter_shards.report(documents(rows)).collect()
    size = Counter()
    for r in got:
        size[r.shard] += r["size"]
    assert len(size) == 16
    assert max(size.values()) - min(size.values()) < 0.02 * sum(size.values()) / 16 + 2 * max(r["size"] for r in got)


def _quality(rows, limits=line_quality.LineLimits()):
    lines, host_docs, out = defaultdict(set), defaultdict(set), []
    split = lambda t: [(x, WORD.findall(x)) for x in (t or "").split("\n") if WORD.search(x)]
    low = lambda ws: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in " ".join(ws))
    for _, t, s in rows:
        key = " ".join(low(ws) for _, ws in split(t))
        host_docs[s].add(key)
        for _, ws in split(t):
            lines[s, low(ws)].add(key)
    over = {k for k, v in lines.items() if len(v) > max(limits.min_docs, limits.max_share * len(host_docs[k[0]]))}
    for d, t, s in rows:
        t = t or ""
        ws = WORD.findall(t)
        wins = defaultdict(list)
        for i in range(len(ws) - 4):
            wins[tuple(ws[i:i + 5])].append(i)
        rep = {j for v in wins.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
        seen, dup, gone = set(), 0, 0
        for x, lw in split(t):
            dup += x in seen
            seen.add(x)
            gone += len(lw) * ((s, low(lw)) in over)
        n = len(ws)
        failed = n < 10 or 100 * len(rep) > 20 * n
        left = n - gone
        depleted = gone > 0 and (left < limits.min_words or left < limits.min_left * n)
        out.append((d, n, sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), dup, len(rep), failed,
                    not failed and not depleted, left))
    return out, over


@pytest.mark.parametrize("rows", [AWKWARD, corpus(400), []], ids=["awkward", "random", "empty"])
def test_line_quality(documents, rows):
    docs = documents(rows)
    limits = line_quality.LineLimits(min_docs=5, max_share=0.02)
    want, over = _quality(rows, limits)
    assert Counter(map(tuple, line_quality.report(docs, limits).collect())) == Counter(want)
    if len(rows) > 300:
        assert over and any(not w[7] and not w[6] for w in want)  # some are depleted
    kept = line_quality.apply(docs, limits)
    assert kept.columns == docs.columns and kept.schema["n_chars"] == docs.schema["n_chars"]
    texts = Counter()
    for (d, t, s), w in zip(rows, want):
        if w[7]:
            low = lambda x: " ".join(WORD.findall(x)).lower()
            stay = [x for x in (t or "").split("\n") if not (WORD.search(x) and (s, low(x)) in over)]
            texts[d, "\n".join(stay)] += 1
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == texts
    assert all(r["n_chars"] == len(r["text"]) and r["row"] == "x" for r in kept.collect())


def _targets(size):
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    total, capped = sum(size.values()), {}
    while True:
        free = [s for s in size if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * size[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: 3.0 * size[s] for s in over})


@pytest.mark.parametrize("rows", [AWKWARD, corpus(600), [(1, None, "a"), (2, " ", None)], []],
                         ids=["awkward", "random", "no words", "empty"])
def test_mixing(documents, rows):
    docs = documents(rows)
    got = entropy_mix.report(docs).collect()
    count = lambda t: len(WORD.findall(t or ""))
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((d, count(t)) for d, t, _ in rows)
    size, source = Counter(), {}
    for d, t, s in rows:
        size[s] += count(t)
    targets = _targets(size) if size else {}
    if len(rows) > 100:
        source = {d: s for d, _, s in rows}
        taken, rate = Counter(), defaultdict(set)
        for r in got:
            s = source[r.doc_id]
            assert r.source_size == size[s] and r.target == pytest.approx(targets[s], rel=1e-9)
            taken[s] += r.taken
            rate[s, r["size"]].add(r.rate)
        assert all(abs(taken[s] - targets[s]) <= 0.01 * targets[s] + 3 for s in size)
        assert all(len(v) == 1 for v in rate.values())  # rates are tilted by size only
        import math

        for s in size:  # log rates are a line through 0
            slopes = [math.log(next(iter(v))) / z for (x, z), v in rate.items() if x == s and next(iter(v)) < 2.999]
            assert max(slopes) - min(slopes) < 1e-6 * max(abs(x) for x in slopes) + 1e-12
    assert all(r.taken <= 3 * r["size"] and r.taken == r["size"] * r.copies for r in got)
    again = entropy_mix.report(docs.repartition(3)).collect()
    if len(rows) > 100:
        assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    copies = entropy_mix.apply(docs)
    assert copies.columns == docs.columns
    assert copies.count() == sum(r.copies for r in got)


def test_water_filling_caps_small_sources(documents):
    rows = [(i, "w " * 50, "b") for i in range(40)] + [(99, "w " * 10, "a")]
    got = {r.doc_id: r for r in entropy_mix.report(documents(rows)).collect()}
    assert got[99].target == 30 and got[99].taken == 30  # 5/7 of all words, capped at 3 times its size
    assert got[0].target == pytest.approx(2010 - 30)
