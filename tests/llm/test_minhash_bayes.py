"""Operator 12 against all pairs, its posterior bounds, hot groups and the comparison in blocks."""

import random
import re
from math import comb

import numpy as np
import pytest

from barsmith.llm import minhash_bayes as B
from tests.llm.conftest import AWKWARD, WORDS, corpus


def shingles(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(ws[i:i + 2]) for i in range(max(len(ws) - 1, 1))} if ws else set()


def expected(rows):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = [shingles(t) for _, t, _ in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                label[top(i)] = top(j)
    names = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            names[top(i)] = min(names.get(top(i), d), d)
    return sorted(((d, len(s), names.get(top(i)), d == names.get(top(i)))
                   for i, ((d, _, _), s) in enumerate(zip(rows, sets))), key=str)


def got(df):
    return sorted((tuple(r) for r in B.report(df).collect()), key=str)


def edited(rnd, base, most, tag):
    """``base`` with up to ``most`` words replaced."""
    ws = list(base)
    for _ in range(rnd.randrange(most + 1)):
        ws[rnd.randrange(len(ws))] = f"{tag}{rnd.randrange(10**6)}"
    return " ".join(ws)


def test_awkward_rows(documents):
    rows = AWKWARD + [(20, "One", "s"), (21, "oNE", "s"), (22, "one one", "s"), (23, "É é", "s"), (24, "é é", "s")]
    assert got(documents(rows)) == expected(rows)


def test_equals_all_pairs(documents):
    rows = corpus(160, seed=3)
    assert got(documents(rows)) == expected(rows)


def test_empty_table(documents):
    assert got(documents([(1, "a b", "s")]).where("false")) == []


def _families(seed, families, members, edits):
    """Families of near copies, some pairs near the threshold, some families near each other."""
    rnd = random.Random(seed)
    rows, old = [], None
    for f in range(families):
        base = [rnd.choice(WORDS) + str(rnd.randrange(40)) for _ in range(120)]
        if old and f % 2:
            base = old[:80] + base[80:]  # families that share most of their text
        old = base
        rows += [edited(rnd, base, edits, f"e{f}x") for _ in range(members)]
    rnd.shuffle(rows)
    return [(i, t, "s") for i, t in enumerate(rows)]


@pytest.mark.parametrize("edits", [4, 9])
def test_families_near_the_threshold(documents, edits):
    rows = _families(edits, 6, 40, edits)
    assert got(documents(rows)) == expected(rows)


def test_turns_of_stars_alone(documents, monkeypatch):
    """With no pairs allowed at once, stars go on until bands hold one component each."""
    monkeypatch.setattr(B, "WORK", 0)
    monkeypatch.setattr(B, "STALL", 10.0)
    rows = _families(13, 4, 20, 6)
    assert got(documents(rows)) == expected(rows)


def test_comparison_in_blocks(documents, monkeypatch):
    """Everything the first turn leaves goes through cells of a few members each."""
    calls = []
    cells = B._cells
    monkeypatch.setattr(B, "_cells", lambda m, lab: calls.append(1) or cells(m, lab))
    rows = _families(11, 6, 40, 9)
    assert got(documents(rows)) == expected(rows) and calls


def test_cells_hold_every_pair_once(spark, monkeypatch):
    """Pairs of different components meet in exactly one cell; a component's own pairs need none."""
    monkeypatch.setattr(B, "BLOCK", 4)
    members = [(7, 0, r) for r in range(30)] + [(8, 1, 1), (8, 1, 2)]
    labels = [(r, 0) for r in range(17)] + [(20, 19), (21, 19)]
    m = spark.createDataFrame(members, "band long, slot int, row long")
    lab = spark.createDataFrame(labels, "node long, label long")
    groups = {}
    for r in B._cells(m, lab).collect():
        groups.setdefault((r["band"], r["kind"], r["x"], r["y"]), []).append(r)
    seen = []
    for (band, kind, x, y), rows in groups.items():
        assert len(rows) <= 2 * 12
        for i, a in enumerate(rows):
            for b in rows[:i]:
                if a["label"] == b["label"]:
                    continue
                if (a["rest"] != b["rest"]) if kind == 0 else (x == y or a["mine"] != b["mine"]):
                    seen.append((band, *sorted((a["row"], b["row"]))))
    of = {**{r: r for r in range(30)}, **dict(labels)}
    want = [(7, i, j) for j in range(30) for i in range(j) if of[i] != of[j]]
    assert sorted(seen) == sorted(want)  # band 8 holds one component


def test_bounds_lose_no_more_than_the_chosen_chance():
    """At the threshold, the chance that a batch drops a pair is below MISS; the bounds rise batch by batch."""
    least = B.least_matches()
    assert least == sorted(least) and len(least) == B._VALUES // B.BATCH
    for k, m in enumerate(least):
        n = (k + 1) * B.BATCH
        assert sum(comb(n, i) * .8 ** i * .2 ** (n - i) for i in range(m)) < 2 * B.MISS
    assert (1 - B.THRESHOLD ** B.ROWS) ** B.BANDS < 5e-6


def test_measured_recall_near_the_threshold():
    """Pairs of 0.80 to 0.85: share a band and pass every batch."""
    rnd = np.random.default_rng(5)
    hit = n = 0
    for _ in range(300):
        size, other = 400, int(rnd.integers(35, 44))
        both = rnd.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64)
        a, b = np.append(both, rnd.integers(0, 2**63, other).astype(np.uint64)), np.append(both, rnd.integers(0, 2**63, other).astype(np.uint64))
        if not .8 <= size / (size + 2 * other) < .85:
            continue
        sig = [np.array([((s * m) >> np.uint64(32)).min() for m in B._MULTIPLIERS]) for s in (a, b)]
        bands = [s.reshape(B.BANDS, B.ROWS) for s in sig]
        met = (bands[0] == bands[1]).all(1).any()
        on, _ = B._agree(*[s.astype(np.uint16)[None] for s in sig])
        n, hit = n + 1, hit + int(met and len(on) == 1)
    assert n > 200 and hit == n


def test_common_shingles_are_counted_exactly():
    rnd = random.Random(2)
    sets = [sorted(rnd.sample(range(60), rnd.randrange(0, 40))) for _ in range(12)]
    h = np.array([x for s in sets for x in s], np.uint64)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    a, b = np.array([(i, j) for i in range(12) for j in range(12) if (i * 7 + j) % 3]).T
    assert B.common_shingles(h, at, a, b).tolist() == [len(set(sets[i]) & set(sets[j])) for i, j in zip(a, b)]
    none = np.zeros(0, np.int64)
    assert B.common_shingles(h, at, none, none).tolist() == []


def test_pointers_lead_to_roots(spark):
    edges = [(i, i - 1) for i in range(1, 20)] + [(40, 30), (41, 30), (50, 41)]
    got = {tuple(r) for r in B._roots(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {(i, 0) for i in range(20)} | {(i, 30) for i in (30, 40, 41, 50)}


def test_settled_links_are_linear_in_the_members(documents):
    """A large group of near copies, many pairs of it below the threshold: rows of links, not of pairs."""
    from barsmith.llm.runtime import ship, stored_rows
    from pyspark.sql import functions as F

    rows = _families(21, 2, 90, 14)
    df = documents(rows)
    ship(df.sparkSession)
    texts = stored_rows(df, "doc_id", "text").select("row", F.col("whole.doc_id").alias("doc_id"), F.col("whole.text").alias("text"))
    signed = texts.mapInArrow(B._sign, B._SIGNED)
    members = B.bands_of(signed)
    cells = B._cells(members, signed.select(F.col("row").alias("node"), F.col("row").alias("label")))
    links = B.settled(cells, signed.select("row", "signature"), texts).collect()
    assert 100 < len(links) < 40 * len(rows)  # of up to 2 * 90 * 89 / 2 pairs in each of 32 bands
    sets = {r["row"]: shingles(r["text"]) for r in texts.collect()}
    assert all(100 * len(sets[r["u"]] & sets[r["v"]]) >= 80 * len(sets[r["u"]] | sets[r["v"]]) for r in links)


def _in_one_table(texts):
    """The links that ``_settle`` finds in cells that hold all ``texts`` in every band."""
    import pyarrow as pa

    n = len(texts)
    signed = pa.Table.from_batches(B._sign(iter([pa.record_batch(
        {"row": pa.array(range(n), pa.int64()), "doc_id": pa.array(range(n), pa.int64()), "text": pa.array(texts)})])))
    sig = signed.column("signature").combine_chunks()
    cells = [pa.record_batch({
        "band": pa.array([s] * n, pa.int64()), "kind": pa.array([1] * n), "x": pa.array([0] * n), "y": pa.array([0] * n),
        "slot": pa.array([s] * n), "row": pa.array(range(n), pa.int64()), "label": pa.array(range(n), pa.int64()),
        "rest": pa.array([True] * n), "mine": pa.array([0] * n), "signature": sig, "text": pa.array(texts)}) for s in range(B.BANDS)]
    return pa.Table.from_batches(B._settle(iter(cells)), pa.schema([("u", pa.int64()), ("v", pa.int64())])).to_pylist()


@pytest.mark.parametrize("members", [30, 60])
def test_settled_links_of_a_group_are_a_forest(members):
    """Near copies of one text, most pairs linked: the links that leave grow with the group, not with its pairs."""
    rows = sorted(_families(17, 1, members, 5))
    sets = [shingles(t) for _, t, _ in rows]
    every = [(i, j) for i in range(members) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    links = [(r["u"], r["v"]) for r in _in_one_table([t for _, t, _ in rows])]
    label = lambda pairs: B.local_labels(members, *np.array(pairs).reshape(-1, 2).T).tolist()
    assert len(every) > 4 * members and set(links) <= set(every)
    assert label(links) == label(every) and len(links) == members - len(set(label(every)))


def test_spanning_edges_join_what_all_edges_join():
    rnd = np.random.default_rng(3)
    for m in (0, 10, 40, 400):
        a, b = rnd.integers(0, 60, (2, m))
        some = B.spanning(60, a, b)
        assert len(some) == 60 - len(set(B.local_labels(60, a, b).tolist()))
        assert (B.local_labels(60, a[some], b[some]) == B.local_labels(60, a, b)).all()


def test_dedup_keeps_one_row_of_each_component(documents):
    rows = _families(2, 3, 20, 3) + [(None, "a b c", "s"), (None, "a b c", "s"), (5000, None, "s"), (5000, None, "s")]
    df = documents(rows)
    kept = B.dedup(df)
    assert kept.columns == df.columns
    parts = {r[2] for r in expected(rows) if r[2] is not None and r[2] != 5000}
    assert kept.count() == len(parts) + 1 + 2  # one of the nulls; empty texts are alone
