"""Operator 11 against a plain Merkle tree, its requests, and stored records."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from barsmith.llm import merkle_manifest as M
from tests.llm.conftest import AWKWARD


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, more=0):
    n = None if row["n_chars"] is None else row["n_chars"] + more
    out = []
    for v in (row["doc_id"], row["source"], row["lang"], n, row["text"]):
        v = None if v is None else str(v)
        out.append("-" if v is None else f"{len(v.encode())}:{v}")
    return H(*out)


def proofs(nodes):
    """(top, siblings of every node with their side) of a plain tree."""
    paths, place, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, i in enumerate(place):
            if (i ^ 1) < len(level):
                paths[k].append((i % 2, level[i ^ 1]))
            else:
                paths[k].append(None)
            place[k] = i // 2
        level = [H(*level[i:i + 2]) for i in range(0, len(level), 2)]
    return level[0], paths


def expected(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append(r)
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    subs, low = [], []
    for lang in order:
        here = sorted(trees[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        top, paths = proofs([leaf_of(r) for r in here])
        subs.append(top)
        low.append((here, paths))
    root, high = proofs(subs)
    out = []
    for (here, paths), sub, more in zip(low, subs, high):
        for r, path in zip(here, paths):
            whole = path + more
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node = leaf_of(r, 1 if hit else 0)
            for e in whole:
                node = H(node) if e is None else H(e[1], node) if e[0] else H(node, e[1])
            out.append((r["doc_id"], leaf_of(r), sub, root, H(*[e[1] for e in whole if e]), node, node == root))
    return out


def check(df):
    rows = [r.asDict() for r in df.collect()]
    got = [tuple(r) for r in M.report(df).collect()]
    key = lambda t: tuple("" if x is None else str(x) for x in t)
    assert sorted(got, key=key) == sorted(expected(rows), key=key)
    return got


@pytest.fixture()
def many(spark):
    from barsmith.llm.runtime import stored

    def make(n, langs):
        lang = F.element_at(F.array(*[F.lit(x) for x in langs]), (F.col("id") % len(langs) + 1).cast("int"))
        lang = F.when(F.col("id") % 3 == 0, F.lit(langs[0])).otherwise(lang)  # a hot lang
        return stored(spark.range(n).select(
            F.when(F.col("id") % 11 > 0, F.col("id")).alias("doc_id"), lang.alias("lang"), F.lit("s").alias("source"),
            F.when(F.col("id") % 5 > 0, F.col("id")).alias("n_chars"), F.concat(F.lit("é "), F.col("id") % 50).alias("text"),
            F.lit("x").alias("tree"), F.lit(1).alias("rank"), F.lit("y").alias("leaf")), "t-many")

    return make


def test_awkward_rows(documents):
    check(documents(AWKWARD))


@pytest.mark.parametrize("n", [1, 2, 3, 255, 257, 1500])
def test_sizes_of_trees(many, n):
    check(many(n, ["en", None, "", "é", "fr"]))


def test_one_lang_of_several_strides(many):
    got = check(many(1300, ["en"]))
    assert 0 < sum(not r[-1] for r in got) < len(got) // 3  # tampered rows, and only they


def test_empty_table(many):
    assert M.report(many(5, ["en"]).where("false")).collect() == []


def test_requests_follow_their_prefixes_only(many):
    df = many(1500, ["en", "fr"])
    manifest = M.build(df.select("lang", "doc_id", M.leaf_of(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]).alias("digest")))
    some = manifest.leaves.where("rank % 97 = 5").select("tree", "rank", F.col("digest").alias("mine"))
    got = M.descend(manifest, some).select("asked.*", "leaf", "path").collect()
    assert len(got) == some.count() > 10 and all(r["leaf"] == bytes(r["mine"]).hex() for r in got)
    everything = {(r["tree"], r["rank"]): r["path"] for r in M.descend(manifest).select("asked.tree", "asked.rank", "path").collect()}
    assert all(everything[r["tree"], r["rank"]] == r["path"] for r in got)


def test_records_are_addressed_by_content(many):
    """A record proves itself; one whose children were changed is found out."""
    df = many(600, ["en"])
    manifest = M.build(df.select("lang", "doc_id", M.leaf_of(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]).alias("digest")))
    r = manifest.langs.records[0].first()
    assert M._opened(bytes(r["digest"]), r["depth"], bytes(r["children"]))[-1] == [bytes(r["digest"]).hex()]
    with pytest.raises(ValueError):
        M._opened(bytes(r["digest"]), r["depth"], bytes(r["children"])[::-1])


def test_segment_collects_the_unselected_children():
    levels = M.levels_up([H(str(i)) for i in range(5)], 3)
    assert M.segment(levels, 4) == ["", "", "<" + levels[2][0]]
    assert M.segment(levels, 1) == ["<" + levels[0][0], ">" + levels[1][1], ">" + levels[2][1]]
