"""Row numbers hold although a later read of the input is split otherwise."""

from collections import Counter

import pytest

from barsmith.llm import entropy_mix, line_quality, minhash_forest
from tests.llm.conftest import corpus


@pytest.fixture()
def resplit(spark):
    """Call it to have later reads split otherwise, as with other cores; the input is several files."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda: spark.conf.set(key, "3000")
    spark.conf.set(key, before)


def _copies(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_numbers_differ_between_the_splits(documents, resplit):
    docs = documents(corpus())
    from pyspark.sql import functions as F

    numbers = lambda: {r.doc_id: r.n for r in docs.select(
        "doc_id", F.monotonically_increasing_id().alias("n")).collect()}
    before = numbers()
    resplit()
    assert numbers() != before


@pytest.mark.parametrize("work", [line_quality.apply, minhash_forest.dedup, entropy_mix.apply],
                         ids=["quality", "near dedup", "mixing"])
def test_whole_rows_follow_their_verdicts(documents, resplit, work):
    docs = documents(corpus())
    want = _copies(work(docs))
    out = work(docs)
    resplit()
    assert want and _copies(out) == want


def test_texts_are_verified_under_their_numbers(documents, resplit, monkeypatch):
    docs = documents(corpus())
    want = Counter(map(tuple, minhash_forest.report(docs).collect()))
    meet = minhash_forest.connected

    def connected(edges):  # comes between the signatures and the read of the texts
        resplit()
        return meet(edges)

    monkeypatch.setattr(minhash_forest, "connected", connected)
    assert Counter(map(tuple, minhash_forest.report(docs).collect())) == want
