"""Merge-dropout draws for every occurrence and every copy of a document."""

import numpy as np
import pyarrow as pa
import pytest

from barsmith.llm import piece_dropout
from barsmith.llm.queries import tokenizer_path
from barsmith.llm.runtime import utf8
from tests.llm.test_tokens import PIECES, odd_texts


@pytest.fixture(scope="module")
def model():
    return piece_dropout.PieceModel(tokenizer_path(PIECES))


@pytest.mark.parametrize("unit", ["international ", "x" * 20 + "the" * 20 + " "], ids=["word", "long"])
def test_a_hot_chunk_gets_more_than_four_segmentations(model, unit):
    texts = [unit[:-1]] * 300
    ids, n = model.encode(*utf8(pa.array(texts)), np.arange(300))
    assert len({tuple(x) for x in np.split(ids, np.cumsum(n)[:-1])}) > 4


def test_kept_plain_runs_equal_segmenting_every_occurrence(model, monkeypatch):
    args = (*utf8(pa.array(odd_texts())), np.arange(len(odd_texts())))
    for dropout in (0.02, 0.1, 0.6):
        some = model.encode(*args, dropout=dropout)
        with monkeypatch.context() as m:
            m.setattr(model, "_varied", lambda code, *_: np.ones(len(code), bool))
            every = model.encode(*args, dropout=dropout)
        assert (some[0] == every[0]).all() and (some[1] == every[1]).all()


def test_copies_of_a_document_are_cut_differently(documents):
    text = "international understanding of several organisations " * 20
    rows = [(1, text, "s")] * 3 + [(2, text, "s"), (None, text, "s"), (None, text + "x", "s")]
    docs = documents(rows)
    got = piece_dropout.encode_copies(docs, tokenizer_path(PIECES)).collect()
    assert len(got) == len(rows) and all(r.lossless for r in got)
    assert len({tuple(r.ids) for r in got}) == len(rows)
    again = piece_dropout.encode_copies(docs.repartition(4), tokenizer_path(PIECES)).collect()
    assert sorted(r.ids_crc32 for r in got) == sorted(r.ids_crc32 for r in again)


def test_the_copies_of_the_pipeline_are_cut_differently(spark, documents):
    import corpus_pipeline as C

    mixed = documents([(1, "international understanding of several organisations " * 20, "s")] * 3)
    assert len({tuple(r.ids) for r in dict(C.STAGES)["SentencePiece encoding"](spark, mixed, "").collect()}) == 3
