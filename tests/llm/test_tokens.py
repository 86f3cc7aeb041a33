"""SentencePiece merge-dropout and token files: exact round trips and the public libraries."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from barsmith.llm import dac_output, piece_dropout
from barsmith.llm.queries import tokenizer_path
from barsmith.llm.runtime import utf8
from tests.llm.conftest import AWKWARD, corpus

PIECES, BYTES = "piece_bpe_32k.model", "byte_bpe_50k.json"
ALPHABET = " \t\n\r\x0b ▁　ab1thein's.,é×ßñ字😀<s>\x00\x7fco<|endoftext|>"


def odd_texts(n=1500, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(70))) for _ in range(n)] + [
        "", " ", "   ", " a ", "x" * 400, "theinthein" * 40, "字" * 200, "it's  a", "don't 'll"]


@pytest.fixture(scope="module")
def model():
    return piece_dropout.PieceModel(tokenizer_path(PIECES))


def test_without_dropout_equals_the_library(model):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    texts = [t for t in odd_texts() if "▁" not in t]
    ids, n = model.encode(*utf8(pa.array(texts)), np.arange(len(texts)), dropout=0)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == sp.encode(texts)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_every_text_decodes_losslessly(model, dropout):
    texts = odd_texts()
    data, offs = utf8(pa.array(texts))
    ids, n = model.encode(data, offs, np.arange(len(texts)), dropout=dropout)
    back, ends = model.decode(ids, n)
    assert back.tobytes() == data.tobytes() and (ends == offs).all()


def test_numpy_rounds_equal_the_heap(model, monkeypatch):
    texts = odd_texts()
    args = (*utf8(pa.array(texts)), np.arange(len(texts)))
    rounds = model.encode(*args, dropout=0.3)
    monkeypatch.setattr(piece_dropout, "SHORT", 1)
    heap = model.encode(*args, dropout=0.3)
    assert (rounds[0] == heap[0]).all() and (rounds[1] == heap[1]).all()


def test_agenda_against_a_plain_loop(model):
    """One merge at a time: best rank, then leftmost, of the candidates that the keyed hash leaves."""
    from barsmith.llm.runtime import mix64

    limit = int(0.3 * 2 ** 64)
    rnd = random.Random(5)
    for _ in range(200):
        text = "".join(rnd.choice("theinatorg ") for _ in range(rnd.randrange(1, 14))).strip() or "the"
        raw, key = np.frombuffer(text.encode(), np.uint8), np.array([rnd.getrandbits(64)], np.uint64)
        ids = [int(model.char_id[ord(c)]) for c in text]
        starts = list(range(len(ids)))
        while True:
            best = None
            for i in range(len(ids) - 1):
                merged = int(model.merge(np.array([ids[i]]), np.array([ids[i + 1]]))[0])
                if merged < 0:
                    continue
                h = mix64(key + np.array([starts[i]], np.uint64) * piece_dropout._K1
                          + np.array([merged], np.uint64) * piece_dropout._K2)[0]
                if int(h) >= limit and (best is None or model.rank[merged] < best[0]):
                    best = (model.rank[merged], i, merged)
            if best is None:
                break
            _, i, merged = best
            ids[i:i + 2], starts[i + 1:i + 2] = [merged], []
        got, _ = model.segment(raw, np.array([0, len(raw)]), key, 0.3)
        assert got.tolist() == ids, text


def test_dropout_varies_and_is_seeded(model):
    texts = ["international understanding " * 50]
    args = utf8(pa.array(texts))
    one = model.encode(*args, np.array([1]))
    assert (one[0] == model.encode(*args, np.array([1]))[0]).all()
    assert len(one[0]) > len(model.encode(*args, np.array([1]), dropout=0)[0])
    other = model.encode(*args, np.array([1]), seed=1)
    assert one[0].tolist() != other[0].tolist()
    assert len({tuple(x) for x in np.array_split(one[0], 50)}) > 1  # occurrences differ


@pytest.mark.parametrize("rows", [AWKWARD, []], ids=["awkward", "empty"])
def test_sentencepiece_query(documents, rows):
    out = piece_dropout.encode(documents(rows), tokenizer_path(PIECES))
    assert "text" not in out.columns and out.columns.count("ids") == 1 and "row" in out.columns
    got = out.collect()
    assert len(got) == len(rows) and all(r.lossless for r in got)
    for r in got:
        assert r.n_pieces == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    assert {r.doc_id for r in got if r.n_pieces == 0} == ({4, 5, 7} if rows else set())


def library():
    """The tokenizers library as it reads the file, nothing altered."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(BYTES))


SPECIAL = ["<|endoftext|>", "a <|endoftext|> b", "word<|endoftext|>word", " <|endoftext|>", "<|endoftext|><|endoftext|> x",
           "<|endof text|> <|endoftext| > <|endoftext", "it's<|endoftext|>'s", "é<|endoftext|>\n", "<|endoftext|>" * 40]


def test_pieces_equal_encoding_each_text():
    bpe = dac_output.ByteBpe(tokenizer_path(BYTES))
    texts = odd_texts(4000) + SPECIAL + [t for _, t, _ in corpus(40)] + SPECIAL
    texts += ["<|endof", "text|>", "<|endoftext|>"]  # a token's text across two documents is none
    data, offs = utf8(pa.array(texts))
    want = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    assert sum(50256 in w for w in want) > 15
    for _ in range(2):  # the second time, from what is kept
        ids, n = bpe.encode(data, offs)
        assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_kept_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(dac_output, "KEPT_PIECES", 10)
    bpe = dac_output.ByteBpe(tokenizer_path(BYTES))
    for _, t, _ in corpus(20):
        ids, _ = bpe.encode(*utf8(pa.array([t])))
        assert ids.tolist() == library().encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [(8, 8), (8, 4, 4), (4, 4, 8), (16,)])
def test_codes_give_random_access(bits):
    rnd = np.random.default_rng(1)
    for n in (0, 1, 2, 511, 512, 513, 3000):
        ids = rnd.choice([0, 1, 15, 16, 255, 256, 4095, 4096, 50256, 65535], n).astype(np.uint32)
        f = dac_output.DacFile(dac_output.dac_bytes(ids, [None, 5], np.array([n, 0]), bits))
        assert f.all().tolist() == ids.tolist() and f.doc_ids() == [None, 5]
        assert [f.token(i) for i in range(n)] == ids.tolist()
        with pytest.raises(IndexError):
            f.token(n)
    with pytest.raises(ValueError):
        dac_output.dac_encode(np.array([1 << 16]), (8, 8))
    with pytest.raises(ValueError):
        dac_output.DacFile(b"nope" * 9)


MARKED = [(i, t, "s") for i, t in enumerate(SPECIAL)]


@pytest.mark.parametrize("rows", [AWKWARD, MARKED, corpus(90), []], ids=["awkward", "marked", "random", "empty"])
def test_token_files_query(documents, rows, monkeypatch):
    monkeypatch.setattr(dac_output, "FILE_TOKENS", 2000)
    lib = library()
    got = dac_output.report(documents(rows), tokenizer_path(BYTES)).collect()
    assert len(got) == len(rows)
    want = sorted(
        (((d is not None, d or 0), d, [*lib.encode(t or "", add_special_tokens=False).ids, 0]) for d, t, _ in rows),
        key=lambda x: x[0])
    have = sorted(got, key=lambda r: r.start)
    at = 0
    for r, (_, d, ids) in zip(have, want):
        assert (r.doc_id, r.start, r.n_tokens) == (d, at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_rows_of_one_doc_id_spread_over_ranges(spark, documents):
    """Hot null and repeated doc_ids: no range holds them all, and every row is written once."""
    rows = [(None, f"null {i}", "s") for i in range(300)] + [(7, "same text", "s")] * 300 + [(i, "x", "s") for i in range(8, 300)]
    from barsmith.session import scratch_path

    folder = scratch_path(spark, "t-tokens")
    manifest = dac_output.write_tokens(documents(rows), tokenizer_path(BYTES), folder)
    parts = {r.part: r["sum(docs)"] for r in manifest.groupBy("part").sum("docs").collect()}
    assert sum(parts.values()) == len(rows) and max(parts.values()) < 250
    got = dac_output.read_tokens(manifest, folder).collect()
    assert sum(r.doc_id is None for r in got) == 300 and sum(r.doc_id == 7 for r in got) == 300
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_files_of_lost_attempts_are_not_read(spark, documents):
    from barsmith.session import scratch_path

    folder = scratch_path(spark, "t-tokens")
    manifest = dac_output.write_tokens(documents(corpus(30)), tokenizer_path(BYTES), folder)
    path = folder.replace("file:", "")
    import glob
    import shutil

    one = sorted(glob.glob(f"{path}/part-*.dac"))[0]
    shutil.copy(one, one.replace(".dac", "0.dac"))  # as if an attempt had written the same documents before it was lost
    assert dac_output.read_tokens(manifest, folder).count() == 30


def test_stored_ids_decode_to_the_texts(documents):
    rows = AWKWARD + [(100 + i, t, "s") for i, t in enumerate(odd_texts(200))]
    df = documents(rows)
    back = piece_dropout.decode(piece_dropout.encode(df, tokenizer_path(PIECES)), tokenizer_path(PIECES))
    assert back.columns[-1] == "text" and "row" in back.columns
    assert sorted((r.doc_id or -1, r.text) for r in back.collect()) == sorted((d or -1, t or "") for d, t, _ in rows)
    report = piece_dropout.report(df, tokenizer_path(PIECES)).collect()
    assert len(report) == len(rows) and all(r.lossless for r in report)


def test_decoding_null_ids(spark):
    df = spark.createDataFrame([(1, None, "old"), (2, [], "old")], "doc_id long, ids array<int>, text string")
    out = piece_dropout.decode(df, tokenizer_path(PIECES)).collect()
    assert [(r.doc_id, r.text) for r in out] == [(1, ""), (2, "")]


def test_texts_without_spaces_are_within_ten_times_of_spaced_ones(model):
    import time

    rnd = random.Random(1)
    letters = "".join(rnd.choice("etaoinshrdlu") for _ in range(200_000))
    spaced = " ".join(letters[i:i + 6] for i in range(0, len(letters), 6))
    took = []
    for text in (spaced, letters):
        args = (*utf8(pa.array([text])), np.array([1]))
        model.encode(*utf8(pa.array([text[:500]])), np.array([1]))
        began = time.process_time()
        ids, n = model.encode(*args)
        took.append(time.process_time() - began)
        assert model.decode(ids, n)[0].tobytes() == text.encode()
    assert took[1] < 10 * took[0] + 1
