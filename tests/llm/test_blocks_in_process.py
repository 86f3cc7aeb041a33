"""Substring dedup without Spark: blocks and buckets as plain function calls, so that limits can be lowered."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from barsmith.llm import anchors, debruijn_dedup, suffix_dedup
from tests.llm.conftest import AWKWARD, corpus
from tests.llm.test_corpus_operators import _bytes_dedup, _tangled, _words_dedup

BUCKETS = 5


def _shared_line(n=40):
    """One line in every document, with different text around it."""
    line = " ".join(f"common{i}" for i in range(45))
    return [(i, f"own{i} start{i * 7} {line} tail{i} end{i * 3}" + (f" {line}" if i % 5 == 0 else ""), "s") for i in range(n)]


def _blocks(rows, n=3):
    for g in range(n):
        part = rows[g::n]
        yield pa.table({"doc_id": pa.array([r[0] for r in part], pa.int64()), "text": pa.array([r[1] for r in part]),
                        "g": pa.array([g] * len(part), pa.int32())})


def _group(table, column):
    values = table.column(column).to_numpy()
    for v in np.unique(values):
        yield int(v), table.filter(pa.array(values == v))


def _exchange(tables, column, work):
    return [work(t) for _, t in _group(pa.concat_tables(tables), column)]


def _to(tables, g):
    every = pa.concat_tables(tables)
    return every.filter(pa.array(every.column("g").to_numpy() == g))


CASES = pytest.mark.parametrize("rows", [AWKWARD, corpus(70), _tangled(5), _shared_line()],
                                ids=["awkward", "random", "tangled", "shared line"])
LIMITS = pytest.mark.parametrize("hot", [0, 3, 10 ** 6])


@CASES
@LIMITS
def test_suffix_dedup_at_any_heat(rows, hot, monkeypatch):
    monkeypatch.setattr(anchors, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SORT_WINDOWS", 50)
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 700)
    blocks = list(_blocks(rows))
    asked = [suffix_dedup._ask(BUCKETS)(b) for b in blocks]
    told = _exchange(asked, "bucket", anchors.find_repeated)
    sent = [suffix_dedup._send(BUCKETS)(b, _to(told, g)) for g, b in enumerate(blocks)]
    marks = _exchange(sent, "bucket", suffix_dedup._resolve)
    kind = lambda ts, k: [t.append_column("kind", pa.array([k] * len(t), pa.int32())) for t in ts]
    answers = kind(told, 0) + kind(marks, 1)
    out = [suffix_dedup._digest(BUCKETS, False)(b, _to(answers, g)) for g, b in enumerate(blocks)]
    got = Counter(tuple(r.values()) for t in out for r in t.to_pylist())
    assert got == Counter(_bytes_dedup(rows))


@CASES
@LIMITS
def test_substring_dedup_at_any_heat(rows, hot, monkeypatch):
    monkeypatch.setattr(anchors, "HOT", hot)
    blocks = list(_blocks(rows))
    asked = [debruijn_dedup._ask(BUCKETS)(b) for b in blocks]
    told = _exchange(asked, "bucket", anchors.find_repeated)
    sent = [debruijn_dedup._send(BUCKETS)(b, _to(told, g)) for g, b in enumerate(blocks)]
    runs = pa.concat_tables(_exchange(sent, "bucket", debruijn_dedup._fragments))
    # without compaction every fragment is a path of its own
    runs = runs.append_column("path", runs.column("fragment")).append_column("place", pa.array([0] * len(runs), pa.int64()))
    answers = pa.concat_tables([*told, runs.drop_columns(["fragment", "start_node", "end_node"])], promote_options="default")
    out = [debruijn_dedup._remove(BUCKETS)(b, answers.filter(pa.array(answers.column("g").to_numpy() == g)))
           for g, b in enumerate(blocks)]
    got = Counter(tuple(r.values())[:4] for t in out for r in t.to_pylist())
    assert got == Counter(_words_dedup(rows))


def test_a_hot_anchor_sends_each_window_once_a_block(monkeypatch):
    """The ends of a shared line differ from document to document; its inner windows do not."""
    from barsmith.llm.runtime import unpack

    rows = [(i, f"own{i} {' '.join(f'common{k}' for k in range(45))} tail{i}", "s") for i in range(60)]
    monkeypatch.setattr(anchors, "HOT", 0)
    blocks = list(_blocks(rows, 2))
    told = _exchange([debruijn_dedup._ask(1)(b) for b in blocks], "bucket", anchors.find_repeated)
    sent = [r for g, b in enumerate(blocks) for r in debruijn_dedup._send(1)(b, _to(told, g)).to_pylist()]
    inner, ends = 45 - 35 + 1, 2 * len(rows)
    assert sum(len(unpack(r["windows"], np.uint8)) for r in sent) <= 2 * inner + ends
