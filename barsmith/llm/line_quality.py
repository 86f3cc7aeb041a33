"""Quality rules with cross-document line frequency (operator 9).

A line (``\\n``-split, holding a word) is normalised to its words in lower
case, joined by one space, and hashed.  For every host (``source``; null is a
host of its own) the distinct documents holding a line are counted; documents
with the same words count once, so copies of one document do not turn its
lines into boilerplate.  A line is over the limit when it occurs in more than
``max(min_docs, max_share * documents of the host)`` of them; such lines are
removed.  A document is *depleted* when a line was removed and fewer than
``min_words`` words, or less than ``min_left`` of its words, remain.  It is
kept when the base rules pass (``base_failed``) and it is not depleted.

Null text counts as empty: no words, so ``base_failed``.  Repeated rows each
get their own output row (rows are numbered before the checkpoint).  Only
line hashes travel, never texts; the counts pre-aggregate, and AQE splits the
join where one line of one host is very frequent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm.runtime import SPACE_BYTES, release, ship, slices, stored_rows, utf8
from barsmith.llm.wordhash import SLICE_BYTES, covered, per_doc, whole_windows, window_hashes, words
from barsmith.session import shared_dir

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5

BATCH_BYTES = 4 << 20  # text measured at a time


@dataclass(frozen=True)
class LineLimits:
    min_docs: int = 20
    max_share: float = 0.02
    min_left: float = 0.3
    min_words: int = MIN_WORDS


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_BASE_DDL = ("row long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, text_key long, lines array<struct<pos:int,line:long,words:int>>")
_LINES = pa.list_(pa.struct([("pos", pa.int32()), ("line", pa.int64()), ("words", pa.int32())]))


def _signed(b: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(b)
    return h - (1 << 64) if h >> 63 else h


def _repeat_words(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Per document: words inside a window of five words found twice or more in it."""
    w = words(data, offs)
    at = whole_windows(w, REPEAT_WINDOW)
    if not len(at):
        return np.zeros(len(offs) - 1, np.int64)
    # one key for (document, window): the document number spreads over the word
    key = window_hashes(w.hashes, REPEAT_WINDOW)[at] ^ (w.doc_of()[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    repeated = np.zeros(len(at), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    return per_doc(covered(len(w.hashes), at[repeated], REPEAT_WINDOW), w.docs)


def _line_rows(raw: bytes) -> tuple[list[dict], int, int, bytes]:
    """(lines with words, word count, duplicate lines, normalised text) of one text."""
    seen, out, n_words, dup, whole = set(), [], 0, 0, []
    for pos, line in enumerate(raw.split(b"\n")):
        w = line.split()
        if w:
            dup += line in seen
            seen.add(line)
            n_words += len(w)
            norm = b" ".join(w).lower()
            whole.append(norm)
            out.append({"pos": pos, "line": _signed(norm), "words": len(w)})
    return out, n_words, dup, b" ".join(whole)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        release()
        carried = [c for c in whole.schema.names if c not in ("row", "host", "text")]
        for i, j in slices(utf8(whole.column("text"))[1], BATCH_BYTES):
            batch = whole.slice(i, j - i)
            data, offs = utf8(batch.column("text"))
            raw = data.tobytes()
            chars = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            blank = np.isin(data, np.frombuffer(SPACE_BYTES, np.uint8))
            symbols = np.isin(data, np.frombuffer(SYMBOLS, np.uint8))
            repeats = [_repeat_words(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]) for a, b in slices(offs, SLICE_BYTES)]
            parsed = [_line_rows(raw[a:b]) for a, b in zip(offs[:-1], offs[1:])]
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("host"),
                pa.array([p[1] for p in parsed], pa.int64()),
                pa.array(chars - per_doc(blank, offs), pa.int64()),
                pa.array(per_doc(symbols, offs), pa.int64()),
                pa.array([p[2] for p in parsed], pa.int64()),
                pa.array(np.concatenate(repeats), pa.int64()),
                pa.array([_signed(p[3]) for p in parsed], pa.int64()),
                pa.array([p[0] for p in parsed], _LINES),
                *[batch.column(c) for c in carried],
            ], names=["row", "host", *_MEASURES, "text_key", "lines", *carried])


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.withColumn("row", F.monotonically_increasing_id())


def line_verdicts(numbered: DataFrame, limits: LineLimits = LineLimits(), host: str = "source",
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """Per ``row``: base measures, ``removed`` (line positions over the limit),
    ``words_left``, ``base_failed``, ``kept``, and the columns named in ``carry``."""
    spark = numbered.sparkSession
    ship(spark)
    shared_dir(spark)  # checkpoints go to the folder that the cluster names
    schema = T.StructType.fromDDL(_BASE_DDL)
    for c in carry:
        schema = schema.add(numbered.schema[c])
    base = numbered.select("row", F.col(host).cast("string").alias("host"), "text", *carry).mapInArrow(
        _measure, schema).checkpoint()

    texts = base.select("host", "text_key", F.array_distinct(F.col("lines.line")).alias("lines"))
    host_docs = (texts.select("host", "text_key").distinct().groupBy(F.col("host").alias("h"))
                 .agg(F.count(F.lit(1)).alias("docs")))
    frequent = (texts.select("host", "text_key", F.explode("lines").alias("line"))
                .distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
                .where(F.col("n") > limits.min_docs))
    over = (frequent.join(host_docs, F.col("host").eqNullSafe(F.col("h")))
            .where(F.col("n") > limits.max_share * F.col("docs"))
            .select(F.col("host").alias("h"), F.col("line").alias("over_line")))
    lines = base.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.*")
    removed = (lines.join(over, F.col("host").eqNullSafe(F.col("h")) & (F.col("line") == F.col("over_line")))
               .groupBy("row").agg(F.sum("words").alias("gone"), F.collect_list("pos").alias("removed")))

    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    depleted = F.col("gone").isNotNull() & (
        (left < limits.min_words) | (left < limits.min_left * F.col("n_words")))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return base.select("row", *_MEASURES, *carry).join(removed, "row", "left").select(
        "row", *carry, *_MEASURES, "removed", left.alias("words_left"), failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"))


def report(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """One row per document: the base measures, base_failed, kept, words_left."""
    numbered = _numbered(docs.select("doc_id", "source", "text"))
    return line_verdicts(numbered, limits, carry=("doc_id",)).select(
        "doc_id", *_MEASURES, "base_failed", "kept", F.col("words_left").cast("long").alias("words_left"))


def _without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their removed lines; linear in a text's lines."""
    for batch in batches:
        texts = batch.column("text")
        removed = batch.column("removed")
        at = np.flatnonzero(np.array(removed.is_valid()))
        if len(at):
            cut = texts.to_pylist()
            for i in at.tolist():
                gone = set(removed[i].as_py())
                cut[i] = "\n".join(line for k, line in enumerate(cut[i].split("\n")) if k not in gone)
            texts = pa.array(cut, pa.string())
        yield pa.RecordBatch.from_arrays([texts, batch.column("whole"), removed], names=["text", "whole", "removed"])
    release()


def apply(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """``docs`` without rejected documents and without lines over the limit.

    ``n_chars``, where present, follows a shortened text; other columns stay.
    Rows are numbered once, in a stored table.
    """
    cols = docs.columns
    stored = stored_rows(docs)
    verdicts = line_verdicts(stored.select("row", "whole.source", "whole.text"), limits).where("kept").select("row", "removed")
    kept = stored.join(verdicts, "row").select("whole", "removed", F.col("whole.text").alias("text"))
    shape = T.StructType([docs.select("text").schema["text"], *kept.select("whole", "removed").schema.fields])
    done = kept.mapInArrow(_without_lines, shape)
    out = {"text": F.col("text")}
    if "n_chars" in cols:
        out["n_chars"] = F.when(F.col("removed").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("whole.n_chars"))
    return done.select(*[out.get(c, F.col("whole").getField(c)).alias(c) for c in cols])
