"""Blocks of documents that ask hash-partitioned buckets about their keys.

``blocked`` deals rows, by a number stored with them or by their content, to blocks
of about ``BLOCK_BYTES`` of text each, at least one for each shuffle partition.
Blocks, and buckets, of which there are as many, grow in number with the text
and never in size, and rows that are equal in every column spread too.  A block
reduces its texts to distinct 64-bit keys and sends each bucket one row: its
sorted keys, packed, with what it knows of them; never more rows than it has
keys.  A bucket gathers the rows of all blocks and sends every block an answer
aligned to its keys, so answers carry no keys.  A key, however frequent,
arrives once per block: hot keys need no salting.  The block's texts are read
again (Spark reuses the exchange) when the answers come back by ``cogroup``.

With B blocks a row holds about 1/B of a block's keys, so packing pays less as
the text grows: executors with more memory take a larger ``BLOCK_BYTES``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.runtime import pack_sorted, release, ship, shuffle_partitions, stored_rows

BLOCK_BYTES = 2 << 20


def blocked(docs: DataFrame, block_bytes: int = 0, store: bool = True) -> tuple[DataFrame, int, int]:
    """(``docs`` with its block ``g``, number of blocks, which is that of buckets too, bytes of text).

    ``store`` writes the rows with their numbers first, for work of several jobs.  Without it, for
    one job that reads one exchange, rows are dealt by doc_id and text, and by their number where
    the doc_id is null."""
    ship(docs.sparkSession)
    if store:
        rows = stored_rows(docs)
        size = rows.agg(F.sum(F.octet_length("whole.text"))).first()[0] or 0
        dealt, by = rows.select("row", "whole.*"), F.xxhash64("row")
    else:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        which = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0))
        dealt, by = docs, F.xxhash64("doc_id", "text", which)
    n = max(size // (block_bytes or BLOCK_BYTES), shuffle_partitions(docs.sparkSession))
    return dealt.select(*docs.columns, F.pmod(by, F.lit(n)).cast("int").alias("g")), n, size


def tidy(work):
    """``work``, giving its memory back after every group."""
    def run(*tables: pa.Table) -> pa.Table:
        out = work(*tables)
        release()
        return out

    # Spark tells a plain function from a keyed one by the number of its parameters
    return (lambda a: run(a)) if work.__code__.co_argcount == 1 else (lambda a, b: run(a, b))


def bucket_bounds(keys: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` buckets begins in sorted ``keys``: n + 1 positions."""
    first = [(b << 64) // n for b in range(1, n)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(first, np.uint64)), [len(keys)]])


def bucket_rows(keys: np.ndarray, n: int):
    """(bucket, slice) of sorted ``keys`` for every bucket that gets some."""
    at = bucket_bounds(keys, n)
    return [(b, slice(int(at[b]), int(at[b + 1]))) for b in range(n) if at[b + 1] > at[b]]


def key_blob(keys: np.ndarray) -> bytes:
    return pack_sorted(keys)


def one_value(table: pa.Table, name: str):
    return table.column(name)[0].as_py()
