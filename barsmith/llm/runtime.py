"""Helpers shared by the operators: shipping code, reading Arrow text, packing.

Python functions given to ``mapInArrow`` / ``applyInArrow`` are pickled by
reference, so executors must be able to import this package.  ``ship`` hands
it to them with ``addPyFile``, once per application.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters every contract here treats as white space: [\x20\x09-\x0D].
SPACE_BYTES = b" \t\n\x0b\x0c\r"
WORD_REGEX = r"[^\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make ``barsmith`` importable on the executors (idempotent)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    import barsmith

    root = os.path.dirname(os.path.abspath(barsmith.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="barsmith-"), "barsmith_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


# ------------------------------------------------------------------ Arrow text


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; null reads as empty."""
    arr = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    kind = pa.large_binary()
    if pa.types.is_string(arr.type):
        arr = arr.cast(pa.binary())
    elif pa.types.is_large_string(arr.type):
        arr = arr.cast(kind)
    if arr.null_count:
        arr = pc.fill_null(arr, b"")
    width = np.int64 if pa.types.is_large_binary(arr.type) else np.int32
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(arr.buffers()[1], width)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    buf = arr.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, most: int):
    """Runs (i, j) of rows holding at most ``most`` bytes each (one row at least)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def release() -> None:
    """Give freed memory back to the system: an executor's Python workers share its limit,
    and idle ones are kept for later tasks."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


# ------------------------------------------------------------------ packed arrays


def pack(a: np.ndarray) -> bytes:
    """A numeric array as bytes: byte planes, then zstd (see ``unpack``)."""
    import zstandard

    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(dtype)


def pack_sorted(a: np.ndarray) -> bytes:
    """Sorted uint64 keys: differences, then ``pack``."""
    d = a.copy()
    d[1:] -= a[:-1]
    return pack(d)


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64), dtype=np.uint64)


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (spreads every input bit over the word)."""
    h = h.astype(np.uint64, copy=True)
    for shift, mul in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(mul)
    h ^= h >> np.uint64(33)
    return h


def mix64_one(h: int) -> int:
    """``mix64`` of one Python integer (taken modulo 2**64)."""
    h &= 0xFFFFFFFFFFFFFFFF
    h = ((h ^ h >> 33) * 0xFF51AFD7ED558CCD) & 0xFFFFFFFFFFFFFFFF
    h = ((h ^ h >> 33) * 0xC4CEB9FE1A85EC53) & 0xFFFFFFFFFFFFFFFF
    return h ^ h >> 33


# ------------------------------------------------------------------ stored tables


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read from there: lineage ends, later reads agree."""
    from barsmith.session import scratch_path

    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_rows(docs: DataFrame, *cols: str) -> DataFrame:
    """``cols`` of ``docs`` (all columns by default) as (``row``: its number, ``whole``: a struct),
    numbered once, written to the shared folder and read from there.

    A row's number depends on how a read is split into tasks, which follows the
    cores registered when it is planned.  Numbers that are joined again must
    therefore come from this table, never from a second numbering."""
    whole = F.struct(*[F.col(f"`{c}`") for c in cols or docs.columns])
    return stored(docs.select(F.monotonically_increasing_id().alias("row"), whole.alias("whole")), "rows")


# ------------------------------------------------------------------ groups in sorted batches


def whole_groups(batches, keys: tuple[str, ...], most: int = 20_000):
    """Tables of whole groups from batches sorted by ``keys``, several small groups to a table."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < most:
            continue
        table = pa.Table.from_batches(held)
        last = np.ones(table.num_rows, bool)
        for k in keys:
            c = table.column(k).to_numpy()
            last &= c == c[-1]
        cut = int(np.argmax(last))  # the last group may go on in the next batch
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        if table.num_rows:
            yield table


def group_bounds(table: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    """Where each group of a table sorted by ``keys`` begins, and the table's end."""
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for k in keys:
        c = table.column(k).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)
