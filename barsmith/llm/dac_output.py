"""Token ids as directly addressable codes in binary files (operator 7).

Encoding: the tokenizers library encodes every whole text; id 0 ends each
document.  A byte-level BPE never merges across its pre-tokens, and a single
space between two non-space characters always begins a pre-token.  So a batch
is cut there, its distinct pieces are encoded once, and the documents' ids are
put together from them; texts with the rare other white space around a cut
keep it inside a piece.  A text that holds one of the vocabulary's added tokens
(``<|endoftext|>``, anywhere) is encoded whole by the unaltered library, which
gives such a token its own id.  (Tested equal to encoding every text by itself.)

File format ``.dac`` (little endian), one file per run of documents:
magic ``DAC1``, then uint32 header length, JSON header, then the sections named
there.  Ids are split into chunks of ``chunk_bits``; level k holds chunk k of
the ids that reach it, and a continuation bitmap says which go on.  A rank
directory (ones before every 512-bit block) maps a position to its place in
the next level, so any single token is read without decoding a block:
``DacFile.token(i)``.  Two more sections hold doc_ids and token counts.

Documents are range-partitioned by doc_id and row and sorted; each task writes
files of at most ``FILE_TOKENS`` ids to the folder of ``spark.checkpoint.dir``.
Every attempt of a task names its files anew, and the manifest, a table that
Spark commits, holds the names of the attempts that count: no file is ever
renamed or overwritten, and what a lost attempt left is not read.
Reading uses Spark's ``binaryFile`` source.

Null text counts as empty (just the end id).  Null doc_ids come first;
repeated rows are documents of their own.  Rows that share a doc_id, or have
none, are put in the order they are read in, so any number of them spreads
over several ranges.
"""

from __future__ import annotations

import json
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barsmith.llm.runtime import release, ship, shuffle_partitions, slices, utf8
from barsmith.llm.wordhash import span_hashes
from barsmith.session import scratch_path

END_ID = 0
CHUNK_BITS = (8, 4, 4)
BLOCK_BITS = 512
FILE_TOKENS = 1 << 21
ENCODE_BYTES = 1 << 21
KEPT_PIECES = 1_000_000
BATCH_TEXTS = 8  # texts of 16 KB given to the library at a time: its results are large
_MAGIC = b"DAC1"

# ------------------------------------------------------------------ directly addressable codes


def dac_encode(ids: np.ndarray, chunk_bits=CHUNK_BITS) -> dict[str, np.ndarray]:
    """Sections ``level<k>`` (chunks), ``more<k>`` (bitmap words), ``rank<k>``."""
    out, rest, last = {}, ids.astype(np.uint32), len(chunk_bits) - 1
    if rest.size and int(rest.max()) >> sum(chunk_bits):
        raise ValueError(f"an id needs more than {sum(chunk_bits)} bits")
    for k, bits in enumerate(chunk_bits):
        out[f"level{k}"] = _pack_bits(rest & np.uint32((1 << bits) - 1), bits)
        if k == last:
            break
        rest = rest >> np.uint32(bits)
        more = rest > 0
        words = np.zeros(-(-len(more) // BLOCK_BITS) * BLOCK_BITS, bool)
        words[:len(more)] = more
        ones = words.reshape(-1, BLOCK_BITS).sum(1)
        out[f"more{k}"] = np.packbits(words, bitorder="little")
        out[f"rank{k}"] = np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)
        rest = rest[more]
    return out


def _pack_bits(values: np.ndarray, bits: int) -> np.ndarray:
    """Values of 4, 8 or 16 bits, densely."""
    if bits == 4:
        v = values.astype(np.uint8)
        if len(v) % 2:
            v = np.append(v, np.uint8(0))
        return v[::2] | (v[1::2] << 4)
    return values.astype({8: "<u1", 16: "<u2"}[bits])


def _unpack_bits(section: np.ndarray, n: int, bits: int) -> np.ndarray:
    if bits == 4:
        return np.stack([section & 15, section >> 4], 1).reshape(-1)[:n].astype(np.uint32)
    return section[:n].astype(np.uint32)


def dac_bytes(ids: np.ndarray, doc_ids: list, lengths: np.ndarray, chunk_bits=CHUNK_BITS) -> bytes:
    """A whole file."""
    sections = dac_encode(ids, chunk_bits)
    sections["doc_null"] = np.array([d is None for d in doc_ids], np.uint8)
    sections["doc_id"] = np.array([0 if d is None else d for d in doc_ids], "<i8")
    sections["doc_tokens"] = lengths.astype("<u8")
    parts, at, where = [], 0, {}
    for name, a in sections.items():
        b = np.ascontiguousarray(a).tobytes()
        where[name] = [at, a.dtype.str, len(a)]
        parts.append(b + b"\0" * (-len(b) % 8))
        at += len(parts[-1])
    head = json.dumps({"tokens": len(ids), "chunk_bits": list(chunk_bits), "sections": where}).encode()
    head += b" " * (-(len(head) + 8) % 8)
    return _MAGIC + struct.pack("<I", len(head)) + head + b"".join(parts)


class DacFile:
    """Random access to the tokens of one file's bytes."""

    def __init__(self, blob: bytes) -> None:
        if blob[:4] != _MAGIC:
            raise ValueError("not a DAC1 file")
        (n,) = struct.unpack_from("<I", blob, 4)
        head = json.loads(blob[8:8 + n])
        self.tokens, self.bits = head["tokens"], head["chunk_bits"]
        self.s = {k: np.frombuffer(blob, t, c, 8 + n + at) for k, (at, t, c) in head["sections"].items()}

    def doc_ids(self) -> list:
        return [None if z else int(d) for d, z in zip(self.s["doc_id"], self.s["doc_null"])]

    def token(self, i: int) -> int:
        """Token ``i``: one chunk per level, placed by the rank directory."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        value, shift = 0, 0
        for k, bits in enumerate(self.bits):
            level = self.s[f"level{k}"]
            chunk = int(level[i // 2]) >> (4 * (i % 2)) & 15 if bits == 4 else int(level[i])
            value |= chunk << shift
            shift += bits
            if k == len(self.bits) - 1 or not int(self.s[f"more{k}"][i >> 3]) >> (i & 7) & 1:
                return value
            block = i // BLOCK_BITS
            first = block * BLOCK_BITS // 8
            bitmap = self.s[f"more{k}"][first:i // 8 + 1]
            ones = np.unpackbits(bitmap, bitorder="little")[:i - block * BLOCK_BITS].sum()
            i = int(self.s[f"rank{k}"][block]) + int(ones)
        return value

    def all(self) -> np.ndarray:
        """All tokens, level by level from the last."""
        sizes = [self.tokens]
        for k in range(len(self.bits) - 1):
            sizes.append(int(self.s[f"rank{k}"][-1]))
        values = None
        for k in reversed(range(len(self.bits))):
            chunk = _unpack_bits(self.s[f"level{k}"], sizes[k], self.bits[k])
            if values is not None:
                more = np.unpackbits(self.s[f"more{k}"], bitorder="little")[:sizes[k]].astype(bool)
                chunk[more] |= values << np.uint32(self.bits[k])
            values = chunk
        return values


# ------------------------------------------------------------------ encoding


def _solid(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that begin, and bytes that end, a character known not to be white space:
    printable ASCII, and U+00C0 to U+00FF (lead byte C3)."""
    ascii_ = (data > 32) & (data < 127)
    lead = data == 0xC3
    last = ascii_.copy()
    last[1:] |= lead[:-1]
    return ascii_ | lead, last


class ByteBpe:
    """The tokenizers library behind the cut into distinct pieces."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)  # as the library reads it
        self.added = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values() if t.content]
        self.t = Tokenizer.from_file(path)  # for pieces of texts without added tokens
        self.t.encode_special_tokens = True  # pieces joined by chance into such a token are no such token
        self.joining = not any(b" " in t for t in self.added)
        size = self.t.get_vocab_size()
        self.width = np.array([len(self.t.id_to_token(i) or "") for i in range(size)], np.int64)
        self._forget()

    @classmethod
    def cached(cls, path: str) -> "ByteBpe":
        """One per Python worker."""
        kept = sys.modules[__name__].__dict__.setdefault("_tokenizers", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, ids per document)."""
        rare = self._holding_added(data, offs)
        if not len(rare):
            return self._plain(data, offs)
        ids, counts, at = [], [], 0
        for d in np.append(rare, len(offs) - 1):  # the documents before d, then d itself
            if d > at:
                some, n = self._plain(data[offs[at]:offs[d]], offs[at:d + 1] - offs[at])
                ids.append(some)
                counts.append(n)
            if d < len(offs) - 1:
                text = data[offs[d]:offs[d + 1]].tobytes().decode()
                ids.append(np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32))
                counts.append([len(ids[-1])])
            at = d + 1
        return np.concatenate(ids), np.concatenate(counts).astype(np.int64)

    def _holding_added(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Documents with an added token's text, in order."""
        raw, found = data.tobytes(), set()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                d = int(np.searchsorted(offs, at, "right")) - 1
                inside = at + len(token) <= offs[d + 1]
                if inside:
                    found.add(d)
                at = raw.find(token, int(offs[d + 1]) if inside else at + 1)
        return np.array(sorted(found), np.int64)

    def _plain(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of documents without added tokens."""
        n = len(data)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offs) - 1, np.int64)
        # a piece starts at each document, and at each single space between two solid characters
        first, last = _solid(data)
        cut = np.zeros(n, bool)
        cut[1:-1] = (data[1:-1] == 32) & last[:-2] & first[2:]
        cut[offs[:-1][offs[:-1] < n]] = True
        starts = np.flatnonzero(cut)
        bounds = np.append(starts, n).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = pieces.dictionary_encode()
        codes = coded.indices.to_numpy()
        ids, counts = self._known(coded.dictionary)
        first = np.concatenate([[0], np.cumsum(counts)])
        sizes = counts[codes]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + np.repeat(first[codes], sizes)
        total = np.concatenate([[0], ends])
        doc = total[np.searchsorted(starts, offs)]
        return ids[at], np.diff(doc)

    def _known(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``_pieces``, with what this worker has encoded before looked up.

        Kept pieces are found by a 64-bit hash and their length; past
        ``KEPT_PIECES`` the store starts afresh (it only saves time).
        """
        data, offs = utf8(pieces)
        keys, width = span_hashes(data, offs[:-1], offs[1:]), np.diff(offs)
        if len(self.keys) > KEPT_PIECES:
            self._forget()
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        found = (self.keys[at] == keys) & (self.widths[at] == width) if len(self.keys) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~found)
        ids, counts = self._pieces(pieces.take(pa.array(new)))
        held = len(self.ids)
        self.ids = np.concatenate([self.ids, ids.astype(np.uint16 if len(self.width) <= 1 << 16 else np.uint32)])
        first = np.empty(len(keys), np.int64)
        total = np.empty(len(keys), np.int64)
        first[found], total[found] = self.first[at[found]], self.count[at[found]]
        first[new], total[new] = held + np.cumsum(counts) - counts, counts
        order = np.argsort(keys[new])
        place = np.searchsorted(self.keys, keys[new][order])
        for name, more in (("keys", keys), ("widths", width), ("first", first), ("count", total)):
            setattr(self, name, np.insert(getattr(self, name), place, more[new][order]))
        ends = np.cumsum(total)
        spread = np.arange(ends[-1]) + np.repeat(first - (ends - total), total)
        return self.ids[spread].astype(np.uint32), total

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.widths, self.count = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.first = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint16 if len(self.width) <= 1 << 16 else np.uint32)

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, ids per piece).  Pieces that begin with a space and are solid
        at both ends are joined and encoded as few long texts; token widths give back their borders."""
        data, offs = utf8(pieces)
        k = len(pieces)
        if not k:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        width = np.diff(offs)
        begins, ends_solid = _solid(data)
        joins = (width > 1) & (data[offs[:-1]] == 32) & self.joining
        joins &= begins[np.minimum(offs[:-1] + 1, len(data) - 1)] & ends_solid[offs[1:] - 1]
        order = np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])
        chunks = pieces.take(pa.array(order))
        raw, at = utf8(chunks)
        n_joined = int(joins.sum())
        texts = [raw[at[i]:at[j]].tobytes().decode() for i, j in slices(at[:n_joined + 1], 1 << 14)] if n_joined else []
        texts += [raw[at[i]:at[i + 1]].tobytes().decode() for i in range(n_joined, k)]
        ids = np.concatenate([
            np.array(e.ids, np.uint32) for i in range(0, len(texts), BATCH_TEXTS)
            for e in self.t.encode_batch(texts[i:i + BATCH_TEXTS], add_special_tokens=False)])
        ends = np.cumsum(self.width[ids])
        upto = np.searchsorted(ends, at[1:], "right")  # tokens that end within the first pieces
        counts = np.diff(np.concatenate([[0], upto]))
        # back to the pieces' own order
        out = np.empty(k, np.int64)
        out[order] = counts
        first = np.concatenate([[0], np.cumsum(out)])[:-1]
        place = np.repeat(first[order], counts) + np.arange(len(ids)) - np.repeat(upto - counts, counts)
        sorted_ids = np.empty_like(ids)
        sorted_ids[place] = ids
        return sorted_ids, out


def _encoded(batch: pa.RecordBatch, bpe: ByteBpe):
    """(doc_ids, ids, lengths) of runs of the batch's documents, end ids included."""
    doc_ids = batch.column("doc_id").to_pylist()
    data, offs = utf8(batch.column("text"))
    for i, j in slices(offs, ENCODE_BYTES):
        ids, n = bpe.encode(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        yield doc_ids[i:j], np.insert(ids, np.cumsum(n), END_ID), n + 1


# ------------------------------------------------------------------ files


def _writer(folder: str, tokenizer: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        bpe = ByteBpe.cached(tokenizer)
        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(root, recursive=True)
        part, seq, docs, ids, sizes, held = TaskContext.get().partitionId(), 0, [], [], [], 0

        def flush():
            nonlocal seq, docs, ids, sizes, held
            name = f"part-{part:06d}-{seq:06d}-{uuid.uuid4().hex[:12]}.dac"
            tokens = np.concatenate(ids)
            with store.open_output_stream(f"{root}/{name}") as f:
                f.write(dac_bytes(tokens, docs, np.concatenate(sizes)))
            row = pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                 pa.array([len(docs)], pa.int64()), pa.array([len(tokens)], pa.int64())],
                names=["name", "part", "seq", "docs", "tokens"])
            seq, docs, ids, sizes, held = seq + 1, [], [], [], 0
            return row

        for batch in batches:
            for d, i, n in _encoded(batch, bpe):
                if held and held + len(i) > FILE_TOKENS:
                    yield flush()
                docs, held = docs + d, held + len(i)
                ids.append(i)
                sizes.append(n)
            release()
        if docs:
            yield flush()
        release()

    return write


def write_tokens(docs: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """Encode and write; returns the manifest ``name, part, seq, docs, tokens, start``."""
    spark = docs.sparkSession
    ship(spark)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("__row"))
    ordered = keyed.repartitionByRange(shuffle_partitions(spark), "doc_id", "__row").sortWithinPartitions(
        "doc_id", "__row").drop("__row")
    (ordered.mapInArrow(_writer(folder, tokenizer), "name string, part int, seq int, docs long, tokens long")
     .write.parquet(f"{folder}/_manifest"))
    manifest = spark.read.parquet(f"{folder}/_manifest")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob, start in zip(batch.column("content"), batch.column("start").to_pylist()):
            f = DacFile(blob.as_py())
            ids = f.all().astype("<u4")
            n = f.s["doc_tokens"].astype(np.int64)
            ends = np.cumsum(n)
            raw = memoryview(ids).cast("B")
            yield pa.RecordBatch.from_arrays([
                pa.array(f.doc_ids(), pa.int64()), pa.array(start + ends - n, pa.int64()), pa.array(n, pa.int64()),
                pa.array([zlib.crc32(raw[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), n.tolist())], pa.int64()),
            ], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    files = manifest.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*.dac").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return named.join(manifest.select("name", "start"), "name").select("content", "start").mapInArrow(
        _reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def report(docs: DataFrame, tokenizer: str) -> DataFrame:
    folder = scratch_path(docs.sparkSession, "token-files")
    return read_tokens(write_tokens(docs, tokenizer, folder), folder)
