"""SentencePiece BPE with seeded merge-dropout, and its decoder (operator 1).

The text is cut where pieces never cross: before each run of spaces (a piece
holds spaces only at its front).  Such a chunk is segmented by the agenda of
byte-pair merging -- best score first, then leftmost -- but each candidate
merge, when its two symbols first meet, is skipped for good if a keyed hash of
(seed, document, copy, place, position, merged piece) falls below ``dropout``.
The place is the occurrence's own, so every occurrence of a chunk is cut by its
own draws.  A skip matters only where the plain run would have merged: each
distinct chunk's plain run is kept for a slice of text with its merges, an
occurrence whose hashes skip none of them takes that result, and any other is
segmented on its own.  With ``dropout`` 0 the result equals the sentencepiece
library's.

Chunks of up to ``SHORT`` symbols run together in numpy, one merge each per
round; longer ones (texts without spaces) use a heap, O(n log n).  ``decode``
turns a stored table of ids into texts again.

Unknown characters become byte pieces.  A literal U+2581, which the library
would turn into a space, also does, so decoding is lossless for every text.

Null and empty texts have no pieces.  A document is its doc_id (null counts as
0) and text.  ``encode`` gives repeated rows equal pieces; ``encode_copies``
numbers equal rows first, so copies made by mixing are cut each in its own way.
"""

from __future__ import annotations

import heapq
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm.runtime import mix64, mix64_one, release, ship, slices, stored, stored_rows, utf8
from barsmith.llm.anchors import ranges

SEED = 20240917
DROPOUT = 0.1
SHORT = 48
SLICE = 1 << 22
GRID = 1 << 18  # symbols of chunks segmented at a time
DRAWS = 1 << 16  # occurrences whose hashes are drawn at a time

_SPACE = "▁"  # how the vocabulary writes a space
_NONE = np.int64(1 << 62)
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class PieceModel:
    """Vocabulary tables of a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(size)]
        is_byte = [sp.is_byte(i) for i in range(size)]
        ids = {p: i for i, p in enumerate(self.pieces) if not special[i] and not is_byte[i]}
        self.byte_id = np.zeros(256, np.int32)
        raw = []
        for i, p in enumerate(self.pieces):
            if is_byte[i]:
                self.byte_id[int(p[3:5], 16)] = i
                raw.append(bytes([int(p[3:5], 16)]))
            else:
                raw.append(b"" if special[i] else p.replace(_SPACE, " ").encode())
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_len = np.array([len(r) for r in raw], np.int64)
        self.raw_at = np.cumsum(self.raw_len) - self.raw_len
        self.char_id = np.full(0x110000, -1, np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                self.char_id[ord(p)] = i
        self.char_id[32], self.char_id[ord(_SPACE)] = self.char_id[ord(_SPACE)], -1
        scores = np.array([sp.get_score(i) for i in range(size)])
        self.merges: dict[int, tuple[int, int]] | None = None
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        # (left, right) -> merged piece, in an open-addressing table
        self.bits = 20
        pairs = [(ids[p[:k]], ids[p[k:]], i) for p, i in ids.items() for k in range(1, len(p))
                 if p[:k] in ids and p[k:] in ids]
        while len(pairs) * 4 > 1 << self.bits:
            self.bits += 1
        keys = np.array([a << 32 | b for a, b, _ in pairs], np.int64)
        merged = np.array([m for _, _, m in pairs], np.int32)
        self.table_key = np.full(1 << self.bits, -1, np.int64)
        self.table_val = np.full(1 << self.bits, -1, np.int32)
        slot, todo, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(todo):  # place what finds a free slot, move the rest on by one
            s = slot[todo]
            free = self.table_key[s] == -1
            _, first = np.unique(s, return_index=True)
            win = np.zeros(len(todo), bool)
            win[first] = True
            win &= free
            self.table_key[s[win]] = keys[todo[win]]
            self.table_val[s[win]] = merged[todo[win]]
            todo = todo[~win]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    @classmethod
    def cached(cls, path: str) -> "PieceModel":
        """One per Python worker."""
        kept = sys.modules[__name__].__dict__.setdefault("_models", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _K1) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged piece of each pair of symbols, -1 where there is none."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        slot = self._slot(keys)
        out = np.where(self.table_key[slot] == keys, self.table_val[slot], np.int32(-1))
        todo = np.flatnonzero((self.table_key[slot] != keys) & (self.table_key[slot] != -1))
        for _ in range(self.probes):
            if not len(todo):
                break
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            held = self.table_key[slot[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = self.table_val[slot[todo[hit]]]
            todo = todo[~hit & (held != -1)]
        out[(left < 0) | (right < 0)] = -1
        return out

    # -------------------------------------------------------------- segmentation

    def _candidates(self, left, right, start, key, limit):
        """Order of each candidate merge (rank, then start), _NONE where absent or skipped."""
        merged = self.merge(left, right)
        order = (self.rank[merged] << 32) | start
        order[merged < 0] = _NONE
        if limit:
            h = mix64(key + start.astype(np.uint64) * _K1 + merged.astype(np.int64).astype(np.uint64) * _K2)
            order[h < np.uint64(limit)] = _NONE
        return order, merged

    def _rounds(self, sym: np.ndarray, key: np.ndarray, limit: int, made: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Segment n chunks of up to L symbols at once; sym is n x L, padded with -1.

        Returns the symbols and the start of each (L marks the padding); ``made`` gathers
        (rows, starts, merged pieces) of the merges."""
        n, width = sym.shape
        out, out_start = sym.copy(), np.broadcast_to(np.arange(width), sym.shape).copy()
        start = out_start.copy()
        out_start[sym == -1] = width
        start[sym == -1] = width
        rows = np.arange(n)
        wide = np.repeat(key, width - 1)
        order, merged = self._candidates(sym[:, :-1].ravel(), sym[:, 1:].ravel(), start[:, :-1].ravel(), wide, limit)
        order, merged = order.reshape(n, -1), merged.reshape(n, -1)
        place = np.arange(width - 1)
        while len(rows):
            at = order.argmin(1)
            me = np.arange(len(rows))
            live = order[me, at] < _NONE
            if not live.all():
                done = ~live
                out[rows[done]], out_start[rows[done]] = sym[done], start[done]
                rows, sym, start, key = rows[live], sym[live], start[live], key[live]
                order, merged, at = order[live], merged[live], at[live]
                me = np.arange(len(rows))
                if not len(rows):
                    break
            sym[me, at] = merged[me, at]
            if made is not None:
                made.append((rows, start[me, at], sym[me, at]))
            # close the gap that the right symbol leaves
            move = place[None, :] > at[:, None]
            sym[:, :-1] = np.where(move, sym[:, 1:], sym[:, :-1])
            start[:, :-1] = np.where(move, start[:, 1:], start[:, :-1])
            sym[:, -1], start[:, -1] = -1, width
            order[:, :-1] = np.where(move[:, :-1] | (place[None, :-1] == at[:, None]), order[:, 1:], order[:, :-1])
            merged[:, :-1] = np.where(move[:, :-1] | (place[None, :-1] == at[:, None]), merged[:, 1:], merged[:, :-1])
            order[:, -1] = _NONE
            for shift in (0, -1):  # the merged symbol meets its right and its left neighbour
                j = at + shift
                ok = (j >= 0) & (j < width - 1)
                r, j = me[ok], j[ok]
                order[r, j], merged[r, j] = self._candidates(sym[r, j], sym[r, j + 1], start[r, j], key[r], limit)
        return out, out_start

    def _merges(self) -> dict[int, tuple[int, int]]:
        """left << 32 | right -> (rank << 32, merged piece): the same table for single look-ups."""
        if self.merges is None:
            held = np.flatnonzero(self.table_key >= 0)
            keys, made = self.table_key[held], self.table_val[held]
            self.merges = dict(zip(keys.tolist(), zip((self.rank[made] << 32).tolist(), made.tolist())))
        return self.merges

    def _heap(self, sym: np.ndarray, key: int, limit: int) -> np.ndarray:
        """The same agenda for one long chunk; returns (symbols, starts)."""
        n = len(sym)
        ids, nxt, prv = sym.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        one = np.array([key], np.uint64)
        known, key, k1, k2 = self._merges(), int(key), int(_K1), int(_K2)
        order, merged = self._candidates(sym[:-1], sym[1:], np.arange(n - 1), np.repeat(one, n - 1), limit)
        agenda = [(int(o), i, ids[i], ids[i + 1], int(m)) for i, (o, m) in enumerate(zip(order, merged)) if o < _NONE]
        heapq.heapify(agenda)
        alive = [True] * n
        while agenda:
            _, i, left, right, piece = heapq.heappop(agenda)
            j = nxt[i]
            if not alive[i] or j >= n or ids[i] != left or ids[j] != right:
                continue
            ids[i], alive[j], nxt[i] = piece, False, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for a, b in ((i, nxt[i]), (prv[i], i)):
                found = known.get(ids[a] << 32 | ids[b]) if a >= 0 and b < n and ids[a] >= 0 and ids[b] >= 0 else None
                if found and not (limit and mix64_one(key + a * k1 + found[1] * k2) < limit):
                    heapq.heappush(agenda, (found[0] | a, a, ids[a], ids[b], found[1]))
        keep = np.flatnonzero(alive)
        return np.array(ids, np.int64)[keep], keep

    def segment(self, data: np.ndarray, offs: np.ndarray, keys: np.ndarray, dropout: float, made: list | None = None):
        """Pieces of each chunk data[offs[i]:offs[i+1]]: (ids, ids per chunk).

        ``made`` gathers (chunks, starts, merged pieces) of the merges in chunks of up to ``SHORT`` symbols."""
        if not len(offs) - 1:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        limit = min(int(dropout * 2.0 ** 64), (1 << 64) - 1)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        begins = (data & 0xC0) != 0x80
        upto = np.concatenate([[0], np.cumsum(begins)])[offs]
        n_chars = np.diff(upto)
        sym = self.char_id[points]
        n = len(n_chars)
        starts_of, symbols_of, owner_of = [], [], []
        bands = [0, *[b for b in (6, 10, 16, 28) if b < SHORT], SHORT]
        for low, high in zip(bands, bands[1:]):
            band = np.flatnonzero((n_chars > low) & (n_chars <= high))
            for group in np.split(band, range(GRID // high, len(band), GRID // high)) if len(band) else ():
                mine = None if made is None else []
                spot = np.minimum(upto[group][:, None] + np.arange(high), len(sym) - 1)
                inside = np.arange(high) < n_chars[group][:, None]
                # symbols are piece ids, -1 pads, and an unknown character is -2
                grid = np.where(inside, np.where(sym[spot] < 0, -2, sym[spot]), -1).astype(np.int32)
                got, start = self._rounds(grid, keys[group], limit, mine) if high > 1 else (grid, np.zeros_like(grid))
                r, c = np.nonzero(start < high)
                owner_of.append(group[r])
                symbols_of.append(got[r, c].astype(np.int64))
                starts_of.append(start[r, c] + upto[group[r]])
                if mine:
                    made.extend((group[rows], at, piece) for rows, at, piece in mine)
        for g in np.flatnonzero(n_chars > SHORT):
            got, start = self._heap(np.where(sym[upto[g]:upto[g + 1]] < 0, -2, sym[upto[g]:upto[g + 1]]).astype(np.int64),
                                    keys[g], limit)
            owner_of.append(np.full(len(got), g))
            symbols_of.append(got)
            starts_of.append(start + upto[g])
        if not owner_of:
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        owner, symbols, starts = map(np.concatenate, (owner_of, symbols_of, starts_of))
        order = np.argsort(starts, kind="stable")
        owner, symbols, starts = owner[order], symbols[order], starts[order]
        # unknown characters: one byte piece for each of their UTF-8 bytes
        first = np.flatnonzero(begins)
        size = np.diff(np.append(first, len(data)))[starts]
        count = np.where(symbols < 0, size, 1)
        ends = np.cumsum(count)
        ids = np.repeat(symbols, count)
        within = np.arange(ends[-1]) - np.repeat(ends - count, count)
        unknown = ids < 0
        ids[unknown] = self.byte_id[data[np.repeat(first[starts], count)[unknown] + within[unknown]]]
        return ids.astype(np.int32), np.bincount(np.repeat(owner, count), minlength=n)

    # -------------------------------------------------------------- texts

    def _varied(self, code: np.ndarray, keys: np.ndarray, n_kinds: int, made: list, long: np.ndarray, limit: int) -> np.ndarray:
        """Which occurrences (chunk number, key) differ from the plain run: a merge of it is
        skipped.  Those that are ``long``, whose merges aren't kept, always count."""
        if made:
            chunk, start, piece = (np.concatenate(x).astype(np.int64) for x in zip(*made))
        else:
            chunk = start = piece = np.zeros(0, np.int64)
        order = np.argsort(chunk, kind="stable")
        draw = start[order].astype(np.uint64) * _K1 + piece[order].astype(np.uint64) * _K2
        size = np.bincount(chunk, minlength=n_kinds)
        first = np.cumsum(size) - size
        out = long.copy()
        short = np.flatnonzero(~long)
        for i in range(0, len(short), DRAWS):
            some = short[i:i + DRAWS]
            n = size[code[some]]
            owner = np.repeat(some, n)
            skipped = mix64(keys[owner] + draw[ranges(first[code[some]], n)]) < np.uint64(limit)
            out[owner[skipped]] = True
        return out

    def encode(self, data: np.ndarray, offs: np.ndarray, docs: np.ndarray, seed: int = SEED,
               dropout: float = DROPOUT, copies: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text); ``docs`` and ``copies`` (0 by default) key each text's draws."""
        full = offs[1:] > offs[:-1]
        lead = offs[:-1][full]  # each text that isn't empty begins with a space
        spaced = np.insert(data, lead, 32)
        bounds = offs + np.concatenate([[0], np.cumsum(full)])
        if not len(spaced):
            return np.zeros(0, np.int32), np.zeros(len(offs) - 1, np.int64)
        cut = spaced == 32
        cut[1:] &= spaced[:-1] != 32
        cut[bounds[:-1][full]] = True
        starts = np.flatnonzero(cut)
        edges = pa.py_buffer(np.append(starts, len(spaced)).astype(np.int32))
        chunks = pa.Array.from_buffers(pa.binary(), len(starts), [None, edges, pa.py_buffer(np.ascontiguousarray(spaced))])
        coded = chunks.dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        ranges_of = np.searchsorted(starts, bounds)
        doc = np.repeat(np.arange(len(offs) - 1), np.diff(ranges_of))
        kinds = len(coded.dictionary)
        raw, at = utf8(coded.dictionary)
        if dropout <= 0:
            ids, counts = self.segment(raw, at, np.zeros(kinds, np.uint64), 0)
            number = code
        else:
            limit = min(int(dropout * 2.0 ** 64), (1 << 64) - 1)
            text = data.tobytes()
            crc = np.array([zlib.crc32(text[a:b]) for a, b in zip(offs[:-1], offs[1:])], np.uint64)
            salt = mix64(docs.astype(np.int64).astype(np.uint64) * _K1 + np.uint64(seed % (1 << 64)))
            salt = mix64(salt + crc * _K2)
            if copies is not None:
                salt = mix64(salt ^ copies.astype(np.int64).astype(np.uint64) * _K1)
            keys = mix64(salt[doc] + (np.arange(len(starts)) - ranges_of[doc]).astype(np.uint64) * _K2)
            begins = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            long = np.diff(begins[at]) > SHORT
            short = np.flatnonzero(~long)
            number = np.cumsum(~long)[code] - 1
            made: list = []
            ids, counts = self.segment(*utf8(coded.dictionary.take(pa.array(short))), np.zeros(len(short), np.uint64), 0, made)
            own = np.flatnonzero(self._varied(number, keys, len(short), made, long[code], limit))
            number[own] = len(short) + np.arange(len(own))
            more, n_more = self.segment(*utf8(chunks.take(pa.array(own))), keys[own], dropout)
            ids, counts = np.concatenate([ids, more]), np.concatenate([counts, n_more])
        first = (np.cumsum(counts) - counts)[number]
        size = counts[number]
        ends = np.cumsum(size)
        spread = np.arange(ends[-1]) + np.repeat(first - (ends - size), size)
        total = np.concatenate([[0], ends])[ranges_of]
        return ids[spread], np.diff(total)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts; the leading space of each is taken off."""
        size = self.raw_len[ids]
        ends = np.cumsum(size)
        n = int(ends[-1]) if len(ends) else 0
        data = self.raw[np.arange(n) + np.repeat(self.raw_at[ids] - (ends - size), size)]
        offs = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        lead = offs[:-1][offs[1:] > offs[:-1]]
        taken = np.concatenate([[0], np.cumsum(offs[1:] > offs[:-1])])
        return np.delete(data, lead), offs - taken


def _coder(path: str, seed: int, dropout: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel.cached(path)
        for batch in batches:
            release()
            carried = [c for c in batch.schema.names if c not in ("__text", "__doc", "__copy")]
            data, offs = utf8(batch.column("__text"))
            docs, copies = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("__doc", "__copy"))
            for i, j in slices(offs, SLICE):
                part, at = data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
                ids, counts = model.encode(part, at, docs[i:j], seed, dropout, copies[i:j])
                back, ends = model.decode(ids, counts)
                spot = np.concatenate([[0], np.cumsum(counts)])
                raw, came, ids4 = part.tobytes(), back.tobytes(), memoryview(ids.astype("<u4").tobytes())
                same = [raw[a:b] == came[c:d] for a, b, c, d in zip(at[:-1], at[1:], ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c).slice(i, j - i) for c in carried],
                    pa.ListArray.from_arrays(pa.array(spot, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array(counts, pa.int64()),
                    pa.array([zlib.crc32(ids4[4 * a:4 * b]) for a, b in zip(spot[:-1], spot[1:])], pa.int64()),
                    pa.array(same),
                ], names=[*carried, "ids", "n_pieces", "ids_crc32", "lossless"])

    return run


def encode(docs: DataFrame, model: str, seed: int = SEED, dropout: float = DROPOUT, copy: Column | None = None) -> DataFrame:
    """``docs`` without its text, plus ids, n_pieces, ids_crc32 and lossless (the decoder gave the text back).

    ``copy`` is the copy number of a row (0 by default).  Columns of ``docs`` with one of these names are replaced."""
    ship(docs.sparkSession)
    carried = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "ids", "n_pieces", "ids_crc32", "lossless")]
    rows = docs.select(*carried, F.col("text").alias("__text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("__doc"),
                       (F.lit(0) if copy is None else copy).cast("long").alias("__copy"))
    made = T.StructType.fromDDL("ids array<int>, n_pieces long, ids_crc32 long, lossless boolean")
    schema = T.StructType([*docs.select(*carried).schema.fields, *made.fields])
    return rows.mapInArrow(_coder(model, seed, dropout), schema)


def _decoder(path: str, column: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel.cached(path)
        for batch in batches:
            release()
            ids = batch.column(column)
            ids = ids if isinstance(ids, pa.Array) else ids.combine_chunks()
            counts = np.diff(ids.offsets.to_numpy()) * np.array(ids.is_valid())
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            spot = np.concatenate([[0], np.cumsum(counts)])
            for i, j in slices(spot, SLICE // 4):
                data, offs = model.decode(flat[spot[i]:spot[j]], counts[i:j])
                made = pa.Array.from_buffers(pa.utf8(), j - i, [None, pa.py_buffer(offs.astype(np.int32)),
                                                                pa.py_buffer(np.ascontiguousarray(data))])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(i, j - i) for c in batch.schema.names if c != text], made],
                    names=[*[c for c in batch.schema.names if c != text], text])

    return run


def decode(df: DataFrame, model: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with the text that its piece ids stand for; the inverse of ``encode``.

    Null or empty ids give an empty text.  A column named like ``text`` is replaced."""
    ship(df.sparkSession)
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c != text])
    schema = T.StructType([*kept.schema.fields, T.StructField(text, T.StringType())])
    return kept.mapInArrow(_decoder(model, ids, text), schema)


def report(docs: DataFrame, model: str, seed: int = SEED, dropout: float = DROPOUT) -> DataFrame:
    """``encode`` of ``docs``, written as a table and decoded from it: ``lossless`` says that the stored
    ids gave back the whole text (null: empty)."""
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    written = stored(encode(docs.withColumn("__digest", digest), model, seed, dropout), "pieces")
    back = decode(written, model, "ids", "__back")
    return back.withColumn("lossless", F.sha2(F.col("__back").cast("binary"), 256) == F.col("__digest")).drop("__digest", "__back")


def copy_numbers(stored: DataFrame) -> DataFrame:
    """(row, copy) of the rows of ``stored_rows`` that equal another: their places among their equals.

    Equal rows are counted per task of the numbering first, so none of many copies meet in one task
    beyond those that one task read."""
    keyed = stored.select("row", F.xxhash64("whole").alias("key"), F.shiftright("row", 33).alias("part"))
    counts = keyed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("key", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("key", "part").orderBy("row")) - 1
    placed = keyed.join(counts.where("n > 1 OR offset > 0"), ["key", "part"])
    return placed.select("row", (F.col("offset") + place).alias("copy")).where("copy > 0")


def encode_copies(docs: DataFrame, model: str, seed: int = SEED, dropout: float = DROPOUT) -> DataFrame:
    """``encode`` with equal rows numbered from 0: every copy draws for itself.  Equal rows are
    interchangeable, so the numbers are those that the mixing stage would have given."""
    numbered = stored_rows(docs)
    rows = numbered.join(copy_numbers(numbered), "row", "left")
    copy = "__copy_of_row"
    out = encode(rows.select("whole.*", F.coalesce("copy", F.lit(0)).alias(copy)), model, seed, dropout, F.col(copy))
    return out.drop(copy)
