"""MinHash near-duplicates with sequential Bayesian verification (operator 12).

Documents are sets of two-word shingles of lower-cased words (a single word is
one shingle); two are linked when their Jaccard similarity is ``THRESHOLD`` or more.

1. **Bands.**  ``BANDS * ROWS`` MinHash values a document; documents with equal
   values in a band are candidates.  A pair at the threshold shares no band
   with chance (1 - t**ROWS)**BANDS, 3e-6.  Equal shingle sets are one class
   and only its first row goes on.
2. **Stars.**  Only components are asked for, so a band of m members is not
   compared pair by pair.  One member of its largest component is its centre,
   chosen by a hash that all bands share; the members outside that component
   are compared with it.  Then the components are joined anew, the centre is
   done, and bands that still hold several components take another.  As soon
   as the pairs left -- the members outside with all others of their band --
   are at most ``WORK`` for each member, or a turn leaves more than ``STALL`` of
   the members outside, all of them are compared at once, in blocks; pairs of
   one component never are.
3. **Sequential verification.**  A candidate pair's signatures are compared
   batch by batch.  After m of n values agree, the similarity's posterior
   (uniform prior) is Beta(m + 1, n - m + 1); a pair leaves as soon as the
   posterior chance of similarity at the threshold or above is under ``MISS``.
4. **Exact check.**  Survivors are confirmed on the full shingle sets of both
   whole texts.  In the first turn only a document's best candidate is
   checked; the others follow unless they have come together by then.  Blocks
   check each component's best pair first and drop the pairs whose ends have
   come together; what leaves them is a forest, fewer links than members.

The first turn's links, one from each document to a lower one, are followed to
their roots; later ones are joined by star contraction (``components``).  Each is named by
its smallest doc_id.  Null and wordless texts have an empty set, no links and a
component of their own.  Rows are numbered once, in a stored table; repeated
rows and repeated or null doc_ids are documents of their own (a component of
null doc_ids has a null name).  Extra columns are not read.  Hot joins (a set, a
band or a centre that very many rows share) have one row on their other side,
so AQE can split them.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.anchors import ranges
from barsmith.llm.components import connected, local_labels, spanning
from barsmith.llm.runtime import (
    group_bounds, mix64, release, ship, shuffle_partitions, slices, stored, stored_rows, utf8, whole_groups,
)
from barsmith.llm.wordhash import SLICE_BYTES, window_hashes, words

SHINGLE = 2
THRESHOLD = 0.8
BANDS = 32
ROWS = 5
BATCH = 32      # signature values compared at a time
MISS = 1e-6     # chance of losing a pair at the threshold, per batch
WORK = 512      # pairs for each member of the bands that may be compared at once
STALL = 2 / 3   # share of members outside their band's largest component that a useful turn leaves, at most
SMALL = 16      # members of a cell up to which the pairs of all cells are compared together
CONFIRM_BYTES = 4 << 20  # text of pairs confirmed at a time
BLOCK = 2048    # members of a band compared in one piece, so many rows of pairs at a time:
STEP = 128
_VALUES = BANDS * ROWS
_SIGNED = "row long, doc_id long, n_shingles long, key_a long, key_b long, signature binary"
_MULTIPLIERS = mix64(np.arange(1, _VALUES + 1, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7)) | np.uint64(1)


# ------------------------------------------------------------------ sets and signatures


def shingle_sets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of all documents, sorted in each, range of each document)."""
    w = words(data, offs, lower=True)
    doc = w.doc_of()
    size = np.diff(w.docs)
    inside = np.flatnonzero(doc[:-1] == doc[1:])
    single = w.docs[:-1][size == 1]
    h = np.concatenate([window_hashes(w.hashes, SHINGLE)[inside], mix64(w.hashes[single] + np.uint64(1))])
    d = np.concatenate([doc[inside], doc[single]])
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[new], d[new]
    return h, np.searchsorted(d, np.arange(len(offs)))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        release()
        data, offs = utf8(batch.column("text"))
        for i, j in slices(offs, SLICE_BYTES):
            h, at = shingle_sets(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            n = np.diff(at)
            some = np.flatnonzero(n)
            sig = np.zeros((j - i, _VALUES), np.uint32)
            keys = np.zeros((2, j - i), np.uint64)
            if len(some):
                for k, m in enumerate(_MULTIPLIERS):
                    sig[some, k] = np.minimum.reduceat(((h * m) >> np.uint64(32)).astype(np.uint32), at[some])
                keys[0, some] = np.add.reduceat(mix64(h), at[some])
                keys[1, some] = np.add.reduceat(mix64(h ^ np.uint64(0x5851F42D4C957F2D)), at[some])
            band = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.zeros((j - i, 1), np.uint64)
            bits = np.ascontiguousarray(sig.astype(np.uint16)).tobytes()
            width = 2 * _VALUES
            yield pa.RecordBatch.from_arrays([
                batch.column("row").slice(i, j - i), batch.column("doc_id").slice(i, j - i), pa.array(n.astype(np.int64)),
                pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)),
                pa.array([bits[x * width:(x + 1) * width] for x in range(j - i)], pa.binary()),
            ], names=[c.split()[0] for c in _SIGNED.split(", ")])


def _signatures(column) -> np.ndarray:
    return np.frombuffer(utf8(column)[0].tobytes(), np.uint16).reshape(-1, _VALUES)


def _band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures -> the key of every band: equal where the band's kept values are."""
    for batch in batches:
        values = _signatures(batch.column("signature")).reshape(-1, BANDS, ROWS).astype(np.uint64)
        n = len(values)
        key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.zeros((n, 1), np.uint64)
        for k in range(ROWS):
            key = mix64(key * np.uint64(0xD6E8FEB86659FD93) + values[:, :, k])
        keys = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(key.reshape(-1).view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("row"), keys], names=["row", "bands"])
    release()


def bands_of(signatures: DataFrame) -> DataFrame:
    """``row, slot, band`` of rows with their signature: one row for each band."""
    keyed = signatures.select("row", "signature").mapInArrow(_band, "row long, bands array<long>")
    return keyed.select("row", F.posexplode("bands").alias("slot", "band"))


# ------------------------------------------------------------------ sequential verification


def least_matches(threshold: float = THRESHOLD, miss: float = MISS) -> list[int]:
    """For each batch, the fewest agreeing values at which a pair goes on.

    P(Beta(m + 1, n - m + 1) >= t) equals P(Binomial(n + 1, t) <= m)."""
    out = []
    for n in range(BATCH, _VALUES + 1, BATCH):
        m, tail = 0, 0.0
        while True:
            tail += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append(m)
    return out


def _agree(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pairs of signature rows a[i], b[i] that pass every batch, how many values agree)."""
    on = np.arange(len(a))
    same = np.zeros(len(a), np.int64)
    for k, least in enumerate(least_matches()):
        part = slice(k * BATCH, (k + 1) * BATCH)
        same[on] += (a[on, part] == b[on, part]).sum(1)
        on = on[same[on] >= least]
    return on, same[on]


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        on, same = _agree(_signatures(batch.column("sig_u")), _signatures(batch.column("sig_v")))
        at = pa.array(on)
        yield pa.RecordBatch.from_arrays([batch.column("u").take(at), batch.column("v").take(at), pa.array(same)],
                                         names=["u", "v", "matches"])
    release()


def pruned(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """``pairs`` (u, v) that the posterior leaves, with ``matches``."""
    both = (pairs.join(signatures.select(F.col("row").alias("u"), F.col("signature").alias("sig_u")), "u")
            .join(signatures.select(F.col("row").alias("v"), F.col("signature").alias("sig_v")), "v"))
    return both.select("u", "v", "sig_u", "sig_v").mapInArrow(_prune, "u long, v long, matches long")


def common_shingles(h: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Size of the intersection of the sets h[at[x]:at[x + 1]] of each pair a[i], b[i]."""
    distinct, rank = np.unique(h, return_inverse=True)
    held = np.zeros(len(distinct), bool)
    out = np.zeros(len(a), np.int64)
    order = np.argsort(b, kind="stable")
    edges = np.flatnonzero(np.diff(b[order], prepend=-1))
    for pairs in np.split(order, edges[1:]) if len(order) else ():  # one set marked, all its partners looked up
        mine = rank[at[b[pairs[0]]]:at[b[pairs[0]] + 1]]
        held[mine] = True
        size = at[a[pairs] + 1] - at[a[pairs]]
        upto = np.concatenate([[0], np.cumsum(held[rank[ranges(at[a[pairs]], size)]])])
        ends = np.cumsum(size)
        out[pairs] = upto[ends] - upto[ends - size]
        held[mine] = False
    return out


def linked(h: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of sets have the threshold's similarity or more."""
    common, n = common_shingles(h, at, a, b), np.diff(at)
    return 100 * common >= round(100 * THRESHOLD) * (n[a] + n[b] - common)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = np.concatenate([[0], np.cumsum(sum(np.diff(utf8(batch.column(c))[1]) for c in ("text_u", "text_v")))])
        for i, j in slices(size, CONFIRM_BYTES):
            part = batch.slice(i, j - i)
            u, v = (part.column(c).to_numpy() for c in ("u", "v"))
            rows, first, place = np.unique(np.concatenate([v, u]), return_index=True, return_inverse=True)
            texts = pa.concat_arrays([part.column("text_v"), part.column("text_u")]).take(pa.array(first))  # each once
            data, offs = utf8(texts)
            h, at = shingle_sets(data, offs)
            b, a = place[:len(v)], place[len(v):]
            ok = np.flatnonzero(linked(h, at, a, b))
            yield pa.RecordBatch.from_arrays([pa.array(u[ok]), pa.array(v[ok])], names=["u", "v"])
        release()


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (u, v) whose full sets are linked."""
    both = (pairs.select("u", "v").join(texts.select(F.col("row").alias("u"), F.col("text").alias("text_u")), "u")
            .join(texts.select(F.col("row").alias("v"), F.col("text").alias("text_v")), "v"))
    return both.select("u", "v", "text_u", "text_v").mapInArrow(_confirm, "u long, v long")


# ------------------------------------------------------------------ candidates


def _named(rows: DataFrame, labels: DataFrame | None, on: str = "row", out: str = "label") -> DataFrame:
    """``rows`` with the component of column ``on`` (itself, if it has no links yet)."""
    if labels is None:
        return rows.withColumn(out, F.col(on))
    told = labels.select(F.col("node").alias(on), F.col("label").alias(out))
    return rows.join(told, on, "left").withColumn(out, F.coalesce(out, on))


def _apart(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The pairs whose ends lie in different components."""
    if labels is None:
        return pairs
    return _named(_named(pairs, labels, "u", "at_u"), labels, "v", "at_v").where("at_u <> at_v").drop("at_u", "at_v")


def _crowds(told: DataFrame, turn: int) -> DataFrame:
    """Bands (of rows band, row, label) with several components: members in ``all``, the largest
    component (``crowd``: n, label) and its centre, by a hash that all bands share."""
    centre = F.min(F.struct(F.xxhash64("row", F.lit(turn)).alias("h"), "row")).alias("c")
    sizes = told.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"), centre)
    return sizes.groupBy("band").agg(F.max(F.struct("n", "label", "c")).alias("crowd"), F.sum("n").alias("all")).where(
        F.col("all") > F.col("crowd.n"))


def _star(members: DataFrame, labels: DataFrame | None, turn: int) -> DataFrame:
    """Members (band, slot, row) of bands with several components, without the band's centre, which is in its
    largest component; ``rest``: the member is not."""
    told = _named(members, labels)
    return told.join(_crowds(told, turn), "band").select(
        "band", "slot", "row", F.col("crowd.c.row").alias("centre"), (F.col("label") != F.col("crowd.label")).alias("rest"),
        F.col("all").alias("others")).where("row <> centre")


def _cells(members: DataFrame, labels: DataFrame) -> DataFrame:
    """What still has to be compared, dealt to cells of at most two blocks.

    A band's largest component is its crowd, the other members are its rest; the rest meets
    the crowd (kind 0) and itself (kind 1)."""
    told = _named(members, labels)
    bands = _crowds(told, 0)
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    dealt = told.join(bands, "band").select(
        "band", "slot", "row", "label", (F.col("label") != F.col("crowd.label")).alias("rest"),
        blocks(F.col("crowd.n")).alias("crowds"), blocks(F.col("all") - F.col("crowd.n")).alias("rests"))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("row"), F.when(F.col("rest"), F.col("rests")).otherwise(F.col("crowds"))).cast("int"))
    cell = lambda kind, x, y: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"))
    mine = F.col("mine")
    to_rest = F.transform(F.sequence(F.lit(0), F.col("rests") - 1), lambda k: cell(0, k, mine))
    to_crowd = F.transform(F.sequence(F.lit(0), F.col("crowds") - 1), lambda k: cell(0, mine, k))
    to_self = F.transform(F.sequence(F.lit(0), F.col("rests") - 1), lambda k: cell(1, F.least(mine, k), F.greatest(mine, k)))
    return dealt.withColumn("cell", F.explode(F.when(F.col("rest"), F.concat(to_crowd, to_self)).otherwise(to_rest))).select(
        "band", "cell.kind", "cell.x", "cell.y", "slot", "row", "label", "rest", "mine")


_CELL = ("band", "kind", "x", "y")


def _cell_pairs(at: np.ndarray, ok) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (p < q) inside the groups at[g] .. at[g + 1] - 1 that ``ok`` accepts."""
    size = np.diff(at)
    small = np.flatnonzero((size > 1) & (size <= SMALL))
    for gap in range(1, SMALL):  # the pairs of all small groups, by distance
        some = small[size[small] > gap]
        p = ranges(at[some], size[some] - gap)
        yield from _accepted(p, p + gap, ok)
    for i, j in zip(at[:-1][size > SMALL].tolist(), at[1:][size > SMALL].tolist()):
        for a in range(i, j, STEP):
            p, q = np.meshgrid(np.arange(a, min(a + STEP, j)), np.arange(a, j), indexing="ij")
            above = p < q
            yield from _accepted(p[above], q[above], ok)


def _accepted(p: np.ndarray, q: np.ndarray, ok, most: int = 1 << 16):
    keep = ok(p, q)
    p, q = p[keep], q[keep]
    for k in range(0, len(p), most):
        yield p[k:k + most], q[k:k + most]


def _survivors(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of different components in a table of whole cells that the posterior leaves, and how many
    values agree.  A pair counts in the first band that it shares, where it meets as well."""
    label, mine, kind, x, y, slot = (table.column(c).to_numpy() for c in ("label", "mine", "kind", "x", "y", "slot"))
    rest = np.array(table.column("rest"), bool)
    sig = _signatures(table.column("signature"))

    def ok(p, q):
        own = np.where(kind[p] == 0, rest[p] != rest[q], (x[p] == y[p]) | (mine[p] != mine[q]))
        return own & (label[p] != label[q])

    out = [(np.zeros(0, np.int64),) * 3]
    for p, q in _cell_pairs(group_bounds(table, _CELL), ok):
        on, same = _agree(sig[p], sig[q])
        p, q = p[on], q[on]
        shared = (sig[p] == sig[q]).reshape(-1, BANDS, ROWS).all(2)
        first = shared.argmax(1) == slot[p]
        out.append((p[first], q[first], same[first]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted cells -> their rows that are in a pair the posterior leaves."""
    for table in whole_groups(batches, _CELL):
        p, q, _ = _survivors(table)
        yield from table.take(pa.array(np.unique(np.concatenate([p, q])))).combine_chunks().to_batches()
        release()


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted cells with texts -> links that join their components, a forest: fewer than there are components.

    Each component first checks its most similar pair with a lower one, then four times as many, and so
    on while there are any; a pair whose ends have come together is not checked."""
    for table in whole_groups(batches, _CELL, most=2_000):
        p, q, same = _survivors(table)
        row = table.column("row").to_numpy()
        names, part = np.unique(table.column("label").to_numpy(), return_inverse=True)
        h, at = shingle_sets(*utf8(table.column("text")))
        now, width = np.arange(len(names)), 1
        order = np.argsort(-same, kind="stable")
        p, q = p[order], q[order]
        while True:
            a, b = now[part[p]], now[part[q]]
            apart = a != b
            p, q, a, b = p[apart], q[apart], a[apart], b[apart]
            if not len(p):
                break
            upper = np.maximum(a, b)
            order = np.argsort(upper, kind="stable")
            head = np.concatenate([[True], np.diff(upper[order]) > 0])
            place = np.arange(len(order)) - np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
            try_ = np.zeros(len(p), bool)
            try_[order[place < width]] = True
            at_ = np.flatnonzero(try_)
            hit = at_[linked(h, at, p[at_], q[at_])]
            hit = hit[spanning(len(names), a[hit], b[hit])]
            now = local_labels(len(names), a[hit], b[hit])[now]
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(row[p[hit]], row[q[hit]])),
                                              pa.array(np.minimum(row[p[hit]], row[q[hit]]))], names=["u", "v"])
            p, q, width = p[~try_], q[~try_], width * 4
        release()


def settled(cells: DataFrame, signatures: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (u, v) that join the components of ``_cells``, all their pairs considered."""
    n = shuffle_partitions(cells.sparkSession)
    signed = cells.join(signatures, "row").select(*_CELL, "slot", "row", "label", "rest", "mine", "signature")
    near = signed.repartition(n, *_CELL).sortWithinPartitions(*_CELL).mapInArrow(_flag, signed.schema)
    read = near.join(texts.select("row", F.coalesce("text", F.lit("")).alias("text")), "row")
    return read.repartition(n, *_CELL).sortWithinPartitions(*_CELL).mapInArrow(_settle, "u long, v long")


def _roots(edges: DataFrame) -> DataFrame:
    """``node, label`` of a forest of edges u -> v, v < u, one for each u: pointers doubled until all are at roots."""
    now = stored(edges.select("u", "v"), "pointers")
    while True:
        further = now.select(F.col("u").alias("v"), F.col("v").alias("w"))
        if not now.join(further, "v", "left_semi").take(1):
            break
        now = stored(now.join(further, "v", "left").select("u", F.coalesce("w", "v").alias("v")), "pointers")
    pairs = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return pairs.union(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _components(signatures: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, label`` of every linked row of ``reps`` (row); ``signatures``: row, signature."""
    spread = bands_of(signatures.join(reps, "row", "left_semi"))
    crowded = spread.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(spread.join(crowded.select("band"), "band").select("band", "slot", "row"), "bands")
    size = members.count()
    # the first turn: every member against its band's centre, the best candidate of each document first
    star = stored(_star(members, None, 0), "star")
    near = stored(pruned(_to_centres(star), signatures), "pairs")
    best = near.groupBy("u").agg(F.max_by("v", F.struct("matches", -F.col("v"))).alias("v"))
    first = stored(confirmed(best, texts), "links")
    labels = stored(_roots(first), "labels")
    backlog, before, turn = near.join(best, ["u", "v"], "left_anti").select("u", "v"), star.count(), 0
    while True:
        turn += 1
        star = stored(_star(star.select("band", "slot", "row"), labels, turn), "star")
        left, work = star.where("rest").agg(F.count(F.lit(1)), F.coalesce(F.sum("others"), F.lit(0))).first()
        finish = work <= WORK * size or left > STALL * before
        if not finish:
            near = pruned(_to_centres(star), signatures).select("u", "v")
            backlog = near if backlog is None else near.union(backlog).distinct()
        found = None if backlog is None else confirmed(_apart(backlog, labels), texts)
        if left and finish:  # every pair that is left, at once
            every = star.select("band", "slot", "row").union(star.select("band", "slot", F.col("centre").alias("row"))).distinct()
            rest = settled(_cells(every, labels), signatures, texts)
            found = rest if found is None else found.union(rest)
        if found is not None:
            both = stored(found, "links").union(labels.select(F.col("node").alias("u"), F.col("label").alias("v")))
            labels = stored(connected(both), "labels")
        if finish:
            return labels
        backlog, before = None, left


def _to_centres(star: DataFrame) -> DataFrame:
    """Candidate pairs u > v: the members outside a band's largest component with its centre."""
    return star.where("rest").select(F.greatest("row", "centre").alias("u"), F.least("row", "centre").alias("v")).distinct()


# ------------------------------------------------------------------ results


def groups(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): row, doc_id, n_shingles, component_id and keeper, the
    component's row that stays."""
    return _groups(stored_rows(docs, "doc_id", "text"))


def _groups(rows: DataFrame) -> DataFrame:
    """``groups`` of the rows of ``stored_rows``."""
    ship(rows.sparkSession)
    texts = rows.select("row", F.col("whole.doc_id").cast("long").alias("doc_id"), F.col("whole.text").alias("text"))
    signed = stored(texts.mapInArrow(_sign, _SIGNED), "signed")
    same = ["key_a", "key_b", "n_shingles"]
    first = stored(signed.where("n_shingles > 0").groupBy(*same).agg(F.min("row").alias("row")), "classes")
    labels = _components(signed.select("row", "signature"), first.select("row"), texts)
    classes = _named(first, labels, out="group").withColumnRenamed("row", "rep")
    placed = signed.select("row", "doc_id", *same).join(classes, same, "left").select(
        "row", "doc_id", "n_shingles", F.coalesce("group", "row").alias("group"))
    stays = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("stays")
    return placed.join(placed.groupBy("group").agg(stays), "group").select(
        "row", "doc_id", "n_shingles", F.col("stays.doc_id").alias("component_id"), F.col("stays.row").alias("keeper"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return groups(docs.select("doc_id", "text")).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, all columns."""
    rows = stored_rows(docs)
    return rows.join(_groups(rows).where("row = keeper").select("row"), "row").select("whole.*")
