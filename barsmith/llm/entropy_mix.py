"""Mixing sources to target weights by entropy balancing (operator 10, native).

Sources in code-point order (null last) weigh 5, 2, 1, repeating, and share
all words by weight; a target stops at ``MAX_RATE`` times its source's size
and the excess is reshared by weight among the rest (water filling).

Document rates minimise the relative entropy to rate 1 under one constraint
per source -- the words taken equal its target -- with rates at most
``MAX_RATE``.  The dual has one multiplier per source and gives exponentially
tilted rates ``min(MAX_RATE, exp(lambda * size / mean))``.  Rates depend on
(source, size) only, so one aggregate reduces the documents to a histogram of
such cells; safeguarded Newton steps then run over it for all sources at once,
several per Spark job, until every constraint holds.

Rates become whole copies: cumulative rounding over the cells of a source
(large sizes first), four corrections by the largest size that still fits the
words left over, and inside a cell an even split over salted groups of
documents in hash order, so a hot source or size never meets in one task.  The
hash is of doc_id and text; where the doc_id is null, of the row, so any number
of rows without one spreads (rows of equal size take equal copies in sum either way).

Bounds: the water filling sorts all sources, and the Newton steps all sizes of
one source, in one task; both are distinct values of the histogram, never
documents (a source of 10^9 documents of up to 100,000 words has at most 10^5).

Null text has size 0; documents of size 0 keep one copy and take no words.
Repeated rows are separate documents.  ``apply`` repeats a row once per copy.
Only DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith.llm.runtime import WORD_REGEX, stored_rows, text_or_empty
from barsmith.session import shared_dir

# Fixed values of the mix.
WEIGHTS = (5, 2, 1)
MAX_RATE = 3

STEPS_PER_JOB = 8
MAX_JOBS = 12
TOLERANCE = 1e-9
CORRECTIONS = 4
SALTS = 256

_SOURCE = ("no_source", "src")  # null-safe key of a source


def sized(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Carried columns, source key, size in words, salt; cut from the texts by a checkpoint."""
    shared_dir(docs.sparkSession)
    # drawn by content, so reruns agree; null doc_ids, which any number of equal rows may share, by row
    which = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0))
    size = F.regexp_count(text_or_empty(), F.lit(WORD_REGEX)).cast("long")
    return docs.select(
        *carry, F.col("source").isNull().alias("no_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("src"),
        size.alias("size"), F.xxhash64("doc_id", text_or_empty(), which).alias("h"),
    ).withColumn("salt", F.pmod("h", F.lit(SALTS))).checkpoint()


def source_targets(cells: DataFrame) -> DataFrame:
    """One row per source: its size and its target, by water filling.

    Capped sources are those with the smallest cap/weight; the level at which
    the rest share is found by running sums over the sources in that order.
    """
    per = cells.groupBy(*_SOURCE).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    place = F.row_number().over(Window.orderBy(*_SOURCE)) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    cap = F.col("source_size") * float(MAX_RATE)
    per = per.select(*_SOURCE, "source_size", weight.alias("w"), cap.alias("cap"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), *_SOURCE)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(every)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    per = per.withColumn("level", level)
    # the first source whose cap holds the level fixes the level for all after it
    holds = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), *_SOURCE,
                                                                               F.col("level"))))
    per = per.withColumn("at", holds.over(every)["level"])
    return per.select(*_SOURCE, "source_size",
                      F.least(F.col("cap"), F.col("w") * F.coalesce("at", F.lit(float("inf")))).alias("target"))


def _whole_source():
    """All cells of a source, summed in the order of their sizes: reruns agree to the last bit."""
    return Window.partitionBy(*_SOURCE).orderBy("size").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _rate(lam: Column) -> Column:
    """Tilted rate; multipliers are bounded, so the exponent is clipped, not infinite."""
    return F.least(F.lit(float(MAX_RATE)), F.exp(F.least(lam * F.col("x"), F.lit(2.0))))


def document_rates(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """Cells with their rate: Newton steps on every source's multiplier at once."""
    own = _whole_source()
    words = F.col("size") * F.col("n")
    state = cells.join(targets, list(_SOURCE)).where("size > 0")
    mean = F.sum(F.col("size") * words).over(own) / F.col("source_size")
    state = state.withColumn("x", F.col("size") / mean)
    share = F.col("target") / F.col("source_size")
    least_x = F.min("x").over(own)
    # brackets: at one end every rate is at most (at least) the share asked for
    state = (state.withColumn("lo", F.when(share < 1, F.log(F.greatest(share, F.lit(1e-300))) / least_x).otherwise(0.0))
             .withColumn("hi", F.when(share < 1, 0.0).otherwise(F.log(F.lit(float(MAX_RATE))) / least_x))
             .withColumn("lam", F.lit(0.0)))
    state = state.withColumn("lam", F.when(share >= MAX_RATE * (1 - 1e-12), F.col("hi")).otherwise(F.lit(0.0)))
    for _ in range(MAX_JOBS):
        for _ in range(STEPS_PER_JOB):
            rate = _rate(F.col("lam"))
            slope = F.when(rate < MAX_RATE, words * F.col("x") * rate).otherwise(0.0)
            state = state.select("*", F.sum(words * rate).over(own).alias("f"), F.sum(slope).over(own).alias("df"))
            gap = F.col("f") - F.col("target")
            lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
            hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
            state = state.withColumns({"gap": gap, "lo2": lo, "hi2": hi})
            newton = F.col("lam") - F.col("gap") / F.col("df")
            inside = (F.col("df") > 0) & (newton > F.col("lo2")) & (newton < F.col("hi2"))
            done = F.abs("gap") <= TOLERANCE * F.col("target")
            step = F.when(done, F.col("lam")).when(inside, newton).otherwise((F.col("lo2") + F.col("hi2")) / 2)
            state = state.withColumn("lam", step).withColumn("lo", F.col("lo2")).withColumn("hi", F.col("hi2"))
            state = state.withColumn("open", (~done).cast("int")).drop("lo2", "hi2", "gap", "f", "df")
        state = state.checkpoint()
        if not state.agg(F.max("open")).first()[0]:
            break
    return state.withColumn("rate", _rate(F.col("lam")))


def cell_copies(rated: DataFrame) -> DataFrame:
    """Cells with ``copies``: whole copies whose words come near each target."""
    own, larger = _whole_source(), Window.partitionBy(*_SOURCE).orderBy(F.desc("size"))
    upto = larger.rowsBetween(Window.unboundedPreceding, 0)
    wanted = F.sum(F.col("n") * F.col("rate")).over(upto)
    out = rated.withColumn("upto", F.round(wanted)).withColumn(
        "copies", (F.col("upto") - F.coalesce(F.lag("upto").over(larger), F.lit(0.0))).cast("long"))
    for _ in range(CORRECTIONS):
        out = out.withColumn("left", F.col("target") - F.sum(F.col("size") * F.col("copies")).over(own))
        room = F.when(F.col("left") > 0, MAX_RATE * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
        out = out.withColumn("room", room)
        fits = F.max(F.when((F.col("size") <= F.abs("left")) & (F.col("room") > 0), F.col("size"))).over(own)
        change = F.when(F.col("size") == fits, F.signum("left") * F.least(
            F.col("room").cast("double"), F.floor(F.abs("left") / F.col("size")).cast("double"))).otherwise(0.0)
        out = out.withColumn("change", change).withColumn("copies", F.col("copies") + F.col("change").cast("long"))
    return out.select(*_SOURCE, "size", "n", "source_size", "target", "rate", "copies")


def mix(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per document: carried columns, size, source_size, target, rate, copies, taken."""
    table = sized(docs, carry)
    groups = table.groupBy(*_SOURCE, "size", "salt").agg(F.count(F.lit(1)).alias("m")).checkpoint()
    cells = groups.groupBy(*_SOURCE, "size").agg(F.sum("m").alias("n"))
    targets = source_targets(cells).checkpoint()
    copies = cell_copies(document_rates(cells, targets))
    # a cell's copies over its salted groups, evenly
    upto = Window.partitionBy(*_SOURCE, "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, 0)
    split = groups.where("size > 0").join(
        copies.select(*_SOURCE, "size", "n", "rate", F.col("copies").alias("k")), [*_SOURCE, "size"])
    seen = F.sum("m").over(upto)
    part = F.expr("k * seen div n") - F.expr("k * (seen - m) div n")
    split = split.withColumn("seen", seen).select(*_SOURCE, "size", "salt", "m", "rate", part.alias("part"))
    place = F.row_number().over(Window.partitionBy(*_SOURCE, "size", "salt").orderBy("h", "doc_id"))
    mine = table.join(split, [*_SOURCE, "size", "salt"], "left").withColumn("place", place)
    took = F.expr("part div m") + F.when(F.col("place") <= F.col("part") % F.col("m"), 1).otherwise(0)
    mine = mine.withColumn("copies", F.coalesce(took, F.lit(1)).cast("long"))
    return mine.join(targets, list(_SOURCE)).select(
        *carry, "size", "source_size", "target", F.coalesce("rate", F.lit(1.0)).alias("rate"), "copies",
        (F.col("size") * F.col("copies")).alias("taken"))


def report(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "source", "text"))


def apply(docs: DataFrame) -> DataFrame:
    """``docs`` with every row repeated once per copy, rows without a copy gone.

    Rows are numbered once, in a stored table.
    """
    stored = stored_rows(docs)
    slim = stored.select("row", "whole.doc_id", "whole.source", "whole.text")
    copies = mix(slim, carry=("doc_id", "row")).where("copies > 0").select("row", "copies")
    return (stored.join(copies, "row")
            .select("whole", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("whole.*"))
