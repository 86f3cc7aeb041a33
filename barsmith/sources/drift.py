"""Schema drift over landings (SRC-5, SET-2): what fields do landed documents hold, and of what type?

The explicit payload schema reads what it names and silently leaves out the
rest: a field that a sender adds, drops or retypes shows up as nothing or as
NULL.  ``landed_fields`` looks at the documents themselves.  Each is parsed once
into a variant, its fields and those of its entries are listed with their
types, and one aggregation (with map-side combine: a few rows leave each task)
merges them per landing.  ``drift_report`` holds that against the expected
fields.  No schema is inferred by the driver and no document is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.schema import PAYLOAD_FIELDS, SERIES_KEY

DOCUMENT, ENTRY = "document", "entry"

#: (level, field) -> type of the payload schema.
EXPECTED = {(DOCUMENT, "symbol"): "STRING", (DOCUMENT, SERIES_KEY): "OBJECT",
            **{(ENTRY, f): "STRING" for f in PAYLOAD_FIELDS}}

# Statuses of a field in a landing.
AS_EXPECTED, NEW, RETYPED, MISSING, MALFORMED = "expected", "new", "retyped", "missing", "malformed"


def _type_of(v: Column) -> Column:
    """A variant's kind: STRING, NUMBER, BOOLEAN, NULL, OBJECT or ARRAY."""
    name = F.regexp_extract(F.schema_of_variant(v), "^[A-Z_]+", 0)
    return (F.when(name.isin("TINYINT", "SMALLINT", "INT", "BIGINT", "DECIMAL", "FLOAT", "DOUBLE"), F.lit("NUMBER"))
            .when(name == "VOID", F.lit("NULL")).otherwise(name))


def _members(v: Column) -> Column:
    """A variant's fields as a map of variants; NULL when it is no object."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def read_documents_as_variants(spark: SparkSession, landings: dict[str, str]) -> DataFrame:
    """``landing, doc`` of JSON Lines under each named landing; ``doc`` is NULL for malformed text."""
    def read(name: str, path: str) -> DataFrame:
        lines = spark.read.option("recursiveFileLookup", True).text(path).where(F.trim("value") != "")
        return lines.select(F.lit(name).alias("landing"), F.try_parse_json("value").alias("doc"))

    if not landings:
        raise ValueError("no landing given")
    return reduce(DataFrame.unionByName, [read(n, p) for n, p in landings.items()])


def landed_fields(documents: DataFrame) -> DataFrame:
    """``landing, level, field, type, occurrences``; level ``document`` or ``entry`` (of the series).

    A row with a NULL field counts the objects of that level; one with a NULL
    field and type ``malformed`` the documents that are no JSON object."""
    parsed = documents.select("landing", _members(F.col("doc")).alias("doc"))
    entries = parsed.select("landing", F.explode(F.map_values(_members(F.col("doc").getItem(SERIES_KEY)))).alias("e")).select(
        "landing", _members(F.col("e")).alias("e"))

    def fields(objects: DataFrame, c: str, level: str) -> DataFrame:
        seen = F.concat(
            F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("type"))),
            F.transform(F.map_entries(c), lambda m: F.struct(m["key"].alias("field"), _type_of(m["value"]).alias("type"))))
        broken = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(MALFORMED).alias("type")))
        return objects.select("landing", F.lit(level).alias("level"),
                              F.explode(F.when(F.col(c).isNull(), broken).otherwise(seen)).alias("f"))

    every = fields(parsed, "doc", DOCUMENT).unionByName(fields(entries, "e", ENTRY))
    return every.groupBy("landing", "level", F.col("f.field").alias("field"), F.col("f.type").alias("type")).agg(
        F.count(F.lit(1)).alias("occurrences"))


def drift_report(fields: DataFrame, expected: dict[tuple[str, str], str] | None = None) -> DataFrame:
    """``landing, level, field, status, type, occurrences`` of ``landed_fields``.

    ``expected``, ``new`` and ``retyped`` count objects that hold the field with
    that type; ``missing`` counts those without an expected field; ``malformed``
    counts documents or entries that are no object (field NULL)."""
    spark = fields.sparkSession
    wanted = spark.createDataFrame(
        [(level, field, t) for (level, field), t in (EXPECTED if expected is None else expected).items()],
        "level string, field string, wanted string")
    named = fields.where(F.col("field").isNotNull())
    status = (F.when(F.col("wanted").isNull(), F.lit(NEW)).when(F.col("wanted") != F.col("type"), F.lit(RETYPED))
              .otherwise(F.lit(AS_EXPECTED)))
    found = named.join(wanted, ["level", "field"], "left").select("landing", "level", "field", status.alias("status"), "type", "occurrences")
    broken = fields.where("field IS NULL AND type IS NOT NULL").select(
        "landing", "level", "field", F.lit(MALFORMED).alias("status"), F.lit(None).cast("string").alias("type"), "occurrences")
    objects = fields.where("field IS NULL AND type IS NULL").select("landing", "level", F.col("occurrences").alias("objects"))
    held = named.groupBy("landing", "level", "field").agg(F.sum("occurrences").alias("held"))
    absent = objects.join(wanted, "level").join(held, ["landing", "level", "field"], "left").select(
        "landing", "level", "field", F.lit(MISSING).alias("status"), F.lit(None).cast("string").alias("type"),
        (F.col("objects") - F.coalesce("held", F.lit(0))).alias("occurrences")).where("occurrences > 0")
    return found.unionByName(broken).unionByName(absent)


__all__ = ["EXPECTED", "drift_report", "landed_fields", "read_documents_as_variants"]
