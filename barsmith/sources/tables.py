"""Catalog reads: ordered preview and schema-as-rows (SRC-9, LIM-1..2, JOB-6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in a stated order (``TakeOrderedAndProject``).

    An order is required: an unordered LIMIT is not reproducible.
    """
    if not order_by:
        raise ValueError("preview needs order_by; an unordered LIMIT is not reproducible")
    return df.orderBy(*order_by).limit(n)


def schema_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The schema of ``df`` as rows ``(position, col_name, data_type, nullable)``."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position INT, col_name STRING, data_type STRING, nullable BOOLEAN")


def profile(df: DataFrame) -> DataFrame:
    """``df`` inspected column by column: ``position, col_name, data_type, non_null, nulls, least, greatest``.

    One pass: an aggregate with partial combine gives all columns' counts and
    extremes (as text), then its single row is turned into rows."""
    fields = df.schema.fields
    q = [f"`{f.name.replace('`', '``')}`" for f in fields]
    plain = [not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType, T.VariantType)) for f in fields]
    text = lambda c: c.cast("string")
    none = F.lit(None).cast("string")
    summary = df.agg(F.count(F.lit(1)).alias("rows"), *[F.struct(
        F.count(c).alias("non_null"), (text(F.min(c)) if ok else none).alias("least"),
        (text(F.max(c)) if ok else none).alias("greatest")).alias(f"c{i}") for i, (c, ok) in enumerate(zip(map(F.col, q), plain))])
    rows = F.array(*[F.struct(
        F.lit(i).alias("position"), F.lit(f.name).alias("col_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
        F.col(f"c{i}.non_null"), (F.col("rows") - F.col(f"c{i}.non_null")).alias("nulls"),
        F.col(f"c{i}.least"), F.col(f"c{i}.greatest")) for i, f in enumerate(fields)])
    return summary.select(F.inline(rows))


def table_preview(spark: SparkSession, table: str, n: int = 10,
                  order_by: Sequence[str] | None = None) -> DataFrame:
    return preview(spark.table(table), n, order_by)


__all__ = ["preview", "profile", "schema_rows", "table_preview"]
