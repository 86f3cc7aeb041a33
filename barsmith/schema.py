"""Schemas and names shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the keys of the monthly-series JSON payload
# (an object under "Monthly Time Series", date -> five string fields).
SERIES_KEY = "Monthly Time Series"
PAYLOAD_FIELDS = ("1. open", "2. high", "3. low", "4. close", "5. volume")
MEASURES = ("open", "high", "low", "close", "volume")
# ---------------------------------------------------------------------------

FIELD_RENAMES = dict(zip(PAYLOAD_FIELDS, MEASURES))

ENTRY_TYPE = T.StructType([T.StructField(f, T.StringType()) for f in PAYLOAD_FIELDS])
PAYLOAD_TYPE = T.StructType(
    [T.StructField(SERIES_KEY, T.MapType(T.StringType(), ENTRY_TYPE))]
)

# flattened raw rows (all text, as received) plus payload position.
RAW_SCHEMA = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("date_from", T.StringType())]
    + [T.StructField(m, T.StringType()) for m in MEASURES]
    + [T.StructField("pos", T.IntegerType())]
)

# normalized bars.
BARS_SCHEMA = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("date_from", T.DateType())]
    + [T.StructField(m, T.DoubleType()) for m in MEASURES]
)
BAR_COLUMNS = tuple(f.name for f in BARS_SCHEMA.fields)

BARS_DDL = (
    "symbol STRING, date_from DATE, open DOUBLE, high DOUBLE, low DOUBLE, "
    "close DOUBLE, volume DOUBLE"
)

# analysed and loaded bars (process_date is the table's partition column).
VARIATION = "monthly_variation"
PROCESS_DATE = "process_date"
LOADED_DDL = (
    "symbol STRING, date_from DATE, open DOUBLE, high DOUBLE, low DOUBLE, "
    "close DOUBLE, volume DOUBLE, monthly_variation DOUBLE, process_date STRING"
)
