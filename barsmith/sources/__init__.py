"""Sources: landed JSON payloads, JDBC, catalog previews."""

from barsmith.sources.jdbc import jdbc_read_options, read_jdbc
from barsmith.sources.payloads import (
    explode_series,
    ingest_payloads,
    read_payloads,
    split_payloads,
)
from barsmith.sources.tables import preview, schema_rows, table_preview

__all__ = [
    "explode_series",
    "ingest_payloads",
    "jdbc_read_options",
    "preview",
    "read_jdbc",
    "read_payloads",
    "schema_rows",
    "split_payloads",
    "table_preview",
]
