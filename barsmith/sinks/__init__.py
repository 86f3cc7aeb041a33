"""Sinks: catalog tables and JDBC."""

from barsmith.sinks.jdbc import jdbc_write_options, write_jdbc
from barsmith.sinks.tables import (
    append_table,
    clear_process_date,
    cluster_for_table,
    create_bars_table,
    reload_process_date,
    table_buckets,
    write_bucketed,
)

__all__ = [
    "append_table",
    "clear_process_date",
    "cluster_for_table",
    "create_bars_table",
    "jdbc_write_options",
    "reload_process_date",
    "table_buckets",
    "write_bucketed",
    "write_jdbc",
]
