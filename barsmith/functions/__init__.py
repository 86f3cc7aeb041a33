"""Column expressions (JVM-side built-ins only, no UDFs)."""

from barsmith.functions.columns import (
    as_date,
    as_double,
    pct_change,
    process_date_literal,
    symbol_from_key,
)

__all__ = ["as_date", "as_double", "pct_change", "process_date_literal", "symbol_from_key"]
