"""Scalar column functions.

Strictness does not depend on the session's ANSI flag: a strict conversion
raises through ``raise_error`` whenever a non-NULL input fails to convert,
a lenient one yields NULL (``try_cast`` / ``try_to_date``).
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"
# What counts as a number: sign, digits, exponent; infinities and NaN.  A bare
# cast would also read type suffixes (12d) and hexadecimal floats.
NUMBER = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
_ISO_DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strict(raw: Column, converted: Column, what: str) -> Column:
    return F.when(raw.isNull() | converted.isNotNull(), converted).otherwise(
        F.raise_error(F.concat(F.lit(f"malformed {what}: '"), raw, F.lit("'")))
    )


def as_double(c: Column | str, strict: bool = True) -> Column:
    """string -> double (SCL-1)."""
    raw = _col(c)
    converted = F.when(raw.rlike(NUMBER), raw.try_cast("double"))
    return _strict(raw, converted, "number") if strict else converted


def as_date(c: Column | str, strict: bool = True, fmt: str = DATE_FORMAT) -> Column:
    """string -> date (SCL-2)."""
    raw = _col(c)
    converted = F.try_to_date(raw, fmt)
    return _strict(raw, converted, "date") if strict else converted


def pct_change(current: Column | str, previous: Column | str) -> Column:
    """(current - previous) / previous * 100, NULL when previous is 0 or NULL.

    Keeps this exact operation order so doubles match a SQL oracle bit for
    bit (SCL-3).
    """
    cur, prev = _col(current), _col(previous)
    return F.try_divide(cur - prev, prev) * F.lit(100)


def symbol_from_key(key: Column | str, prefix: str = "S", width: int = 6) -> Column:
    """Integer key -> symbol text, zero-padded, never truncated."""
    return F.format_string(f"{prefix}%0{width}d", _col(key))


def process_date_literal(value: str | _dt.date | None) -> str | None:
    """Validate a process date given as text or date; None stays None."""
    if value is None:
        return None
    if isinstance(value, _dt.date):
        return value.isoformat()
    text = str(value).strip()
    if not _ISO_DATE.match(text):
        raise ValueError(f"process_date must be yyyy-MM-dd, got {value!r}")
    _dt.date.fromisoformat(text)
    return text
