"""DataFrame -> DataFrame operators; chain them with ``DataFrame.transform``."""

from barsmith.operators.analytics import (
    symbol_extremes,
    symbol_list,
    symbol_series,
    with_previous_close,
    with_variation,
)
from barsmith.operators.quality import drop_duplicates, duplicate_check, last_per_key
from barsmith.operators.transforms import (
    cluster_by,
    long_to_wide,
    normalize,
    tag,
    union_all,
    wide_to_long,
)

__all__ = [
    "cluster_by",
    "drop_duplicates",
    "duplicate_check",
    "last_per_key",
    "long_to_wide",
    "normalize",
    "symbol_extremes",
    "symbol_list",
    "symbol_series",
    "tag",
    "union_all",
    "wide_to_long",
    "with_previous_close",
    "with_variation",
]
