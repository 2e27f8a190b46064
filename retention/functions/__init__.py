"""Column-level helpers. All return pyspark Columns built from built-in
functions, so they stay inside whole-stage codegen (no Python UDFs)."""

from retention.functions.strings import ws_trim, blank_to_null, title_label, snake_case
from retention.functions.numbers import (safe_bigint, safe_double, safe_divide, idiv)
from retention.functions.stats import guarded_corr, null_count, count_when

__all__ = [
    "ws_trim", "blank_to_null", "title_label", "snake_case",
    "safe_bigint", "safe_double", "safe_divide", "idiv",
    "guarded_corr", "null_count", "count_when",
]
