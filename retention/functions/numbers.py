"""Safe numeric conversions with warehouse semantics (bad text -> NULL)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from retention.functions.strings import ws_trim, _c

# Decimal or scientific number, or inf/infinity/nan, with optional sign.
# Spark's own string->double cast also accepts Java suffixes such as '5d'
# and '1f'; the guard rejects those.
_FLOAT_TEXT = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))$"
_INT_TEXT = r"^[+-]?\d+$"
_HEX_TEXT = r"^[+-]?0[xX][0-9a-fA-F]+$"


def safe_double(c, dtype: str | None = "string") -> Column:
    """SAFE_CAST(x AS FLOAT64). Numbers pass through; text must look like a number."""
    col = _c(c)
    if dtype not in (None, "string"):
        return col.cast("double")
    t = ws_trim(col)
    return F.when(t.rlike(_FLOAT_TEXT), t.try_cast("double"))


def safe_bigint(c, dtype: str | None = "string") -> Column:
    """SAFE_CAST(x AS INT64): decimal or hex integer text, else NULL.
    Fractional text ('12.5') is NULL, as in the warehouse."""
    col = _c(c)
    if dtype in ("bigint", "long", "int", "integer", "smallint", "tinyint"):
        return col.cast("bigint")
    if dtype not in (None, "string"):
        return col.try_cast("bigint")
    t = ws_trim(col)
    neg = t.startswith("-")
    hexdigits = F.regexp_replace(t, r"^[+-]?0[xX]", "")
    hexval = F.conv(hexdigits, 16, 10).try_cast("bigint")
    return (F.when(t.rlike(_INT_TEXT), t.try_cast("bigint"))
             .when(t.rlike(_HEX_TEXT) & (F.length(hexdigits) <= 16),
                   F.when(neg, -hexval).otherwise(hexval)))


def safe_divide(a, b) -> Column:
    """SAFE_DIVIDE(a, NULLIF(b, 0)): NULL on zero or NULL divisor."""
    return F.try_divide(_c(a), F.nullif(_c(b), F.lit(0)))


def idiv(name: str, n: int) -> Column:
    """Integer division truncating toward zero (SQL ``a div n``) of a named column."""
    return F.expr(f"`{name}` div {int(n)}")
