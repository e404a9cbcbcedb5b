"""Column-level helpers: tokens, JSON fields, exact ratios and fixed-digit text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(text) -> Column:
    """Lower-cased word tokens (letters, digits, underscore; 2+ characters), in order."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(C.TOKEN_PATTERN), 0)


def distinct_tokens(text) -> Column:
    return F.array_distinct(tokens(text))


def json_field(col, field: str) -> Column:
    """Text of `$.field`, NULL for malformed JSON or a missing field."""
    return F.get_json_object(_c(col), f"$.{field}")


def exact_ratio(num, den) -> Column:
    """num / den as DOUBLE from exact integers: one correctly rounded division.

    NULL when den is 0 (no exception under ANSI mode)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def scaled_sum(col, decimals: int = C.CONFIDENCE_DECIMALS) -> Column:
    """Exact integer sum of a column that carries `decimals` decimal places."""
    return F.sum(F.round(_c(col) * F.lit(10.0**decimals)).cast("long"))


def fixed_text(num, den, digits: int) -> Column:
    """num/den written with `digits` decimals, rounded half up, by integer arithmetic.

    Same text in every engine, unlike float formatting of a binary double."""
    scale = 10**digits
    d2 = _c(den).cast("long") * 2
    n = _c(num).cast("long") * F.lit(2 * scale) + _c(den).cast("long")
    q = _idiv(n, d2)
    whole = _idiv(q, F.lit(scale))
    frac = q - whole * scale
    if digits == 0:
        return whole.cast("string")
    return F.concat(whole.cast("string"), F.lit("."), F.lpad(frac.cast("string"), digits, "0"))


def _idiv(n: Column, d: Column) -> Column:
    """Exact floor division of non-negative longs (the quotient of exact multiples)."""
    return ((n - F.pmod(n, d)) / d).cast("long")


def money_text(col) -> Column:
    """Price as text with two decimals (no exponent notation)."""
    return _c(col).cast("decimal(18,2)").cast("string")
