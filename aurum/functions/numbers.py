"""Numeric coercion, rounding and the order-independent mean."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal number or (case-insensitive) inf / infinity, optional sign and
# surrounding blanks.  Everything else (e.g. "37.6d", which a bare try_cast
# accepts, or a quoted "NaN" token) becomes null.
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))\s*$"


def coerce_double(s: Column) -> Column:
    """STRING -> DOUBLE, bad -> null (numeric strings accepted)."""
    return F.when(s.rlike(_NUMBER), F.trim(s).try_cast("double"))


def to_int_rounded(x: Column) -> Column:
    """DOUBLE -> INT as an integer column stores it (round half up); NaN,
    infinities and overflow give null."""
    return F.when(~F.isnan(x), F.round(x, 0).try_cast("int"))


def round_half_even(x: Column, digits: int = 2) -> Column:
    """Binary-scaled half-even rounding: rint(x * 10^d) / 10^d."""
    scale = float(10 ** digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def exact_mean(x: Column, scale: int = 4) -> Column:
    """Mean through an exact decimal sum: independent of the order in which
    partial sums are combined, so every partitioning gives the same double."""
    dec = f"decimal({16 + scale},{scale})"
    return F.sum(x.cast(dec)).cast("double") / F.count(x)


def exact_mean_sql(x: str, scale: int = 4) -> str:
    """The same mean as SQL text (DuckDB / Spark SQL)."""
    return f"CAST(SUM(CAST({x} AS DECIMAL({16 + scale},{scale}))) AS DOUBLE) / COUNT({x})"


def display(x: Column, digits: int = 1) -> Column:
    """Display text with a fixed number of decimals (P16), rounded half-even
    first so the text does not depend on the formatter's tie rule."""
    return F.format_string(f"%.{int(digits)}f", round_half_even(x, digits))
