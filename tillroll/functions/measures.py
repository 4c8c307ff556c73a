"""Measures of the sales fact and deterministic numeric helpers.

Money is kept in decimals end to end: ``unit * product_price`` is exact and its sum is
published as ``decimal(38,2)``, wide enough for totals far beyond a single machine.
Ratios and means are IEEE doubles computed as ``exact_sum / exact_count`` (one division),
so every engine produces the same bits regardless of summation order. Rounding of
doubles is half-up via ``floor(x * 10^d + 0.5) / 10^d``, which is plain IEEE arithmetic and
therefore identical in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def revenue(unit="unit", price="product_price") -> Column:
    return _col(unit) * _col(price)


def profit(unit="unit", price="product_price", cost="product_cost") -> Column:
    return _col(unit) * (_col(price) - _col(cost))


def unit_margin(price="product_price", cost="product_cost") -> Column:
    return _col(price) - _col(cost)


def money(c) -> Column:
    return _col(c).cast(MONEY)


def money_sum(c) -> Column:
    return F.sum(_col(c)).cast(MONEY)


def ratio(num, den) -> Column:
    """``num / den`` as double; NULL when ``den`` is zero (MySQL semantics, no ANSI error)."""
    return _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))


def exact_mean(sum_col, count_col) -> Column:
    """Mean from an exact sum and count (order-independent, unlike a double running sum)."""
    return ratio(sum_col, count_col)


def round_half_up(c, digits: int = 2) -> Column:
    """Half-up rounding of a double that is bit-identical across engines."""
    scale = 10 ** digits
    if digits == 0:
        return F.floor(_col(c) + F.lit(0.5))
    return F.floor(_col(c) * F.lit(float(scale)) + F.lit(0.5)) / F.lit(float(scale))


def percent(num, den, digits: int | None = 2) -> Column:
    value = ratio(num, den) * F.lit(100.0)
    return value if digits is None else round_half_up(value, digits)


# ---- grain-agnostic counts -------------------------------------------------------
# A frame at daily grain carries ``lines`` (sales lines per row); at line grain every
# row is one line. These helpers give the same numbers on either grain.
LINES = "lines"


def line_count(df) -> Column:
    """Number of sales lines (``count(*)`` at line grain)."""
    return F.sum(LINES).cast("bigint") if LINES in df.columns else F.count(F.lit(1))


def per_line_sum(df, expr) -> Column:
    """Sum of a per-line expression, e.g. ``price - cost`` for a per-line mean."""
    return F.sum(_col(expr) * F.col(LINES)) if LINES in df.columns else F.sum(_col(expr))
