"""Scalar column expressions (FE1, FE3-FE5, MTH1-MTH3, STR1-STR2, BIN6).

All are built-in Spark expressions: they stay inside whole-stage codegen and are ANSI-safe
(every parse is a ``try_*`` and every ratio with a possible zero divisor is guarded).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Days per month used for credit-history length (fixed value).
DAYS_PER_MONTH = 30.4375


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- parsing -------------------------------------------------------------------------------

def parse_month_year(c: ColumnOrName) -> Column:
    """FE1: ``Mon-YYYY`` text -> first day of that month; unparsable text -> NULL."""
    return F.try_to_date(_c(c), "MMM-yyyy")


def months_between_truncated(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """FE3: whole months as days / 30.4375, truncated toward zero."""
    return (F.datediff(_c(later), _c(earlier)) / F.lit(DAYS_PER_MONTH)).cast("int")


def first_int(c: ColumnOrName, null_as: str | None = None, default: int | None = None) -> Column:
    """First run of digits as an integer (FE4). ``null_as`` replaces NULL text first;
    ``default`` replaces text without digits."""
    src = _c(c) if null_as is None else F.coalesce(_c(c), F.lit(null_as))
    val = F.regexp_extract(src, r"([0-9]+)", 1).try_cast("int")
    return val if default is None else F.coalesce(val, F.lit(default))


def emp_length_years(c: ColumnOrName) -> Column:
    """FE4: NULL -> '< 1 year' -> 1; '10+ years' -> 10; text without digits -> 0."""
    return first_int(c, null_as="< 1 year", default=0)


def first_number(c: ColumnOrName) -> Column:
    """FE5: first run of digits as a double; no digits -> NULL."""
    return F.regexp_extract(_c(c), r"([0-9]+)", 1).try_cast("double")


# ---- math ----------------------------------------------------------------------------------

def truncate_decimals(c: ColumnOrName, decimals: int = 3) -> Column:
    """MTH1: truncate toward zero at ``decimals`` places, working on the shortest decimal form
    of the double (so 8.2 stays 8.2)."""
    dec = _c(c).cast("string").try_cast("decimal(38,18)")
    scale = 10 ** decimals
    return (F.signum(dec) * F.floor(F.abs(dec) * F.lit(scale)) / F.lit(scale)).cast("double")


def round_half_even(c: ColumnOrName, decimals: int = 0) -> Column:
    """MTH2: half-even rounding of the binary value, as NumPy/pandas ``round``: scale by
    10^d, round half-even to an integer, scale back. (``bround(x, d)`` with d > 0 rounds the
    shortest decimal text instead, which differs for values such as 2.675.)"""
    if decimals == 0:
        return F.bround(_c(c), 0)
    scale = float(10 ** decimals)
    return F.bround(_c(c) * F.lit(scale), 0) / F.lit(scale)


def clip(c: ColumnOrName, lo: float, hi: float) -> Column:
    """MTH3: clip into [lo, hi]."""
    return F.greatest(F.least(_c(c), F.lit(hi)), F.lit(lo))


# ---- text ----------------------------------------------------------------------------------

def decimal_text(c: ColumnOrName, decimals: int, suffix: str = "") -> Column:
    """A double with so many decimals, rounded by its exact binary value (half-even), as C and Python
    format it. The product with 10^d is split into its rounded value and its exact residual, which
    decides what looks like a tie."""
    y = _c(c).cast("double")
    scale = F.lit(float(10 ** decimals))
    big = y * F.lit(134217729.0)  # 2^27 + 1: splits a double into two halves with exact products
    high = big - (big - y)
    p = y * scale
    residual = (high * scale - p) + (y - high) * scale
    below = F.floor(p).cast("double")
    over = (p - below - 0.5) + residual
    tie = F.when(F.pmod(below, F.lit(2.0)) == 0, below).otherwise(below + 1)
    n = F.when(over > 0, below + 1).when(over < 0, below).otherwise(tie)
    n = F.when((n == 0) & (y < 0), F.lit(-0.0)).otherwise(n)
    # beyond 2^53 / 10^d every double is a multiple of the last decimal
    exact = F.when(F.abs(p) < F.lit(2.0 ** 52), n / scale).otherwise(y)
    return F.when(y.isNotNull(), F.format_string(f"%.{decimals}f{suffix}", exact))


def percent_text(c: ColumnOrName, decimals: int = 2) -> Column:
    """STR1: 0.1234 -> '12.34%'."""
    return decimal_text(_c(c) * 100.0, decimals, "%%")


def interval_text(lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """STR1: '(lo, hi]'."""
    return F.concat(F.lit("("), _c(lo).cast("string"), F.lit(", "), _c(hi).cast("string"), F.lit("]"))


def compact_money(c: ColumnOrName) -> Column:
    """STR2: >= 1e9 -> 'x.xxbn', >= 1e6 -> 'x.xxM', else 'x.xK'."""
    v = _c(c)
    return (
        F.when(F.abs(v) >= 1e9, decimal_text(v / 1e9, 2, "bn"))
        .when(F.abs(v) >= 1e6, decimal_text(v / 1e6, 2, "M"))
        .otherwise(decimal_text(v / 1e3, 1, "K"))
    )


def compact_defaults(c: ColumnOrName) -> Column:
    """STR2 (defaults): >= 1000 -> 'x.xxK', else whole number."""
    v = _c(c)
    return F.when(v >= 1000, decimal_text(v / 1000, 2, "K")).otherwise(decimal_text(v, 0))


def compact_count(c: ColumnOrName) -> Column:
    """STR2 (counts): >= 1000 -> 'xK', else the integer."""
    v = _c(c)
    return F.when(v >= 1000, decimal_text(v / 1000, 0, "K")).otherwise(v.cast("string"))


# ---- bins ----------------------------------------------------------------------------------

def right_closed_bin(x: ColumnOrName, cuts: Sequence[float]) -> Column:
    """BIN6: index of the right-closed interval (-inf, c1], (c1, c2], ..., (ck, +inf] that holds
    x, as a balanced tree of comparisons (O(log k), fully code-generated). NULL stays NULL."""
    xs = _c(x)
    cuts = sorted(float(v) for v in cuts)

    def tree(lo: int, hi: int) -> Column:  # answer lies in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2  # is x <= cuts[mid] ?
        return F.when(xs <= F.lit(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return F.when(xs.isNull() | F.isnan(xs.cast("double")), F.lit(None).cast("int")).otherwise(
        tree(0, len(cuts)).cast("int")
    )


def at_or_above_index(x: ColumnOrName, points: Sequence[float]) -> Column:
    """Index j of the largest sorted point with point <= x, or -1 below the first point
    (balanced comparisons). Rows with index >= j are exactly those with x >= points[j]."""
    xs = _c(x)
    pts = sorted(float(v) for v in points)

    def tree(lo: int, hi: int) -> Column:  # answer in [lo, hi], lo may be -1
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2  # is x >= pts[mid] ?
        return F.when(xs >= F.lit(pts[mid]), tree(mid, hi)).otherwise(tree(lo, mid - 1))

    return F.when(xs.isNull() | F.isnan(xs.cast("double")), F.lit(-1)).otherwise(tree(-1, len(pts) - 1))


def linspace(lo: float, hi: float, n: int) -> list[float]:
    """n+1 equally spaced edges, as NumPy ``linspace(lo, hi, n + 1)``."""
    step = (hi - lo) / n
    return [lo + i * step if i < n else hi for i in range(n + 1)]


# ---- searches in literal arrays ---------------------------------------------------------------

def double_array(values: list[float]) -> Column:
    """A literal array, folded from one text when the query is planned (an element each would be slow to build)."""
    if not values:
        return F.array().cast("array<double>")
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def search(xs: Column, size: int, x: Column, below: bool = False) -> Column:
    """How many elements of a rising array (of at most ``size``) are at most x (``below``: less than x)."""
    steps = [1 << k for k in range(max(0, size.bit_length() - 1), -1, -1)] if size else []
    if not steps:
        return F.lit(0)

    def step(at: Column, by: Column) -> Column:
        value = F.get(xs, at + by - 1)  # NULL beyond the end
        return F.when(value < x if below else value <= x, at + by).otherwise(at)

    return F.aggregate(F.array(*[F.lit(b) for b in steps]), F.lit(0), step)
