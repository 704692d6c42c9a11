"""Exact rounding and guarded parsing of numbers.

Rates and averages round half away from zero at two decimals. They are computed with integer
division on exact sums, so the result does not depend on the order in which partitions merge.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import matches, trimmed


def half_up_div(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator rounded half away from zero to an integer; NULL on zero."""
    sign = F.when(numerator < 0, F.lit(-1)).otherwise(F.lit(1))
    doubled = F.abs(numerator) * 2 + denominator
    quotient = F.call_function("div", doubled, F.nullif(denominator * 2, F.lit(0)))
    return sign * quotient


def hundredths(c: Column) -> Column:
    """Exact count of hundredths in an integer or two-decimal value."""
    return (c.cast("decimal(28,2)") * 100).cast("decimal(30,0)")


def pct(part: Column, whole: Column) -> Column:
    """part * 100 / whole at two decimals; NULL when whole is zero."""
    return half_up_div(part * 10000, whole).cast("double") / 100


def avg_2dp(c: Column) -> Column:
    """Aggregate: average of integers or two-decimal values, rounded once."""
    return ratio_avg_2dp(F.sum(c), F.count(c))


def ratio_avg_2dp(total: Column, n: Column) -> Column:
    """Average from an already aggregated sum and count."""
    return half_up_div(hundredths(total), n).cast("double") / 100


def parse_integer(c: Column, kind: str = "int") -> Column:
    return trimmed(c).try_cast(kind)


def parse_positive_int(c: Column) -> Column:
    """Digits without a leading zero, else NULL."""
    return F.when(matches(F.btrim(c), "[1-9][0-9]*"), F.btrim(c).try_cast("int"))


def parse_score(c: Column, low: int = 1, high: int = 5) -> Column:
    """Single-digit score between low and high, else NULL."""
    digits = [str(d) for d in range(low, high + 1)]
    return F.when(F.btrim(c).isin(*digits), F.btrim(c).try_cast("smallint"))
