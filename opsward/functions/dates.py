"""Dates and times. Timestamps carry no zone."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import trimmed

MICROS_PER = {"minute": 60_000_000, "hour": 3_600_000_000}


def _looks_iso(text: Column) -> Column:
    """Year, month and day are all there: Spark alone would also read '2026' and '2026-01'."""
    return (F.length(text) >= 8) & (F.substring(text, 5, 1) == "-")


def parse_date(c: Column, formats: Sequence[str] = ()) -> Column:
    """ISO date text, then any extra formats in order; anything else is NULL."""
    text = trimmed(c)
    parsed = [F.when(_looks_iso(text), text.try_cast("date"))]
    parsed += [F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats]
    return F.coalesce(*parsed)


def parse_timestamp(c: Column, formats: Sequence[str] = ()) -> Column:
    text = trimmed(c)
    parsed = [F.when(_looks_iso(text), text.try_cast("timestamp_ntz"))]
    parsed += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*parsed)


def parse_date_in_range(c: Column, low: dt.date, high: dt.date, formats: Sequence[str] = ()) -> Column:
    parsed = parse_date(c, formats)
    return F.when(parsed.between(F.lit(low), F.lit(high)), parsed)


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def elapsed_2dp(unit: str, start: Column, end: Column) -> Column:
    """Elapsed time in ``unit`` as decimal(18,2), rounded half away from zero."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    per_hundredth = MICROS_PER[unit] // 100
    sign = F.when(micros < 0, F.lit(-1)).otherwise(F.lit(1))
    units = F.call_function("div", F.abs(micros) * 2 + per_hundredth, F.lit(2 * per_hundredth))
    return (((sign * units).cast("decimal(18,0)")) / 100).cast("decimal(18,2)")


def month_of(c: Column) -> Column:
    """First day of the month as a date."""
    return F.trunc(c.cast("date"), "month")


def month_name(c: Column, padded: bool = True) -> Column:
    """English month name, blank-padded to nine characters unless told otherwise."""
    name = F.date_format(c, "MMMM")
    return F.rpad(name, 9, " ") if padded else name
