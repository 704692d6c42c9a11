"""Sentinels, value maps and boolean flags."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import norm_key


def is_sentinel(c: Column, sentinels: Collection[str]) -> Column:
    """True for NULL, blank (when '' is in the set) and placeholder text; never NULL."""
    return F.lower(F.btrim(F.coalesce(c, F.lit("")))).isin(*sorted(sentinels))


def null_sentinels(c: Column, sentinels: Collection[str]) -> Column:
    return F.when(~is_sentinel(c, sentinels), c)


def map_values(c: Column, mapping: Mapping[str, object]) -> Column:
    """Fixed value list: normalised text to standard value, NULL for anything else.

    A lookup in a constant map computes the key once per row; a chain of comparisons would
    normalise the text again for every branch.
    """
    entries = [F.lit(v) for pair in mapping.items() for v in pair]
    return F.try_element_at(F.create_map(*entries), norm_key(c))


def flag(predicate: Column) -> Column:
    """Two-valued flag: an unknown predicate counts as false."""
    return F.coalesce(predicate, F.lit(False))


def null_if_before(later: Column, base: Column, keep_without_base: bool = False) -> Column:
    """Drop a later event that precedes its base event.

    Without a base event the later one is dropped too, unless ``keep_without_base``.
    """
    keep = later >= base
    if keep_without_base:
        keep = base.isNull() | keep
    return F.when(keep, later)
