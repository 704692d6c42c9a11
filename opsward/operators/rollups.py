"""Aggregate first, then attach dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sums_by_dimension(
    fact: DataFrame,
    key: str,
    dim: DataFrame,
    by: Sequence[str],
    sums: Mapping[str, Column],
    maxima: Mapping[str, Column] | None = None,
    fact_by: Sequence[str] = (),
) -> DataFrame:
    """Additive measures of a fact under dimension attributes.

    The fact is aggregated per key before the join: every task sends one row per key, so a key
    that holds a large part of the fact costs no more than any other, and the join sees at most
    one row per key (and ``fact_by`` value). Fact rows whose key is unknown form the NULL group.
    """
    maxima = maxima or {}
    per_key = fact.groupBy(key, *fact_by).agg(
        *[c.alias(name) for name, c in sums.items()], *[c.alias(name) for name, c in maxima.items()]
    )
    return (
        per_key.join(dim.select(key, *by), key, "left")
        .groupBy(*by, *fact_by)
        .agg(*[F.sum(name).alias(name) for name in sums], *[F.max(name).alias(name) for name in maxima])
    )
