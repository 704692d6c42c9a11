"""Shares, rankings and percentiles over aggregated rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import half_up_div, hundredths, pct


def share_of_total(counts: DataFrame, n: str, output: str) -> DataFrame:
    """Percentage of the grand total beside each group.

    The total is a scalar subquery over the groups, so no window gathers them in one task.
    """
    return counts.withColumn(output, pct(F.col(n), counts.agg(F.sum(n)).scalar()))


def top_n(df: DataFrame, metric: str, keys: Sequence[str], n: int = 10) -> DataFrame:
    """The n largest rows by metric, ties broken by the keys; each task keeps n rows at most."""
    return df.orderBy(F.col(metric).desc_nulls_first(), *[F.col(k).asc_nulls_last() for k in keys]).limit(n)


def top_n_share(counts: DataFrame, metric: str, keys: Sequence[str], n: int = 10) -> DataFrame:
    """One row: how much of the total the n largest named groups hold.

    A group without a name counts in the total but is no candidate.
    """
    return (
        top_n(counts.dropna(subset=list(keys)), metric, keys, n)
        .agg(F.count("*").alias("groups_counted"), F.sum(metric).alias("top_total"))
        .withColumn("grand_total", counts.agg(F.sum(metric)).scalar())
        .withColumn("top_share_percentage", pct(F.col("top_total"), F.col("grand_total")))
    )


def cumulative_share(counts: DataFrame, n: str, key: str, output: str) -> DataFrame:
    """Running percentage from the largest group down; meant for the few groups of a fixed value list."""
    running = Window.orderBy(F.col(n).desc_nulls_first(), F.col(key).asc_nulls_last())
    running = running.rowsBetween(Window.unboundedPreceding, 0)
    return (
        counts.withColumn("__running", F.sum(n).over(running))
        .withColumn(output, pct(F.col("__running"), counts.agg(F.sum(n)).scalar()))
        .drop("__running")
    )


def exact_percentiles(
    df: DataFrame, value: str, by: Sequence[str], percentiles: Mapping[str, Fraction]
) -> DataFrame:
    """Continuous percentiles (linear interpolation) of a two-decimal value per group.

    Rows are first counted per distinct value, so the window sees one row per distinct value of a
    group, never the rows themselves. The fraction of each percentile must have a small
    denominator; all arithmetic is exact and rounded once.
    """
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, hundredths(F.col(value)).cast("long").alias("__v"))
        .agg(F.count("*").alias("__c"))
    )
    order = Window.partitionBy(*by).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    ranked = counted.withColumn("__cum", F.sum("__c").over(order)).withColumn("__n", F.sum("__c").over(whole))
    measures = [F.max("__n").alias("n")]
    for name, p in percentiles.items():
        at = (F.col("__n") - 1) * p.numerator
        below = F.call_function("div", at, F.lit(p.denominator))
        weight = at % p.denominator
        low = F.min(F.when(F.col("__cum") > below, F.col("__v")))
        high = F.min(F.when(F.col("__cum") > F.call_function("div", at + p.denominator - 1, F.lit(p.denominator)), F.col("__v")))
        exact = low * p.denominator + (high - low) * F.max(weight)
        measures.append((half_up_div(exact, F.lit(p.denominator)).cast("double") / 100).alias(name))
    return ranked.groupBy(*by).agg(*measures)
