"""Waits and lengths of stay as mergeable quantile sketches, one per month and department or facility.

Exact percentiles have to see every distinct value of a group for each question. A sketch holds a few kilobytes
however many rows it has seen, and sketches add up: percentiles under any filter on months or places come from the
stored sketches alone. A percentile read from them has a rank within RANK_ERROR of the one asked for (Spark's KLL
sketches with K are within 0.4 per cent in 99 of 100 cases); groups of fewer than K rows are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hundredths, month_of
from ..schemas import Domain
from .views import Clean, appointment_view, ed_visit_view

K = 800
RANK_ERROR = 0.02
QUANTILES = {"median": 0.5, "percentile_90": 0.9}


def timed_values(clean: Clean, domain: Domain) -> DataFrame:
    """(measure, group_id, month_start, hundredths) of every wait and stay that is known."""
    waits = appointment_view(clean, domain, ()).select(
        F.lit("waiting_minutes").alias("measure"), F.col("department_id").alias("group_id"),
        F.col("scheduled_month").alias("month_start"), hundredths(F.col("waiting_minutes")).cast("long").alias("hundredths"),
    )
    stays = ed_visit_view(clean, domain, ()).select(
        F.lit("length_of_stay_hours").alias("measure"), F.col("facility_id").alias("group_id"),
        month_of(F.col("arrival_time")).alias("month_start"), hundredths(F.col("length_of_stay_hours")).cast("long").alias("hundredths"),
    )
    return waits.unionByName(stays).where(F.col("hundredths").isNotNull())


def sketch(values: DataFrame) -> DataFrame:
    """One row per measure, group and month: number of values and their sketch. Tasks send sketches, not values."""
    return values.groupBy("measure", "group_id", "month_start").agg(
        F.count("*").alias("n"), F.kll_sketch_agg_bigint("hundredths", K).alias("sketch")
    )


def percentiles(
    sketches: DataFrame, by: Sequence[str] = ("measure", "group_id"), where: Column | None = None,
    quantiles: Mapping[str, float] = QUANTILES,
) -> DataFrame:
    """Percentiles per group from the stored sketches of the months and groups that pass a filter."""
    chosen = sketches if where is None else sketches.where(where)
    merged = chosen.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", K).alias("sketch"))
    values = [(F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)) / 100).alias(name) for name, q in quantiles.items()]
    return merged.select(*by, "n", *values)


def rank_errors(
    values: DataFrame, found: DataFrame, by: Sequence[str] = ("measure", "group_id"), quantiles: Mapping[str, float] = QUANTILES
) -> DataFrame:
    """How far the rank of each percentile found lies from the one asked for, by the values themselves."""
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"v.{c}")) for c in by]
    met = values.alias("v").join(found.alias("f"), same)
    ranks = [
        (F.count_if(F.col("hundredths") < F.round(F.col(name) * 100).cast("long")) / F.count("*")).alias(f"{name}_below")
        for name in quantiles
    ] + [
        (F.count_if(F.col("hundredths") <= F.round(F.col(name) * 100).cast("long")) / F.count("*")).alias(f"{name}_upto")
        for name in quantiles
    ]
    counted = met.groupBy(*[F.col(f"f.{c}").alias(c) for c in by]).agg(F.count("*").alias("n"), *ranks)
    errors = [
        F.greatest(F.lit(0.0), F.col(f"{name}_below") - q, F.lit(q) - F.col(f"{name}_upto")).alias(f"{name}_error")
        for name, q in quantiles.items()
    ]
    return counted.select(*by, "n", *errors)
