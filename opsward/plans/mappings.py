"""Approved category mappings."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import norm_key
from ..schemas import Domain
from ..sources.layers import upsert

# Normalised raw text -> standard value. Regions come from the domain.
CATEGORY_RULES: dict[str, dict[str, str]] = {
    "gender": {
        "female": "Female",
        "male": "Male",
        "m": "Male",
        "gender diverse": "Gender Diverse",
        "gender-diverse": "Gender Diverse",
        "unknown": "Unknown",
    },
    "referral_status": {
        "completed": "Completed",
        "cancelled": "Cancelled",
        "declined": "Declined",
        "decline": "Declined",
        "booked": "Booked",
        "waiting": "Waiting",
        "open": "Open",
    },
    "appointment_status": {
        "completed": "Completed",
        "no show": "No Show",
        "no-show": "No Show",
        "cancelled": "Cancelled",
        "rescheduled": "Rescheduled",
        "re-scheduled": "Rescheduled",
        "scheduled": "Scheduled",
    },
}


def mapping_rules(domain: Domain) -> dict[str, dict[str, str]]:
    return {"hospital_region": {r.lower(): r for r in domain.regions}, **CATEGORY_RULES}


def as_table(spark: SparkSession, rules: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Mapping table held in the plan itself, so its exact size is known and joins can broadcast it."""
    rows = [(group, raw, standard) for group, values in rules.items() for raw, standard in values.items()]
    names = ["mapping_group", "raw_value_normalised", "standard_value"]
    columns = [pa.array(list(values), pa.string()) for values in zip(*rows)]
    return spark.createDataFrame(pa.table(columns, names=names))


def build_mappings(spark: SparkSession, domain: Domain, existing: DataFrame | None = None) -> DataFrame:
    """Mapping table of the domain; an existing table is updated in place of duplicated."""
    approved = as_table(spark, mapping_rules(domain))
    if existing is None:
        return approved
    return upsert(existing, approved, schemas.PRIMARY_KEYS["reference_mappings"])


# The raw column that each mapping group translates.
MAPPED_COLUMNS = {
    "hospital_region": "facilities", "gender": "patients", "referral_status": "referrals", "appointment_status": "appointments",
}


def mapping_usage(mappings: DataFrame, raw: Mapping[str, DataFrame]) -> DataFrame:
    """Every mapping rule with the raw rows it translates, and raw values that no rule knows, with a NULL standard value."""
    parts = [
        raw[table].groupBy(F.lit(group).alias("mapping_group"), norm_key(F.col(group)).alias("raw_value_normalised"))
        .agg(F.count("*").alias("raw_rows")).where(F.col("raw_value_normalised").isNotNull())
        for group, table in MAPPED_COLUMNS.items()
    ]
    used = reduce(DataFrame.unionByName, parts)
    return mappings.join(used, ["mapping_group", "raw_value_normalised"], "full").fillna(0, ["raw_rows"])
