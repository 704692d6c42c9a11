"""Read-only profiles of the raw layer; every table is scanned once per profile."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import (
    bracketed,
    is_sentinel,
    matches,
    norm_id,
    norm_key,
    parse_date,
    parse_timestamp,
    trimmed,
)
from ..operators.joins import orphan_counts, orphan_keys
from ..operators.stacking import unpivot_text
from ..schemas import Domain

Raw = Mapping[str, DataFrame]

# Columns whose value frequencies are worth reading.
CATEGORY_COLUMNS = {
    "facilities": ["hospital_region", "facility_type", "city"],
    "departments": ["department_name", "specialty_group"],
    "patients": ["gender", "city", "ethnicity"],
    "referrals": ["urgency", "referral_status", "referral_source"],
    "appointments": ["appointment_status"],
    "ed_visits": ["disposition", "admitted_flag"],
}
SCORE_COLUMNS = {
    "patients": ("deprivation_quintile", schemas.ID_SENTINELS),
    "referrals": ("priority_score", schemas.SCORE_SENTINELS),
    "ed_visits": ("triage_category", schemas.SCORE_SENTINELS),
}
POSITIVE_COLUMNS = {
    "facilities": ["bed_capacity"],
    "departments": ["routine_target_days", "urgent_target_days", "appointment_wait_target_mins"],
}
REQUIRED_KEYS = {
    "departments": ["facility_id"],
    "referrals": ["patient_id", "department_id"],
    "appointments": ["patient_id", "department_id"],
    "ed_visits": ["patient_id", "facility_id"],
}


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _raw_name(table: str) -> str:
    return f"{table}_raw"


def _identifiers(raw: Raw, sentinels: Collection[str]) -> DataFrame:
    """(table_name, normalised_id) of all tables; sentinel ids are NULL."""
    parts = []
    for table in raw:
        key = F.col(schemas.PRIMARY_KEYS[table][0])
        cleaned = F.when(~is_sentinel(key, sentinels), F.upper(F.btrim(key)))
        parts.append(raw[table].select(F.lit(_raw_name(table)).alias("table_name"), cleaned.alias("normalised_id")))
    return _union(parts)


def profile_identifiers(raw: Raw, sentinels: Collection[str] = schemas.ID_SENTINELS) -> DataFrame:
    ids, unique = F.count("normalised_id"), F.count_distinct("normalised_id")
    return (
        _identifiers(raw, sentinels)
        .groupBy("table_name")
        .agg(
            F.count("*").alias("total_rows"),
            (F.count("*") - ids).alias("missing_or_sentinel_ids"),
            ids.alias("non_missing_ids"),
            unique.alias("unique_ids"),
            (ids - unique).alias("duplicate_excess_rows"),
        )
    )


def duplicate_ids(raw: Raw, sentinels: Collection[str] = schemas.ID_SENTINELS) -> DataFrame:
    found = _identifiers(raw, sentinels).where(F.col("normalised_id").isNotNull())
    counts = found.groupBy("table_name", F.col("normalised_id").alias("duplicated_id")).agg(
        F.count("*").alias("occurrence_count")
    )
    return counts.where(F.col("occurrence_count") > 1).withColumn(
        "duplicate_excess_rows", F.col("occurrence_count") - 1
    )


def bad_id_formats(raw: Raw, domain: Domain) -> DataFrame:
    """Non-blank ids that break the expected pattern of their table."""
    parts = []
    for table in raw:
        key, pattern = schemas.PRIMARY_KEYS[table][0], domain.id_patterns[table]
        wrong = trimmed(F.col(key)).isNotNull() & ~matches(F.upper(F.btrim(F.col(key))), pattern)
        parts.append(
            raw[table].where(wrong).select(
                F.lit(_raw_name(table)).alias("table_name"), F.col(key).alias("raw_id"),
                F.lit(pattern).alias("expected_format"),
            )
        )
    return _union(parts)


def category_frequencies(raw: Raw, columns: Mapping[str, Sequence[str]] = CATEGORY_COLUMNS) -> DataFrame:
    """Frequency of every original value beside its normalised form."""
    cells = _union([unpivot_text(raw[t], _raw_name(t), cols) for t, cols in columns.items()])
    counts = cells.groupBy("table_name", "column_name", "raw_value").agg(F.count("*").alias("record_count"))
    value = F.col("raw_value")
    return counts.select(
        "table_name", "column_name",
        F.coalesce(value, F.lit("[NULL]")).alias("original_value"),
        F.when(trimmed(value).isNull(), "[BLANK OR NULL]")
        .when(is_sentinel(value, schemas.CATEGORY_SENTINELS), "[SENTINEL VALUE]")
        .otherwise(norm_key(value)).alias("normalised_value"),
        "record_count",
    )


def _issue_counts(cells: DataFrame, issue: Column) -> DataFrame:
    return (
        cells.withColumn("issue_type", issue)
        .where(F.col("issue_type").isNotNull())
        .groupBy("table_name", "column_name", "issue_type")
        .agg(F.count("*").alias("affected_rows"))
    )


def score_ranges(raw: Raw, low: int = 1, high: int = 5) -> DataFrame:
    value = F.col("raw_value")
    parts = []
    for table, (column, sentinels) in SCORE_COLUMNS.items():
        issue = (
            F.when(is_sentinel(value, sentinels), "Missing or sentinel value")
            .when(~matches(F.btrim(value), "[0-9]+"), "non-numeric value")
            .when(~F.btrim(value).cast("decimal(38,0)").between(low, high), f"outside range {low}-{high}")
        )
        parts.append(_issue_counts(unpivot_text(raw[table], _raw_name(table), [column]), issue))
    return _union(parts)


def positive_numbers(raw: Raw, columns: Mapping[str, Sequence[str]] = POSITIVE_COLUMNS) -> DataFrame:
    value = F.col("raw_value")
    issue = (
        F.when(trimmed(value).isNull(), "missing value")
        .when(~matches(F.btrim(value), "[0-9]+"), "Non numeric value")
        .when(matches(F.btrim(value), "0+"), "Zero or negative value")
    )
    return _issue_counts(_union([unpivot_text(raw[t], _raw_name(t), cols) for t, cols in columns.items()]), issue)


def birth_date_issues(
    patients: DataFrame, earliest: dt.date = schemas.FIRST_VALID_BIRTH_DATE, domain: Domain = Domain()
) -> DataFrame:
    born = F.col("date_of_birth")
    parsed = parse_date(born, domain.date_formats)
    issue = (
        F.when(is_sentinel(born, schemas.VALUE_SENTINELS), "Missing or sentinel date")
        .when(parsed.isNull(), "Invalid date format")
        .when(parsed < F.lit(earliest), f"Birth date requires review: before {earliest.year}")
    )
    return patients.select("patient_id", "date_of_birth", issue.alias("issue_type")).where("issue_type IS NOT NULL")


def missing_foreign_keys(raw: Raw, columns: Mapping[str, Sequence[str]] = REQUIRED_KEYS) -> DataFrame:
    cells = _union([unpivot_text(raw[t], _raw_name(t), cols) for t, cols in columns.items()])
    return (
        cells.where(trimmed(F.col("raw_value")).isNull())
        .groupBy("table_name", "column_name")
        .agg(F.count("*").alias("missing_reference_count"))
    )


def orphan_foreign_keys(raw: Raw) -> DataFrame:
    """Keys without a parent row for all eight relationships, with the rows they affect."""
    found = orphan_keys(raw, raw, schemas.RELATIONSHIPS, norm_id)
    return found.select(
        F.concat("child_table", F.lit("_raw")).alias("child_table"), "foreign_key_column",
        F.concat("parent_table", F.lit("_raw")).alias("expected_parent_table"), "orphan_id", "affected_rows",
    )


def issue_summary(df: DataFrame, table: str, record: str, issues: Mapping[str, Column]) -> DataFrame:
    """Affected rows and distinct records of several rules in one pass; a row may break many rules."""
    broken = F.array(*[F.when(predicate, F.lit(name)) for name, predicate in issues.items()])
    hits = df.select(F.col(record).alias("record"), F.explode(F.array_compact(broken)).alias("issue_type"))
    return hits.groupBy("issue_type").agg(
        F.count("*").alias("affected_rows"), F.count_distinct("record").alias("affected_unique_records")
    ).select(F.lit(_raw_name(table)).alias("table_name"), "issue_type", "affected_rows", "affected_unique_records")


def impossible_timelines(raw: Raw, domain: Domain = Domain()) -> DataFrame:
    formats = {parse_date: domain.date_formats, parse_timestamp: (*domain.time_formats, *domain.date_formats)}

    def before(parse, later: str, earlier: str) -> Column:
        return parse(F.col(later), formats[parse]) < parse(F.col(earlier), formats[parse])

    rules = {
        "patients": {"Enrolment before date of birth": before(parse_date, "enrolment_date", "date_of_birth")},
        "referrals": {
            "First appointment before referral": before(parse_date, "first_appointment_date", "referral_date"),
            "Referral closed before referral date": before(parse_date, "closed_date", "referral_date"),
        },
        "appointments": {"Seen time before check-in time": before(parse_timestamp, "seen_time", "check_in_time")},
        "ed_visits": {"Discharge before arrival": before(parse_timestamp, "discharge_time", "arrival_time")},
    }
    return _union([issue_summary(raw[t], t, schemas.PRIMARY_KEYS[t][0], r) for t, r in rules.items()])


def status_consistency(raw: Raw) -> DataFrame:
    completed = norm_key(F.col("appointment_status")) == "completed"
    rules = {
        "appointments": {
            "Completed appointment missing check-in time": completed & trimmed(F.col("check_in_time")).isNull(),
            "Completed appointment missing seen time": completed & trimmed(F.col("seen_time")).isNull(),
        },
        "ed_visits": {
            "Disposition recorded but discharge time missing": trimmed(F.col("disposition")).isNotNull()
            & trimmed(F.col("discharge_time")).isNull(),
        },
    }
    return _union([issue_summary(raw[t], t, schemas.PRIMARY_KEYS[t][0], r) for t, r in rules.items()])


def visible_values(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Distinct values in square brackets."""
    cells = unpivot_text(df, _raw_name(table), columns)
    return cells.select("table_name", "column_name", bracketed(F.col("raw_value")).alias("visible_value")).distinct()


def exact_duplicates(df: DataFrame, upper: Sequence[str] = (), lower: Sequence[str] = ()) -> DataFrame:
    """Rows that are copies of each other after trimming and, where asked, case folding."""
    def normal(c: str) -> Column:
        text = F.btrim(F.col(c))
        text = F.upper(text) if c in upper else F.lower(text) if c in lower else text
        return text.alias(c)

    return (
        df.select(*[normal(c) for c in df.columns])
        .groupBy(*df.columns)
        .agg(F.count("*").alias("occurrence_count"))
        .where(F.col("occurrence_count") > 1)
    )


def unmatched_parents(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-blank child keys absent from a finished parent table."""
    return orphan_counts(child, parent, key, key).select(F.col("orphan_id").alias(f"unmatched_{key}"))
