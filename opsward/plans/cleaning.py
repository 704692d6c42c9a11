"""Raw to clean: one function per table.

Each cleaner normalises and parses in narrow projections, resolves parent keys with one left join
per relationship, derives the quality flags in the same projection, and removes exact copies of
the finished row at the end, so raw rows that differ only in an unusable value become one. The last column
marks dates and times that could not be read; rules see it, the clean tables do not hold it.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import (
    flag,
    initcap_words,
    is_sentinel,
    map_values,
    norm_id,
    norm_key,
    norm_label,
    null_if_before,
    parse_date,
    parse_date_in_range,
    parse_positive_int,
    parse_score,
    parse_timestamp,
    trimmed,
)
from ..operators.joins import Store, map_by_table, resolve_fk
from ..operators.keys import exact_dedupe, exact_dedupe_marked
from ..schemas import Domain

# Department names kept in capitals; fixed value.
NAME_EXCEPTIONS = {"ent": "ENT"}


#: Which dates and times of a row no form could read, one bit for each in the order of READ_FROM_TEXT.
UNREADABLE = "unreadable"


def unreadable(parsed: Mapping[str, Column]) -> Column:
    """The bits of the raw columns that hold a value, but none that was read."""
    bits = [
        F.when(~is_sentinel(F.col(raw), schemas.VALUE_SENTINELS) & value.isNull(), 1 << i).otherwise(0)
        for i, (raw, value) in enumerate(parsed.items())
    ]
    return reduce(Column.__add__, bits).alias(UNREADABLE)


def read_dates(table: str, domain: Domain) -> dict[str, Column]:
    """The date and time columns of a raw table, read by the domain's forms."""
    dates, times = domain.date_formats, (*domain.time_formats, *domain.date_formats)
    found = {c: parse_date(F.col(c), dates) for c in schemas.READ_AS_DATE.get(table, ())}
    return found | {c: parse_timestamp(F.col(c), times) for c in schemas.READ_AS_TIME.get(table, ())}


def with_read(raw: DataFrame, table: str, domain: Domain) -> tuple[DataFrame, dict[str, Column]]:
    """The raw table with its dates and times read into columns of their own, and these columns by raw name.

    Both the value and its mark then refer to a column: read inside one projection, Spark would try every form for every use.
    """
    read = read_dates(table, domain)
    names = {c: f"__read_{c}" for c in read}
    return raw.withColumns({names[c]: value for c, value in read.items()}), {c: F.col(n) for c, n in names.items()}


def _values(names: tuple[str, ...]) -> dict[str, str]:
    return {n.lower(): n for n in names}


def clean_facilities(raw: DataFrame, mappings: DataFrame) -> DataFrame:
    labelled = raw.select(
        norm_id(F.col("facility_id")).alias("facility_id"),
        norm_label(F.col("facility_name")).alias("facility_name"),
        norm_key(F.col("hospital_region")).alias("region_key"),
        norm_label(F.col("city")).alias("city"),
        norm_label(F.col("facility_type")).alias("facility_type"),
        parse_positive_int(F.col("bed_capacity")).alias("bed_capacity"),
    )
    mapped = map_by_table(exact_dedupe(labelled), "region_key", mappings, "hospital_region", "hospital_region")
    return mapped.select("facility_id", "facility_name", "hospital_region", "city", "facility_type", "bed_capacity")


def clean_departments(raw: DataFrame) -> DataFrame:
    """The facility key is kept as given: it is required and checked as a rule, not repaired."""
    targets = ("routine_target_days", "urgent_target_days", "appointment_wait_target_mins")
    return exact_dedupe(
        raw.select(
            norm_id(F.col("department_id")).alias("department_id"),
            norm_id(F.col("facility_id")).alias("facility_id"),
            norm_label(F.col("department_name"), NAME_EXCEPTIONS).alias("department_name"),
            norm_label(F.col("specialty_group")).alias("specialty_group"),
            *[parse_positive_int(F.col(t)).alias(t) for t in targets],
        )
    )


def clean_patients(raw: DataFrame, mappings: DataFrame, domain: Domain) -> DataFrame:
    born = F.col("date_of_birth")
    raw, read = with_read(raw, "patients", domain)
    valid_birth = parse_date_in_range(born, schemas.FIRST_VALID_BIRTH_DATE, domain.snapshot, domain.date_formats)
    no_ethnicity = is_sentinel(F.col("ethnicity"), schemas.VALUE_SENTINELS)
    typed = raw.select(
        norm_id(F.col("patient_id")).alias("patient_id"),
        F.when(~is_sentinel(born, schemas.VALUE_SENTINELS), valid_birth).alias("date_of_birth"),
        norm_key(F.col("gender")).alias("gender_key"),
        F.when(~no_ethnicity, initcap_words(F.btrim(F.col("ethnicity")))).alias("ethnicity"),
        norm_label(F.col("city")).alias("city"),
        parse_score(F.col("deprivation_quintile")).alias("deprivation_quintile"),
        read["enrolment_date"].alias("enrolment_date"),
        no_ethnicity.alias("ethnicity_missing_flag"),
        unreadable(read),
    ).withColumns(
        {
            "date_of_birth_issue_flag": F.col("date_of_birth").isNull(),
            "deprivation_quintile_issue_flag": F.col("deprivation_quintile").isNull(),
        }
    )
    mapped = map_by_table(exact_dedupe_marked(typed, UNREADABLE), "gender_key", mappings, "gender", "gender")
    return mapped.select(
        "patient_id", "date_of_birth", "gender", "ethnicity", "city", "deprivation_quintile", "enrolment_date",
        *schemas.QUALITY_FLAGS["patients"], UNREADABLE,
    )


def clean_referrals(
    raw: DataFrame, patients: DataFrame, departments: DataFrame, mappings: DataFrame, domain: Domain = Domain(), store: Store | None = None
) -> DataFrame:
    raw, read = with_read(raw, "referrals", domain)
    prepared = raw.select(
        norm_id(F.col("referral_id")).alias("referral_id"),
        norm_id(F.col("patient_id")).alias("patient_key"),
        norm_id(F.col("department_id")).alias("department_key"),
        read["referral_date"].alias("referral_date"),
        map_values(F.col("urgency"), _values(schemas.URGENCIES)).alias("urgency"),
        norm_key(F.col("referral_status")).alias("status_key"),
        read["first_appointment_date"].alias("first_seen"),
        read["closed_date"].alias("closed"),
        unreadable(read),
        norm_label(F.col("referral_source")).alias("referral_source"),
        parse_score(F.col("priority_score")).alias("priority_score"),
    )
    linked = resolve_fk(prepared, patients, "patient_key", "patient_id", "patient_id_issue_flag", store=store)
    linked = resolve_fk(
        linked, departments, "department_key", "department_id", "department_id_issue_flag", store=store
    )
    mapped = map_by_table(linked, "status_key", mappings, "referral_status", "referral_status")
    start = F.col("referral_date")
    finished = mapped.select(
        "referral_id", "patient_id", "department_id", "referral_date", "urgency", "referral_status",
        null_if_before(F.col("first_seen"), start).alias("first_appointment_date"),
        null_if_before(F.col("closed"), start).alias("closed_date"),
        "referral_source", "priority_score", "patient_id_issue_flag", "department_id_issue_flag",
        F.col("urgency").isNull().alias("urgency_issue_flag"),
        F.col("priority_score").isNull().alias("priority_score_issue_flag"),
        # Unknown only when an event has no referral date to compare with; the NOT NULL rule reports it.
        (
            (F.col("first_seen").isNotNull() & (F.col("first_seen") < start))
            | (F.col("closed").isNotNull() & (F.col("closed") < start))
        ).alias("timeline_issue_flag"),
        UNREADABLE,
    )
    return exact_dedupe_marked(finished, UNREADABLE)


def clean_appointments(
    raw: DataFrame,
    patients: DataFrame,
    departments: DataFrame,
    referrals: DataFrame,
    mappings: DataFrame,
    domain: Domain = Domain(),
    store: Store | None = None,
) -> DataFrame:
    raw, read = with_read(raw, "appointments", domain)
    prepared = raw.select(
        norm_id(F.col("appointment_id")).alias("appointment_id"),
        norm_id(F.col("patient_id")).alias("patient_key"),
        norm_id(F.col("department_id")).alias("department_key"),
        norm_id(F.col("referral_id")).alias("referral_key"),
        read["scheduled_datetime"].alias("scheduled_datetime"),
        read["check_in_time"].alias("check_in_time"),
        read["seen_time"].alias("seen"),
        unreadable(read),
        norm_key(F.col("appointment_status")).alias("status_key"),
        map_values(F.col("appointment_type"), _values(schemas.APPOINTMENT_TYPES)).alias("appointment_type"),
        map_values(F.col("booking_channel"), _values(schemas.BOOKING_CHANNELS)).alias("booking_channel"),
    )
    linked = resolve_fk(prepared, patients, "patient_key", "patient_id", "patient_id_issue_flag", store=store)
    linked = resolve_fk(
        linked, departments, "department_key", "department_id", "department_id_issue_flag", store=store
    )
    linked = resolve_fk(
        linked, referrals, "referral_key", "referral_id", "referral_id_issue_flag", optional=True, store=store
    )
    mapped = map_by_table(linked, "status_key", mappings, "appointment_status", "appointment_status")
    arrived, seen = F.col("check_in_time"), F.col("seen")
    reversed_times = flag(seen < arrived)
    finished = mapped.select(
        "appointment_id", "patient_id", "department_id", "referral_id", "scheduled_datetime", "check_in_time",
        null_if_before(seen, arrived, keep_without_base=True).alias("seen_time"),
        "appointment_status", "appointment_type", "booking_channel",
        "patient_id_issue_flag", "department_id_issue_flag", "referral_id_issue_flag",
        (
            (F.col("appointment_status") == "Completed") & (arrived.isNull() | seen.isNull() | reversed_times)
        ).alias("status_timestamp_issue_flag"),
        reversed_times.alias("timeline_issue_flag"),
        UNREADABLE,
    )
    return exact_dedupe_marked(finished, UNREADABLE)


def clean_ed_visits(
    raw: DataFrame, patients: DataFrame, facilities: DataFrame, domain: Domain = Domain(), store: Store | None = None
) -> DataFrame:
    raw, read = with_read(raw, "ed_visits", domain)
    prepared = raw.select(
        norm_id(F.col("visit_id")).alias("visit_id"),
        norm_id(F.col("patient_id")).alias("patient_key"),
        norm_id(F.col("facility_id")).alias("facility_key"),
        read["arrival_time"].alias("arrival_time"),
        parse_score(trimmed(F.col("triage_category"))).alias("triage_category"),
        read["discharge_time"].alias("left_at"),
        unreadable(read),
        map_values(F.col("disposition"), _values(schemas.DISPOSITIONS)).alias("disposition"),
        map_values(F.col("admitted_flag"), schemas.YES_NO).alias("admitted_flag"),
        map_values(F.col("presenting_group"), _values(schemas.PRESENTING_GROUPS)).alias("presenting_group"),
    )
    linked = resolve_fk(prepared, patients, "patient_key", "patient_id", "patient_id_issue_flag", store=store)
    linked = resolve_fk(linked, facilities, "facility_key", "facility_id", "facility_id_issue_flag", store=store)
    left_at, arrival = F.col("left_at"), F.col("arrival_time")
    admitted = F.col("disposition") == "Admitted"
    finished = linked.select(
        "visit_id", "patient_id", "facility_id", "arrival_time", "triage_category",
        null_if_before(left_at, arrival).alias("discharge_time"),
        "disposition", "admitted_flag", "presenting_group", "patient_id_issue_flag", "facility_id_issue_flag",
        F.col("triage_category").isNull().alias("triage_category_issue_flag"),
        # Unknown when both discharge and disposition are missing; the NOT NULL rule reports it.
        (left_at.isNull() & (F.col("disposition") != "Left Before Treatment")).alias("missing_discharge_time_flag"),
        flag(left_at < arrival).alias("timeline_issue_flag"),
        F.coalesce(admitted != F.col("admitted_flag"), F.lit(True)).alias("admission_consistency_issue_flag"),
        UNREADABLE,
    )
    return exact_dedupe_marked(finished, UNREADABLE)


def clean_table(
    table: str, raw: DataFrame, clean: Mapping[str, DataFrame], domain: Domain, store: Store | None = None
) -> DataFrame:
    """Clean one table; ``clean`` holds the finished parents and the reference mappings."""
    if table == "facilities":
        return clean_facilities(raw, clean["reference_mappings"])
    if table == "departments":
        return clean_departments(raw)
    if table == "patients":
        return clean_patients(raw, clean["reference_mappings"], domain)
    parents = [clean[name] for name in PARENTS[table]]
    if table == "referrals":
        return clean_referrals(raw, *parents, domain, store=store)
    if table == "appointments":
        return clean_appointments(raw, *parents, domain, store=store)
    if table == "ed_visits":
        return clean_ed_visits(raw, *parents, domain, store=store)
    raise KeyError(table)


# Tables each fact cleaner reads besides its own raw table, in the order of its arguments.
PARENTS = {
    "referrals": ("patients", "departments", "reference_mappings"),
    "appointments": ("patients", "departments", "referrals", "reference_mappings"),
    "ed_visits": ("patients", "facilities"),
}
