"""Checks after cleaning: counts, flags, cross-table agreement and KPI readiness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import pct
from ..operators.joins import join_inflation, orphan_keys
from ..operators.ordering import with_position
from ..operators.stacking import count_rules
from ..schemas import Domain
from .views import Clean

# Categories reviewed after cleaning: one frequency table per entry.
REVIEWED = {
    "facilities": [("hospital_region",)],
    "departments": [("department_name", "specialty_group")],
    "patients": [("gender",), ("ethnicity",), ("city",), ("deprivation_quintile",)],
    "referrals": [("urgency",), ("referral_status",), ("referral_source",)],
    "appointments": [("appointment_status",), ("appointment_type",), ("booking_channel",)],
    "ed_visits": [("triage_category",), ("disposition", "admitted_flag"), ("presenting_group",)],
}


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def pass_or_review(ok: Column) -> Column:
    return F.when(ok, "PASS").otherwise("REVIEW")


def reconcile_counts(raw: Mapping[str, DataFrame], clean: Clean) -> DataFrame:
    parts = []
    for table in raw:
        counted = raw[table].agg(F.count("*").alias("raw_rows")).select(
            F.lit(table).alias("table_name"), "raw_rows",
            clean[table].agg(F.count("*")).scalar().alias("clean_rows"),
        )
        parts.append(counted.withColumn("removed_rows", F.col("raw_rows") - F.col("clean_rows")))
    return _union(parts)


def uniqueness(clean: Clean) -> DataFrame:
    parts = []
    for table in schemas.TABLES:
        key = schemas.PRIMARY_KEYS[table][0]
        parts.append(
            clean[table].agg(F.count("*").alias("total_rows"), F.count_distinct(key).alias("unique_ids"))
            .select(F.lit(table).alias("table_name"), "total_rows", "unique_ids")
        )
    return _union(parts)


def missing_required(clean: Clean) -> DataFrame:
    parts = []
    for table in schemas.TABLES:
        flags = set(schemas.QUALITY_FLAGS.get(table, ()))
        names = [p.split()[0] for p in schemas.CLEAN_DDL[table].split(",")]
        required = [c for c in names if c not in schemas.NULLABLE[table] and c not in flags]
        parts.append(count_rules(clean[table], table, {c: F.col(c).isNull() for c in required}, "missing_rows"))
    return _union(parts).withColumnRenamed("rule_name", "column_name")


def flag_totals(clean: Clean) -> DataFrame:
    parts = [
        count_rules(clean[table], table, {f: F.col(f) for f in flags}, "flagged_rows")
        for table, flags in schemas.QUALITY_FLAGS.items()
    ]
    return _union(parts).withColumnRenamed("rule_name", "flag_name")


def flag_disagreements() -> dict[str, dict[str, Column]]:
    """Predicates for rows whose flag contradicts the cleaned value."""
    def exactly_when_null(flag: str, value: str) -> Column:
        return F.col(flag) != F.col(value).isNull()

    def never_with_value(flag: str, value: str) -> Column:
        return F.col(flag) & F.col(value).isNotNull()

    completed_without_times = (
        (F.col("appointment_status") == "Completed")
        & ~F.col("status_timestamp_issue_flag")
        & (F.col("check_in_time").isNull() | F.col("seen_time").isNull())
    )
    return {
        "patients": {
            "ethnicity_missing_flag": exactly_when_null("ethnicity_missing_flag", "ethnicity"),
            "date_of_birth_issue_flag": exactly_when_null("date_of_birth_issue_flag", "date_of_birth"),
            "deprivation_quintile_issue_flag": exactly_when_null(
                "deprivation_quintile_issue_flag", "deprivation_quintile"
            ),
        },
        "referrals": {
            "patient_id_issue_flag": exactly_when_null("patient_id_issue_flag", "patient_id"),
            "department_id_issue_flag": exactly_when_null("department_id_issue_flag", "department_id"),
            "urgency_issue_flag": exactly_when_null("urgency_issue_flag", "urgency"),
            "priority_score_issue_flag": exactly_when_null("priority_score_issue_flag", "priority_score"),
        },
        "appointments": {
            "patient_id_issue_flag": exactly_when_null("patient_id_issue_flag", "patient_id"),
            "department_id_issue_flag": exactly_when_null("department_id_issue_flag", "department_id"),
            "referral_id_issue_flag": never_with_value("referral_id_issue_flag", "referral_id"),
            "timeline_issue_flag": never_with_value("timeline_issue_flag", "seen_time"),
            "status_timestamp_issue_flag": completed_without_times,
        },
        "ed_visits": {
            "patient_id_issue_flag": exactly_when_null("patient_id_issue_flag", "patient_id"),
            "facility_id_issue_flag": exactly_when_null("facility_id_issue_flag", "facility_id"),
            "triage_category_issue_flag": exactly_when_null("triage_category_issue_flag", "triage_category"),
            "timeline_issue_flag": never_with_value("timeline_issue_flag", "discharge_time"),
            "missing_discharge_time_flag": never_with_value("missing_discharge_time_flag", "discharge_time"),
        },
    }


def flag_agreement(clean: Clean) -> DataFrame:
    """Number of rows per flag that contradict the cleaned value; none is expected."""
    parts = [count_rules(clean[t], t, rules, "mismatched_rows") for t, rules in flag_disagreements().items()]
    return _union(parts).withColumnRenamed("rule_name", "flag_name")


def flag_mismatch_rows(table: str, df: DataFrame) -> DataFrame:
    """The contradicting rows themselves."""
    return df.where(reduce(lambda a, b: a | b, flag_disagreements()[table].values()))


def remaining_timelines(clean: Clean) -> DataFrame:
    rules = {
        "referrals": {
            "first_appointment_date < referral_date": F.col("first_appointment_date") < F.col("referral_date"),
            "closed_date < referral_date": F.col("closed_date") < F.col("referral_date"),
        },
        "appointments": {"seen_time < check_in_time": F.col("seen_time") < F.col("check_in_time")},
        "ed_visits": {"discharge_time < arrival_time": F.col("discharge_time") < F.col("arrival_time")},
    }
    return _union([count_rules(clean[t], t, r, "remaining_rows") for t, r in rules.items()])


def admission_mismatches(ed_visits: DataFrame) -> DataFrame:
    return ed_visits.where((F.col("disposition") == "Admitted") != F.col("admitted_flag"))


def category_review(clean: Clean) -> DataFrame:
    """Frequencies of the cleaned categories as (table_name, categories, category_values, record_count)."""
    parts = []
    for table, groups in REVIEWED.items():
        wanted = list(dict.fromkeys(c for g in groups for c in g))
        texts = clean[table].select(*[F.coalesce(F.col(c).cast("string"), F.lit("[NULL]")).alias(c) for c in wanted])
        cells = texts.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(", ".join(g)).alias("categories"),
                            F.concat_ws(", ", *[F.col(c) for c in g]).alias("category_values"),
                        )
                        for g in groups
                    ]
                )
            )
        )
        counts = cells.groupBy("categories", "category_values").agg(F.count("*").alias("record_count"))
        parts.append(counts.select(F.lit(table).alias("table_name"), "categories", "category_values", "record_count"))
    return _union(parts)


def completeness(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"), F.count_if(F.col(column).isNull()).alias("missing_rows")
    ).withColumn("completeness_percentage", pct(F.col("total_rows") - F.col("missing_rows"), F.col("total_rows")))


def flagged_rows(table: str, df: DataFrame) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(f) for f in schemas.QUALITY_FLAGS[table]]))


def referential_integrity(clean: Clean) -> DataFrame:
    """Rows with a key that no parent has, for every relationship; each table is read once for each side it is on."""
    tables = {t: clean[t] for t in schemas.TABLES}
    lost = orphan_keys(tables, tables, schemas.RELATIONSHIPS, lambda key: key)
    keys = ["child_table", "foreign_key_column", "parent_table"]
    every = clean["facilities"].sparkSession.createDataFrame(schemas.RELATIONSHIPS, ", ".join(f"{k} string" for k in keys))
    counted = lost.groupBy(*keys).agg(F.sum("affected_rows").alias("orphan_rows"))
    return every.join(F.broadcast(counted), keys, "left").fillna(0, ["orphan_rows"])


def cross_table_consistency(clean: Clean) -> DataFrame:
    """Appointments against the referral they name."""
    referral = clean["referrals"].select(
        "referral_id", F.col("patient_id").alias("r_patient"), F.col("department_id").alias("r_department"),
        "referral_date",
    )
    linked = clean["appointments"].select("referral_id", "patient_id", "department_id", "scheduled_datetime").join(
        referral, "referral_id"
    )
    counts = linked.agg(
        F.count("*").alias("linked_appointment_count"),
        F.count_if(F.col("patient_id") != F.col("r_patient")).alias("patient_mismatch_count"),
        F.count_if(F.col("department_id") != F.col("r_department")).alias("department_mismatch_count"),
        F.count_if(F.col("scheduled_datetime").cast("date") < F.col("referral_date")).alias(
            "appointment_before_referral_count"
        ),
    )
    clear = F.greatest(*[F.col(c) for c in counts.columns[1:]]) == 0
    return counts.withColumn("validation_status", pass_or_review(clear))


def event_before_birth(clean: Clean) -> DataFrame:
    """Events dated before the patient's birth; patients without a usable birth date are left out.

    Only each patient's distinct event days with their count enter the join.
    """
    born = clean["patients"].where(F.col("date_of_birth").isNotNull()).select("patient_id", "date_of_birth")
    events = {
        "Referral before patient birth": ("referrals", "referral_date"),
        "Appointment before patient birth": ("appointments", "scheduled_datetime"),
        "ED visit before patient birth": ("ed_visits", "arrival_time"),
    }
    parts = []
    for rule, (table, time) in events.items():
        days = clean[table].groupBy("patient_id", F.col(time).cast("date").alias("day")).agg(F.count("*").alias("n"))
        early = days.join(born, "patient_id").where(F.col("day") < F.col("date_of_birth"))
        parts.append(
            early.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("issue_count")).select(
                F.lit(rule).alias("validation_rule"), "issue_count",
                pass_or_review(F.col("issue_count") == 0).alias("validation_status"),
            )
        )
    return _union(parts)


def model_inflation(clean: Clean) -> DataFrame:
    """Row counts of the three facts before and after their dimension joins."""
    models = {
        "Referrals analytical join": ("referrals", ["patients", "departments"]),
        "Appointments analytical join": ("appointments", ["patients", "departments", "referrals"]),
        "ED visits analytical join": ("ed_visits", ["patients", "facilities"]),
    }
    return _union(
        [
            join_inflation(clean[fact], [(clean[d], schemas.PRIMARY_KEYS[d][0]) for d in dims], rule)
            for rule, (fact, dims) in models.items()
        ]
    )


def kpi_readiness(clean: Clean, domain: Domain) -> DataFrame:
    """Candidates and eligible records of four KPIs; stricter than the views, which keep unknown places."""
    def known(c: str) -> Column:
        return F.col(c).isNotNull()

    completed = F.col("appointment_status") == "Completed"
    booked = F.col("referral_status").isin("Completed", "Booked")
    waiting = F.col("referral_status").isin(*schemas.BACKLOG_STATUSES)
    sound_wait = (
        known("check_in_time") & known("seen_time") & ~F.col("status_timestamp_issue_flag")
        & ~F.col("timeline_issue_flag") & known("department_id")
    )
    first_seen = (F.col("first_appointment_date") >= F.col("referral_date")) & known("department_id")
    in_backlog = (F.col("referral_date") <= F.lit(domain.snapshot)) & known("department_id")
    sound_stay = known("discharge_time") & ~F.col("timeline_issue_flag") & known("facility_id")
    metrics = {
        "appointments": {"Appointment waiting time": (completed, completed & sound_wait)},
        "referrals": {
            "Referral time to first appointment": (booked, booked & first_seen),
            "Open referral backlog": (waiting, waiting & in_backlog),
        },
        "ed_visits": {"ED length of stay": (F.lit(True), sound_stay)},
    }
    parts = []
    for table, own in metrics.items():
        aggregates = []
        for i, (candidate, eligible) in enumerate(own.values()):
            aggregates += [F.count_if(candidate).alias(f"c{i}"), F.count_if(eligible).alias(f"e{i}")]
        entries = [
            F.struct(
                F.lit(name).alias("metric_name"), F.col(f"c{i}").alias("candidate_records"),
                F.col(f"e{i}").alias("eligible_records"),
            )
            for i, name in enumerate(own)
        ]
        parts.append(clean[table].agg(*aggregates).select(F.inline(F.array(*entries))))
    candidates, eligible = F.col("candidate_records"), F.col("eligible_records")
    return _union(parts).withColumns(
        {"excluded_records": candidates - eligible, "eligible_percentage": pct(eligible, candidates)}
    )


def negative_waits(clean: Clean, domain: Domain) -> DataFrame:
    """Backlog referrals dated after the snapshot, which the wait bands put into the last band."""
    backlog = clean["referrals"].where(F.col("referral_status").isin(*schemas.BACKLOG_STATUSES))
    return backlog.agg(F.count_if(F.col("referral_date") > F.lit(domain.snapshot)).alias("negative_wait_rows"))


def final_review(table: str, df: DataFrame) -> DataFrame:
    """All rows by primary key, with their position; rows that repeat a key stand next to each other."""
    return with_position(df, [F.col(k).asc_nulls_last() for k in schemas.PRIMARY_KEYS[table]], "review_position")
