"""Analytic views: one row per referral, appointment and emergency visit.

Views are lazy. ``dims`` names the dimensions a caller needs; the others are neither read nor
joined, because Spark cannot drop an unused outer join without knowing the key is unique.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import days_between, elapsed_2dp, flag, month_of
from ..operators.joins import enrich
from ..schemas import Domain

Clean = Mapping[str, DataFrame]
ALL_DIMS = frozenset({"patients", "departments", "facilities"})


def _facility_dim(clean: Clean, columns: list[str]) -> DataFrame:
    renamed = clean["facilities"].withColumnRenamed("city", "facility_city")
    return renamed.select("facility_id", *columns)


def _department_dim(clean: Clean, targets: list[str], with_facility: bool) -> DataFrame:
    """Departments joined to their facility first, so a fact needs one join for both."""
    departments = clean["departments"].select(
        "department_id", "facility_id", "department_name", "specialty_group", *targets
    )
    if not with_facility:
        return departments
    facilities = _facility_dim(clean, ["facility_name", "hospital_region", "facility_city"])
    return departments.join(facilities, "facility_id", "left")


def _patient_dim(clean: Clean, columns: list[str]) -> DataFrame:
    renamed = clean["patients"].withColumnRenamed("city", "patient_city")
    return renamed.select("patient_id", *columns)


def wait_band(days: Column) -> Column:
    """Waiting-time band; negative waits fall into the last band, as every value outside the others."""
    band = None
    for name, low, high in schemas.WAIT_BANDS:
        inside = days.between(low, high)
        band = F.when(inside, name) if band is None else band.when(inside, name)
    return band.otherwise(schemas.LAST_WAIT_BAND)


def band_order(band: Column) -> Column:
    names = [name for name, _, _ in schemas.WAIT_BANDS] + [schemas.LAST_WAIT_BAND]
    order = F.when(band == names[0], 1)
    for i, name in enumerate(names[1:], start=2):
        order = order.when(band == name, i)
    return order


def referral_view(clean: Clean, domain: Domain, dims: Collection[str] = ALL_DIMS) -> DataFrame:
    joined = []
    if "patients" in dims:
        columns = ["date_of_birth", "gender", "ethnicity", "patient_city", "deprivation_quintile"]
        joined.append((_patient_dim(clean, columns), "patient_id"))
    if "departments" in dims:
        targets = ["routine_target_days", "urgent_target_days"]
        joined.append((_department_dim(clean, targets, "facilities" in dims), "department_id"))
    flags = schemas.QUALITY_FLAGS["referrals"]
    base = enrich(clean["referrals"].drop(*flags), joined)

    waiting = F.col("referral_status").isin(*schemas.BACKLOG_STATUSES)
    waited = days_between(F.lit(domain.snapshot), F.col("referral_date"))
    to_first = days_between(F.col("first_appointment_date"), F.col("referral_date"))
    derived = {
        "days_to_first_appointment": to_first,
        "backlog_flag": waiting,
        "snapshot_date": F.lit(domain.snapshot),
        "backlog_wait_days": F.when(waiting, waited),
        # An unknown status is no stated non-backlog status, so the band falls through as in the
        # questions this view answers.
        "backlog_wait_band": F.when(F.coalesce(waiting, F.lit(True)), wait_band(waited)),
    }
    if "departments" in dims:
        # Only urgent and routine referrals have a target.
        target = F.when(F.col("urgency") == "Urgent", F.col("urgent_target_days")).when(
            F.col("urgency") == "Routine", F.col("routine_target_days")
        )
        derived["target_days"] = target
        derived["first_appointment_met_target_flag"] = to_first <= target
        derived["backlog_over_target_flag"] = F.when(F.coalesce(waiting, F.lit(True)), waited > target)
    return base.withColumns(derived).drop("routine_target_days", "urgent_target_days")


def appointment_view(clean: Clean, domain: Domain, dims: Collection[str] = ALL_DIMS) -> DataFrame:
    joined = []
    if "patients" in dims:
        columns = ["gender", "ethnicity", "patient_city", "deprivation_quintile"]
        joined.append((_patient_dim(clean, columns), "patient_id"))
    if "departments" in dims:
        joined.append(
            (_department_dim(clean, ["appointment_wait_target_mins"], "facilities" in dims), "department_id")
        )
    base = enrich(clean["appointments"], joined)
    status = F.col("appointment_status")
    usable = (
        (status == "Completed")
        & F.col("check_in_time").isNotNull()
        & F.col("seen_time").isNotNull()
        & ~flag(F.col("status_timestamp_issue_flag"))
        & ~flag(F.col("timeline_issue_flag"))
    )
    view = base.withColumns(
        {
            "scheduled_date": F.col("scheduled_datetime").cast("date"),
            "scheduled_month": month_of(F.col("scheduled_datetime")),
            "waiting_minutes": F.when(usable, elapsed_2dp("minute", F.col("check_in_time"), F.col("seen_time"))),
            "attendance_eligible_flag": status.isin("Completed", "No Show"),
            "completed_flag": status == "Completed",
            "no_show_flag": status == "No Show",
        }
    ).withColumn("wait_time_eligible_flag", F.col("waiting_minutes").isNotNull())
    if "departments" in dims:
        view = view.withColumn(
            "met_wait_target_flag", F.col("waiting_minutes") <= F.col("appointment_wait_target_mins")
        )
    return view


def ed_visit_view(clean: Clean, domain: Domain, dims: Collection[str] = ALL_DIMS) -> DataFrame:
    joined = []
    if "patients" in dims:
        columns = ["gender", "ethnicity", "patient_city", "deprivation_quintile"]
        joined.append((_patient_dim(clean, columns), "patient_id"))
    if "facilities" in dims:
        columns = ["facility_name", "hospital_region", "facility_city", "facility_type"]
        joined.append((_facility_dim(clean, columns), "facility_id"))
    base = enrich(clean["ed_visits"], joined)
    usable = F.col("discharge_time").isNotNull() & ~flag(F.col("timeline_issue_flag"))
    stay = elapsed_2dp("hour", F.col("arrival_time"), F.col("discharge_time"))
    return base.withColumns(
        {
            "arrival_date": F.col("arrival_time").cast("date"),
            "arrival_month": month_of(F.col("arrival_time")),
            "length_of_stay_hours": F.when(usable, stay),
            "left_before_treatment_flag": F.col("disposition") == "Left Before Treatment",
        }
    ).withColumn("length_of_stay_eligible_flag", F.col("length_of_stay_hours").isNotNull())


def register_views(clean: Clean, domain: Domain) -> None:
    """Create or replace the three views as temporary views for SQL users."""
    referral_view(clean, domain).createOrReplaceTempView("vw_referral_analysis")
    appointment_view(clean, domain).createOrReplaceTempView("vw_appointment_analysis")
    ed_visit_view(clean, domain).createOrReplaceTempView("vw_ed_visit_analysis")
