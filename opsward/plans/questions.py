"""Business questions over the clean layer: referrals, appointments, emergency visits.

Every function takes the clean tables and the domain and returns the ordered answer. Counts are
aggregated on the fact's own keys before names are joined wherever the measures are additive.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import avg_2dp, month_name, month_of, pct, ratio_avg_2dp
from ..operators.ordering import with_position
from ..operators.rollups import sums_by_dimension
from ..operators.shares import share_of_total
from ..operators.windows import previous_value
from ..schemas import Domain
from .views import Clean, appointment_view, band_order, ed_visit_view, referral_view

PLACE = ("hospital_region", "facility_name", "department_name")


def _up(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def _down(metric: str, *ties: str) -> list[Column]:
    return [F.col(metric).desc_nulls_first(), *_up(*ties)]


def department_places(clean: Clean) -> DataFrame:
    return clean["departments"].join(clean["facilities"], "facility_id", "left").select("department_id", *PLACE)


# Referrals

def referrals_by_month_status(clean: Clean, domain: Domain) -> DataFrame:
    month = month_of(F.col("referral_date")).alias("referral_month")
    counts = clean["referrals"].groupBy(month, "referral_status").agg(F.count("*").alias("total_referrals"))
    return counts.orderBy(*_up("referral_month", "referral_status"))


def backlog_by_department(clean: Clean, domain: Domain) -> DataFrame:
    view = referral_view(clean, domain, {"departments", "facilities"})
    known, over = F.col("target_eligible_referrals"), F.col("referrals_over_target")
    return (
        view.where("backlog_flag")
        .groupBy(*PLACE)
        .agg(
            F.count("*").alias("total_backlog"),
            avg_2dp(F.col("backlog_wait_days")).alias("average_wait_days"),
            F.count("backlog_over_target_flag").alias("target_eligible_referrals"),
            F.count_if("backlog_over_target_flag").alias("referrals_over_target"),
        )
        .withColumn("over_target_percentage", pct(over, known))
        .orderBy(*_down("total_backlog", *PLACE))
    )


def backlog_bands(clean: Clean, domain: Domain) -> DataFrame:
    counts = sums_by_dimension(
        referral_view(clean, domain, ()).where("backlog_flag"), "department_id", department_places(clean),
        ["hospital_region"], {"referral_count": F.count("*")}, fact_by=["backlog_wait_band"],
    )
    return counts.orderBy(*_up("hospital_region"), band_order(F.col("backlog_wait_band")))


def first_appointment_target(clean: Clean, domain: Domain, by=("hospital_region", "urgency")) -> DataFrame:
    view = referral_view(clean, domain, {"departments", "facilities"})
    return (
        view.where(F.col("first_appointment_met_target_flag").isNotNull())
        .groupBy(*by)
        .agg(
            F.count("*").alias("referrals_with_known_target"),
            avg_2dp(F.col("days_to_first_appointment")).alias("average_days_to_first_appointment"),
            F.count_if("first_appointment_met_target_flag").alias("referrals_within_target"),
        )
        .withColumn(
            "target_met_percentage", pct(F.col("referrals_within_target"), F.col("referrals_with_known_target"))
        )
        .orderBy(*_up(*by))
    )


def extreme_months(clean: Clean, domain: Domain, padded: bool = True) -> DataFrame:
    """Months with the most and the fewest referrals of each year; ties are kept."""
    month = month_of(F.col("referral_date")).alias("month_start")
    monthly = clean["referrals"].groupBy(month).agg(F.count("*").alias("total_referrals"))
    in_year = Window.partitionBy(F.year("month_start"))
    ranked = monthly.withColumns(
        {
            "from_top": F.dense_rank().over(in_year.orderBy(F.col("total_referrals").desc_nulls_first())),
            "from_bottom": F.dense_rank().over(in_year.orderBy(F.col("total_referrals").asc_nulls_last())),
        }
    )
    return (
        ranked.where((F.col("from_top") == 1) | (F.col("from_bottom") == 1))
        .select(
            F.year("month_start").alias("referral_year"),
            month_name(F.col("month_start"), padded).alias("referral_month"),
            "total_referrals",
            F.when(F.col("from_top") == 1, "Highest").otherwise("Lowest").alias("result_type"),
        )
        .orderBy(*_up("referral_year"), *_down("total_referrals", "referral_month"))
    )


def status_share(clean: Clean, domain: Domain) -> DataFrame:
    counts = clean["referrals"].groupBy("referral_status").agg(F.count("*").alias("total_referrals"))
    return share_of_total(counts, "total_referrals", "share_percentage").orderBy(
        *_down("total_referrals", "referral_status")
    )


def backlog_network(clean: Clean, domain: Domain) -> DataFrame:
    view = referral_view(clean, domain, {"departments"})
    return (
        view.where("backlog_flag")
        .agg(
            F.count("*").alias("total_backlog_referrals"),
            F.count("backlog_over_target_flag").alias("target_eligible_referrals"),
            F.count_if("backlog_over_target_flag").alias("referrals_over_target"),
        )
        .withColumn(
            "network_over_target_percentage",
            pct(F.col("referrals_over_target"), F.col("target_eligible_referrals")),
        )
    )


# Appointments

def _attendance_sums() -> dict[str, Column]:
    return {"eligible_appointments": F.count("*"), "no_show_appointments": F.count_if("no_show_flag")}


def _with_no_show_rate(df: DataFrame) -> DataFrame:
    rate = pct(F.col("no_show_appointments"), F.col("eligible_appointments"))
    return df.withColumn("no_show_rate_percentage", rate)


def appointments_by_month_status(clean: Clean, domain: Domain) -> DataFrame:
    counts = (
        appointment_view(clean, domain, ())
        .groupBy("scheduled_month", "appointment_status")
        .agg(F.count("*").alias("appointment_count"))
    )
    return counts.orderBy(*_up("scheduled_month", "appointment_status"))


def no_show_by_department(clean: Clean, domain: Domain) -> DataFrame:
    eligible = appointment_view(clean, domain, ()).where("attendance_eligible_flag")
    sums = sums_by_dimension(eligible, "department_id", department_places(clean), PLACE, _attendance_sums())
    return _with_no_show_rate(sums).orderBy(*_down("no_show_rate_percentage", *PLACE))


def wait_target_by_department(clean: Clean, domain: Domain, by=PLACE) -> DataFrame:
    view = appointment_view(clean, domain, {"departments", "facilities"})
    return (
        view.where("wait_time_eligible_flag")
        .groupBy(*by)
        .agg(
            F.count("*").alias("appointments_with_wait_time"),
            avg_2dp(F.col("waiting_minutes")).alias("average_waiting_minutes"),
            F.count("met_wait_target_flag").alias("target_eligible_appointments"),
            F.count_if("met_wait_target_flag").alias("appointments_within_target"),
        )
        .withColumn(
            "target_met_percentage", pct(F.col("appointments_within_target"), F.col("target_eligible_appointments"))
        )
        .orderBy(*_up("target_met_percentage", *by))
    )


def no_show_by_channel(clean: Clean, domain: Domain) -> DataFrame:
    eligible = appointment_view(clean, domain, ()).where("attendance_eligible_flag")
    sums = eligible.groupBy("booking_channel").agg(*[c.alias(n) for n, c in _attendance_sums().items()])
    return _with_no_show_rate(sums).orderBy(*_down("no_show_rate_percentage", "booking_channel"))


def no_show_by_quintile(clean: Clean, domain: Domain) -> DataFrame:
    """Counted per patient before the patient join, which shuffles one row per patient."""
    eligible = appointment_view(clean, domain, ()).where("attendance_eligible_flag")
    known = clean["patients"].where(F.col("deprivation_quintile").isNotNull())
    sums = sums_by_dimension(eligible, "patient_id", known, ["deprivation_quintile"], _attendance_sums())
    return _with_no_show_rate(sums.where(F.col("deprivation_quintile").isNotNull())).orderBy("deprivation_quintile")


# One patient

def patient_history(clean: Clean, patients: Sequence[str]) -> DataFrame:
    """Referrals, appointments and emergency visits of some patients with time and outcome.

    Reads the patients' buckets where the tables are stored by patient, the whole tables otherwise.
    """
    events = {
        "referral": ("referrals", "referral_id", "referral_date", "referral_status"),
        "appointment": ("appointments", "appointment_id", "scheduled_datetime", "appointment_status"),
        "ED visit": ("ed_visits", "visit_id", "arrival_time", "disposition"),
    }
    parts = []
    for event, (table, key, time, outcome) in events.items():
        access = clean.get(f"{table}_by_patient")
        rows = clean[table].where(F.col("patient_id").isin(*patients)) if access is None else access.history(*patients)
        parts.append(
            rows.select(
                "patient_id", F.lit(event).alias("event"), F.col(key).alias("event_id"),
                F.col(time).cast("timestamp_ntz").alias("happened_at"), F.col(outcome).alias("outcome"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


# Emergency visits

def ed_by_month_region(clean: Clean, domain: Domain) -> DataFrame:
    counts = sums_by_dimension(
        ed_visit_view(clean, domain, ()), "facility_id", clean["facilities"], ["hospital_region"],
        {"total_ed_visits": F.count("*")}, fact_by=["arrival_month"],
    )
    return counts.orderBy(*_up("arrival_month", "hospital_region"))


def ed_length_of_stay(clean: Clean, domain: Domain) -> DataFrame:
    stays = ed_visit_view(clean, domain, ()).where("length_of_stay_eligible_flag")
    hours = F.col("length_of_stay_hours")
    sums = sums_by_dimension(
        stays, "facility_id", clean["facilities"], ["hospital_region", "facility_name"],
        {"eligible_ed_visits": F.count("*"), "hours": F.sum(hours)}, {"longest_length_of_stay_hours": F.max(hours)},
    )
    average = ratio_avg_2dp(F.col("hours"), F.col("eligible_ed_visits"))
    return (
        sums.withColumn("average_length_of_stay_hours", average)
        .drop("hours")
        .orderBy(*_down("average_length_of_stay_hours", "hospital_region", "facility_name"))
    )


def admission_and_left(clean: Clean, domain: Domain) -> DataFrame:
    sums = sums_by_dimension(
        ed_visit_view(clean, domain, ()), "facility_id", clean["facilities"], ["hospital_region", "facility_name"],
        {
            "total_ed_visits": F.count("*"),
            "admitted_visits": F.count_if("admitted_flag"),
            "left_before_treatment_visits": F.count_if("left_before_treatment_flag"),
        },
    )
    total = F.col("total_ed_visits")
    return sums.withColumns(
        {
            "admission_rate_percentage": pct(F.col("admitted_visits"), total),
            "left_before_treatment_percentage": pct(F.col("left_before_treatment_visits"), total),
        }
    ).orderBy(*_down("total_ed_visits", "hospital_region", "facility_name"))


def presenting_mix(clean: Clean, domain: Domain, column: str = "presenting_group") -> DataFrame:
    counts = clean["ed_visits"].groupBy(column).agg(F.count("*").alias("total_ed_visits"))
    return share_of_total(counts, "total_ed_visits", "percentage_of_ed_visits").orderBy(
        *_down("total_ed_visits", column)
    )


def visits_with_previous_discharge(clean: Clean, columns=(), ignore_nulls: bool = False) -> DataFrame:
    """Visits of known patients beside the discharge of the patient's visit before.

    By default the directly preceding visit counts even when it has no discharge time;
    ``ignore_nulls`` looks back to the last visit that has one. Visits stored by patient (see
    ``sources.access``) are not shuffled.
    """
    needed = dict.fromkeys(["visit_id", "patient_id", "facility_id", "arrival_time", "discharge_time", *columns])
    by_patient = clean.get("ed_visits_by_patient")
    if by_patient is not None:
        return by_patient.previous("discharge_time", "previous_discharge_time", list(needed), ignore_nulls)
    visits = clean["ed_visits"].where(F.col("patient_id").isNotNull())
    return previous_value(
        visits.select(*needed), "patient_id", "arrival_time", "visit_id", "discharge_time",
        "previous_discharge_time", ignore_nulls=ignore_nulls,
    )


def return_sums(domain: Domain) -> dict[str, Column]:
    before, now = F.col("previous_discharge_time"), F.col("arrival_time")
    limit = F.timestamp_add("HOUR", F.lit(domain.return_window_hours), before)
    return {
        "visits_with_previous_discharge": F.count(before),
        "return_visits_in_window": F.count_if((now > before) & (now <= limit)),
    }


def with_return_rate(df: DataFrame) -> DataFrame:
    rate = pct(F.col("return_visits_in_window"), F.col("visits_with_previous_discharge"))
    return df.withColumn("return_percentage", rate)


def return_within_window(clean: Clean, domain: Domain, ignore_nulls: bool = False) -> DataFrame:
    visits = visits_with_previous_discharge(clean, ignore_nulls=ignore_nulls)
    sums = sums_by_dimension(visits, "facility_id", clean["facilities"], ["facility_name"], return_sums(domain))
    return with_return_rate(sums).orderBy(*_down("return_percentage", "facility_name"))


# The order of every answer: + ascending, - descending, # by the sequence of the wait bands. The columns without
# a descending metric name the row.
ORDERS = {
    "bq01_referrals_by_month_status": (referrals_by_month_status, "+referral_month +referral_status"),
    "bq02_backlog_by_department": (backlog_by_department, "-total_backlog +hospital_region +facility_name +department_name"),
    "bq03_backlog_bands": (backlog_bands, "+hospital_region #backlog_wait_band"),
    "bq04_first_appointment_target": (first_appointment_target, "+hospital_region +urgency"),
    "bq05_appointments_by_month_status": (appointments_by_month_status, "+scheduled_month +appointment_status"),
    "bq06_no_show_by_department": (no_show_by_department, "-no_show_rate_percentage +hospital_region +facility_name +department_name"),
    "bq07_wait_target_by_department": (wait_target_by_department, "+target_met_percentage +hospital_region +facility_name +department_name"),
    "bq08_no_show_by_channel": (no_show_by_channel, "-no_show_rate_percentage +booking_channel"),
    "bq09_no_show_by_quintile": (no_show_by_quintile, "+deprivation_quintile"),
    "bq10_ed_by_month_region": (ed_by_month_region, "+arrival_month +hospital_region"),
    "bq11_ed_length_of_stay": (ed_length_of_stay, "-average_length_of_stay_hours +hospital_region +facility_name"),
    "bq12_admission_and_left": (admission_and_left, "-total_ed_visits +hospital_region +facility_name"),
    "bq13_presenting_mix": (presenting_mix, "-total_ed_visits +presenting_group"),
    "bq14_return_within_window": (return_within_window, "-return_percentage +facility_name"),
    "iq01_extreme_months": (extreme_months, "+referral_year -total_referrals +referral_month"),
    "iq02_status_share": (status_share, "-total_referrals +referral_status"),
}


def order_columns(order: str) -> list[Column]:
    kinds = {"+": lambda c: F.col(c).asc_nulls_last(), "-": lambda c: F.col(c).desc_nulls_first(), "#": lambda c: band_order(F.col(c)).asc_nulls_last()}
    return [kinds[part[0]](part[1:]) for part in order.split()]


def row_names(order: str) -> list[str]:
    """The columns of an order that name a row, without its metrics."""
    return [part[1:] for part in order.split() if part[0] != "-" and not part.endswith("_percentage")]


def positions(clean: Clean, domain: Domain) -> DataFrame:
    """(question, position, row_name) of every row of every answer, in the question's order."""
    parts = []
    for name, (answer, order) in ORDERS.items():
        placed = with_position(answer(clean, domain), order_columns(order))
        label = F.concat_ws(" / ", *[F.col(c).cast("string") for c in row_names(order)])
        parts.append(placed.select(F.lit(name).alias("question"), "position", label.alias("row_name")))
    return reduce(DataFrame.unionByName, parts)
