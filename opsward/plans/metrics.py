"""Further metrics: growth, rates per day, concentration, spread, percentiles and flows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Sequence
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import half_up_div, hundredths, month_of, pct, ratio_avg_2dp
from ..operators.rollups import sums_by_dimension
from ..operators.shares import cumulative_share, exact_percentiles, top_n_share
from ..schemas import Domain
from . import questions as q
from .views import Clean, appointment_view, ed_visit_view, referral_view

ACTIVITY = {"referrals": "referral_date", "appointments": "scheduled_datetime", "ed_visits": "arrival_time"}
PERCENTILES = {"median": Fraction(1, 2), "percentile_90": Fraction(9, 10)}


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def monthly_counts(clean: Clean, fact: str) -> DataFrame:
    """One row per calendar month with activity."""
    month = month_of(F.col(ACTIVITY[fact])).alias("month_start")
    return clean[fact].groupBy(month).agg(F.count("*").alias("records"))


def month_spine(months: DataFrame) -> DataFrame:
    """All months between the first and the last one, those without activity with zero records."""
    ends = months.agg(F.min("month_start").alias("a"), F.max("month_start").alias("b"))
    spine = ends.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    return spine.join(months, "month_start", "left").fillna(0, subset=["records"])


def growth_same_months(
    clean: Clean, base_year: int, months: Collection[int], excluded: Collection[int] = (), facts=("referrals", "appointments")
) -> DataFrame:
    """Growth between the same months of two consecutive years, with outlier months left out on request."""
    kept = sorted(set(months) - set(excluded))
    parts = []
    for fact in facts:
        counts = monthly_counts(clean, fact).where(F.month("month_start").isin(*kept))
        in_year = [
            F.coalesce(F.sum(F.when(F.year("month_start") == y, F.col("records"))), F.lit(0)).alias(name)
            for y, name in ((base_year, "base_records"), (base_year + 1, "later_records"))
        ]
        parts.append(
            counts.agg(*in_year).select(
                F.lit(fact).alias("fact_name"), F.lit(", ".join(map(str, kept))).alias("months"),
                "base_records", "later_records",
                pct(F.col("later_records") - F.col("base_records"), F.col("base_records")).alias("growth_percentage"),
            )
        )
    return _union(parts)


def daily_rates(clean: Clean, fact: str = "referrals") -> DataFrame:
    """Records per month and per calendar day of the month, beside the average month."""
    months = monthly_counts(clean, fact)
    days = F.dayofmonth(F.last_day("month_start"))
    average = months.agg(ratio_avg_2dp(F.sum("records"), F.count("*"))).scalar()
    return months.select(
        "month_start", "records", days.alias("days_in_month"),
        ratio_avg_2dp(F.col("records"), days.cast("long")).alias("records_per_day"),
        average.alias("average_per_month"),
    )


def concentration(clean: Clean, domain: Domain, n: int = 10) -> DataFrame:
    """Share of the backlog and of the no-shows that the n largest departments hold."""
    events = {
        "backlog": referral_view(clean, domain, ()).where("backlog_flag"),
        "no-shows": appointment_view(clean, domain, ()).where("no_show_flag"),
    }
    parts = []
    for measure, rows in events.items():
        counts = rows.groupBy("department_id").agg(F.count("*").alias("records"))
        shares = top_n_share(counts, "records", ["department_id"], n)
        parts.append(shares.select(F.lit(measure).alias("measure"), *shares.columns))
    return _union(parts)


def oldest_band_share(clean: Clean, domain: Domain) -> DataFrame:
    """Share of the backlog in the oldest band per region and for the network."""
    oldest = F.count_if(F.col("backlog_wait_band") == schemas.LAST_WAIT_BAND)
    regions = sums_by_dimension(
        referral_view(clean, domain, ()).where("backlog_flag"), "department_id", q.department_places(clean),
        ["hospital_region"], {"backlog": F.count("*"), "over_60_days": oldest},
    )
    totals = regions.rollup("hospital_region").agg(
        F.sum("backlog").alias("backlog"), F.sum("over_60_days").alias("over_60_days"),
        F.when(F.grouping("hospital_region") == 1, "network").otherwise("region").alias("level"),
    )
    return totals.withColumn("over_60_percentage", pct(F.col("over_60_days"), F.col("backlog")))


def specialty_performance(clean: Clean, domain: Domain) -> DataFrame:
    """Attendance and clinic waits per department name and for the network, from one scan."""
    view = appointment_view(clean, domain, {"departments"})
    eligible = F.col("attendance_eligible_flag")
    measures = {
        "eligible_appointments": F.count_if(eligible),
        "no_show_appointments": F.count_if(eligible & F.col("no_show_flag")),
        "appointments_with_wait_time": F.count("waiting_minutes"),
        "minutes": F.sum("waiting_minutes"),
        "target_eligible_appointments": F.count("met_wait_target_flag"),
        "appointments_within_target": F.count_if("met_wait_target_flag"),
    }
    specialties = view.groupBy("department_name").agg(*[c.alias(n) for n, c in measures.items()])
    sums = specialties.rollup("department_name").agg(
        F.when(F.grouping("department_name") == 1, "network").otherwise("specialty").alias("level"),
        *[F.sum(n).alias(n) for n in measures],
    )
    return sums.withColumns(
        {
            "no_show_rate_percentage": pct(F.col("no_show_appointments"), F.col("eligible_appointments")),
            "average_waiting_minutes": ratio_avg_2dp(F.col("minutes"), F.col("appointments_with_wait_time")),
            "target_met_percentage": pct(F.col("appointments_within_target"), F.col("target_eligible_appointments")),
        }
    ).drop("minutes")


def target_by_urgency(clean: Clean, domain: Domain) -> DataFrame:
    """First-appointment performance per urgency, with the weakest region's rate beside it."""
    regional = q.first_appointment_target(clean, domain)
    weakest = regional.groupBy("urgency").agg(F.min("target_met_percentage").alias("weakest_region_percentage"))
    return q.first_appointment_target(clean, domain, ["urgency"]).join(weakest, "urgency", "left")


def avoidable_no_shows(rates: DataFrame, group: str) -> DataFrame:
    """No-shows that would not have happened at the best group's rate, exact to two decimals."""
    n, missed = F.col("eligible_appointments"), F.col("no_show_appointments")
    ratio = missed.cast("double") / n.cast("double")
    # The groups are the few values of one category, so a window over all of them is small.
    best = F.min_by(F.struct(n, missed), F.struct(ratio, F.col(group))).over(Window.partitionBy(F.lit(group)))
    rates = rates.withColumn("best", best)
    best_n, best_missed = F.col("best.eligible_appointments"), F.col("best.no_show_appointments")
    wide = "decimal(19,0)"
    surplus = missed.cast(wide) * best_n.cast(wide) - n.cast(wide) * best_missed.cast(wide)
    avoidable = half_up_div((surplus * 100).cast("decimal(38,0)"), best_n.cast("decimal(38,0)")).cast("double") / 100
    return rates.select(
        F.lit(group).alias("group_name"), F.col(group).cast("string").alias("group_value"), n, missed,
        "no_show_rate_percentage", avoidable.alias("avoidable_no_shows"),
    )


def avoidable(clean: Clean, domain: Domain) -> DataFrame:
    return _union(
        [
            avoidable_no_shows(q.no_show_by_channel(clean, domain), "booking_channel"),
            avoidable_no_shows(q.no_show_by_quintile(clean, domain), "deprivation_quintile"),
        ]
    )


def rate_spreads(rates: DataFrame, measures: dict[str, tuple[str, int]]) -> DataFrame:
    """Lowest and highest group rate and their distance.

    ``measures`` maps a rate column to its label and to the parts of the rate's unit to show.
    """
    ends = [e for rate in measures for e in (F.min(rate).alias(f"{rate}_low"), F.max(rate).alias(f"{rate}_high"))]
    entries = []
    for rate, (label, unit) in measures.items():
        low, high = F.col(f"{rate}_low"), F.col(f"{rate}_high")
        spread = ((hundredths(high) - hundredths(low)) * unit).cast("double") / 100
        entries.append(
            F.struct(F.lit(label).alias("measure"), low.alias("lowest"), high.alias("highest"), spread.alias("spread"))
        )
    return rates.agg(*ends).select(F.inline(F.array(*entries)))


def spreads(clean: Clean, domain: Domain) -> DataFrame:
    known = F.col("facility_name").isNotNull()
    stays = q.ed_length_of_stay(clean, domain).where(known)
    left = q.admission_and_left(clean, domain).where(known)
    departments = q.no_show_by_department(clean, domain)
    regions = departments.where(F.col("hospital_region").isNotNull()).groupBy("hospital_region").agg(
        F.sum("no_show_appointments").alias("missed"), F.sum("eligible_appointments").alias("eligible")
    ).withColumn("rate", pct(F.col("missed"), F.col("eligible")))
    return _union(
        [
            rate_spreads(stays, {"average_length_of_stay_hours": ("facility length of stay, minutes", 60)}),
            rate_spreads(
                left,
                {
                    "left_before_treatment_percentage": ("facility left before treatment, points", 1),
                    "admission_rate_percentage": ("facility admission rate, points", 1),
                },
            ),
            rate_spreads(regions, {"rate": ("region no-show rate, points", 1)}),
        ]
    )


def month_over_month(clean: Clean, fact: str = "appointments") -> DataFrame:
    """Each month beside the month before and the same month a year before; months form a gapless line."""
    line = Window.orderBy("month_start")
    months = month_spine(monthly_counts(clean, fact)).withColumns(
        {
            "previous_month_records": F.lag("records", 1).over(line),
            "same_month_last_year_records": F.lag("records", 12).over(line),
        }
    )
    return months.withColumns(
        {
            "change_percentage": pct(F.col("records") - F.col("previous_month_records"), F.col("previous_month_records")),
            "year_change_percentage": pct(
                F.col("records") - F.col("same_month_last_year_records"), F.col("same_month_last_year_records")
            ),
        }
    )


def outside_window(clean: Clean, end: dt.date) -> DataFrame:
    """Appointments after the documented activity window, by status."""
    later = clean["appointments"].where(F.col("scheduled_datetime").cast("date") > F.lit(end))
    return later.groupBy("appointment_status").agg(
        F.count("*").alias("records_outside_window"),
        F.min(F.col("scheduled_datetime").cast("date")).alias("first_date"),
        F.max(F.col("scheduled_datetime").cast("date")).alias("last_date"),
    )


def presenting_pareto(clean: Clean, domain: Domain) -> DataFrame:
    mix = q.presenting_mix(clean, domain)
    return cumulative_share(mix, "total_ed_visits", "presenting_group", "cumulative_percentage")


def wait_percentiles(clean: Clean, domain: Domain) -> DataFrame:
    """Median and 90th percentile of clinic waits per department and of stays per facility."""
    waits = appointment_view(clean, domain, ()).select("department_id", "waiting_minutes")
    stays = ed_visit_view(clean, domain, ()).select("facility_id", "length_of_stay_hours")
    parts = []
    for measure, df, value, key in (
        ("waiting_minutes", waits, "waiting_minutes", "department_id"),
        ("length_of_stay_hours", stays, "length_of_stay_hours", "facility_id"),
    ):
        found = exact_percentiles(df, value, [key], PERCENTILES)
        parts.append(found.select(F.lit(measure).alias("measure"), F.col(key).alias("group_id"), "n", *PERCENTILES))
    return _union(parts)


def missing_populations(clean: Clean, domain: Domain) -> DataFrame:
    """Records that a segment cannot place, to be reported beside the segments."""
    eligible = appointment_view(clean, domain, ()).where("attendance_eligible_flag")
    by_quintile = sums_by_dimension(
        eligible, "patient_id", clean["patients"], ["deprivation_quintile"], {"records": F.count("*")}
    )
    parts = [
        by_quintile.where(F.col("deprivation_quintile").isNull()).agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records"))
        .select(F.lit("attendance-eligible appointments without quintile").alias("population"), "records"),
        clean["ed_visits"].agg(F.count_if(F.col("facility_id").isNull()).alias("records"))
        .select(F.lit("ED visits without facility").alias("population"), "records"),
        clean["referrals"].agg(F.count_if(F.col("department_id").isNull()).alias("records"))
        .select(F.lit("referrals without department").alias("population"), "records"),
    ]
    return _union(parts)


def arrivals_by_hour(clean: Clean) -> DataFrame:
    """ED arrivals per weekday (Monday is 1) and hour."""
    arrival = F.col("arrival_time")
    return clean["ed_visits"].groupBy(
        (F.weekday(arrival) + 1).alias("iso_weekday"), F.hour(arrival).alias("arrival_hour")
    ).agg(F.count("*").alias("total_ed_visits"))


def return_by_segment(clean: Clean, domain: Domain) -> DataFrame:
    """Return rate for the network and by condition, triage, disposition, quintile and age in the arrival year."""
    columns = ["presenting_group", "triage_category", "disposition"]
    visits = q.visits_with_previous_discharge(clean, columns)
    people = clean["patients"].select("patient_id", "deprivation_quintile", "date_of_birth")
    # Counted per patient and year first, so the patient join sees aggregated rows.
    keys = ["patient_id", F.year("arrival_time").alias("arrival_year"), *columns]
    sums = q.return_sums(domain)
    per_patient = visits.groupBy(*keys).agg(*[c.alias(n) for n, c in sums.items()]).join(people, "patient_id", "left")
    age = F.col("arrival_year") - F.year("date_of_birth")
    decade = F.call_function("div", age, F.lit(10)) * 10
    segments = {
        "network": F.lit("all"),
        "presenting_group": F.col("presenting_group"),
        "triage_category": F.col("triage_category").cast("string"),
        "disposition": F.col("disposition"),
        "deprivation_quintile": F.col("deprivation_quintile").cast("string"),
        "age_band": F.concat(decade.cast("string"), F.lit("s")),
    }
    entries = [F.struct(F.lit(n).alias("segment"), c.alias("segment_value")) for n, c in segments.items()]
    stacked = per_patient.select(F.inline(F.array(*entries)), *sums)
    totals = stacked.groupBy("segment", "segment_value").agg(*[F.sum(n).alias(n) for n in sums])
    return q.with_return_rate(totals)


def backlog_flow(clean: Clean) -> DataFrame:
    """Referrals received and closed per month and the running difference."""
    received = monthly_counts(clean, "referrals").withColumnRenamed("records", "new_referrals")
    closed = (
        clean["referrals"].where(F.col("closed_date").isNotNull())
        .groupBy(month_of(F.col("closed_date")).alias("month_start"))
        .agg(F.count("*").alias("closed_referrals"))
    )
    months = received.join(closed, "month_start", "full").fillna(0, subset=["new_referrals", "closed_referrals"])
    running = Window.orderBy("month_start").rowsBetween(Window.unboundedPreceding, 0)
    net: Column = F.col("new_referrals") - F.col("closed_referrals")
    return months.withColumn("net_change", net).withColumn("running_net", F.sum("net_change").over(running))
