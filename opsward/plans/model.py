"""Star schema over the clean layer and the KPI catalogue evaluated on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import month_name, month_of, pct, ratio_avg_2dp
from ..schemas import Domain
from . import questions as q
from .metrics import ACTIVITY
from .views import Clean, appointment_view, ed_visit_view, referral_view


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# Dimensions and facts

def dim_date(clean: Clean, facts: Sequence[str] = tuple(ACTIVITY)) -> DataFrame:
    """One row per day from the first to the last activity of the facts."""
    ends = _union(
        [
            clean[t].agg(F.min(c).cast("date").alias("a"), F.max(c).cast("date").alias("b"))
            for t, c in ACTIVITY.items() if t in facts
        ]
    ).agg(F.min("a").alias("a"), F.max("b").alias("b"))
    days = ends.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select(
        "date", F.year("date").alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month_number"),
        month_name(F.col("date"), padded=False).alias("month_name"), month_of(F.col("date")).alias("month_start"),
        (F.year("date") * 100 + F.month("date")).alias("month_sort"),
    )


def dim_facilities(clean: Clean) -> DataFrame:
    return clean["facilities"]


def dim_departments(clean: Clean) -> DataFrame:
    return clean["departments"]


def dim_patients(clean: Clean) -> DataFrame:
    return clean["patients"].select(
        "patient_id", "date_of_birth", "gender", "ethnicity", F.col("city").alias("patient_city"),
        "deprivation_quintile",
    )


def fact_referrals(clean: Clean, domain: Domain) -> DataFrame:
    return referral_view(clean, domain, {"departments"}).withColumn("date", F.col("referral_date"))


def fact_appointments(clean: Clean, domain: Domain) -> DataFrame:
    return appointment_view(clean, domain, {"departments"}).withColumn("date", F.col("scheduled_date"))


def fact_ed_visits(clean: Clean, domain: Domain) -> DataFrame:
    return ed_visit_view(clean, domain, ()).withColumn("date", F.col("arrival_date"))


def star_appointments(clean: Clean, domain: Domain) -> DataFrame:
    """Appointments by year, region and gender through all four dimensions.

    Counted per patient, department and year first; the larger dimensions join the aggregated rows. The days are
    those of the appointments, so no other fact is read.
    """
    fact = appointment_view(clean, domain, ()).withColumn("date", F.col("scheduled_date"))
    joined = (
        fact.join(dim_date(clean, ["appointments"]).select("date", "year"), "date", "left")
        .groupBy("patient_id", "department_id", "year")
        .agg(F.count("*").alias("appointments"), F.count_if("no_show_flag").alias("no_shows"))
        .join(dim_departments(clean).select("department_id", "facility_id"), "department_id", "left")
        .join(dim_facilities(clean).select("facility_id", "hospital_region"), "facility_id", "left")
        .join(dim_patients(clean).select("patient_id", "gender"), "patient_id", "left")
    )
    return joined.groupBy("year", "hospital_region", "gender").agg(
        F.sum("appointments").alias("appointments"), F.sum("no_shows").alias("no_shows")
    )


# KPI catalogue

@dataclass(frozen=True)
class Kpi:
    """A measure on one fact: a count, a rate of two counts, or an average over a count."""

    name: str
    fact: str
    kind: str
    numerator: Column
    denominator: Column


def kpi_catalogue() -> list[Kpi]:
    """The measures evaluated by one aggregate per fact; seven-day style returns are added separately."""
    one = F.count("*")
    eligible = F.col("attendance_eligible_flag")
    return [
        Kpi("Backlog referrals", "referrals", "count", F.count_if("backlog_flag"), one),
        Kpi("Average backlog wait days", "referrals", "average", F.sum("backlog_wait_days"), F.count("backlog_wait_days")),
        Kpi("Backlog over target %", "referrals", "rate", F.count_if("backlog_over_target_flag"), F.count("backlog_over_target_flag")),
        Kpi("No-show rate %", "appointments", "rate", F.count_if(eligible & F.col("no_show_flag")), F.count_if(eligible)),
        Kpi("Average appointment wait minutes", "appointments", "average", F.sum("waiting_minutes"), F.count("waiting_minutes")),
        Kpi("Seen within target %", "appointments", "rate", F.count_if("met_wait_target_flag"), F.count("met_wait_target_flag")),
        Kpi("Average ED length of stay hours", "ed_visits", "average", F.sum("length_of_stay_hours"), F.count("length_of_stay_hours")),
        Kpi("Admission rate %", "ed_visits", "rate", F.count_if("admitted_flag"), one),
        Kpi("Left before treatment %", "ed_visits", "rate", F.count_if("left_before_treatment_flag"), one),
    ]


def _kpi_value(kind: str, numerator: Column, denominator: Column) -> Column:
    if kind == "rate":
        return pct(numerator.cast("long"), denominator)
    if kind == "average":
        return ratio_avg_2dp(numerator, denominator)
    return numerator.cast("double")


def _kpi_entries(kpis: Sequence[Kpi]) -> list[Column]:
    """One row per KPI from the columns n0, d0, n1, d1 ... of its numerator and denominator."""
    return [
        F.struct(
            F.lit(k.name).alias("kpi_name"),
            F.coalesce(F.col(f"n{i}"), F.lit(0)).cast("decimal(28,2)").alias("numerator"),
            F.col(f"d{i}").alias("denominator"),
            _kpi_value(k.kind, F.col(f"n{i}"), F.col(f"d{i}")).alias("kpi_value"),
        )
        for i, k in enumerate(kpis)
    ]


def evaluate_kpis(facts: Mapping[str, DataFrame], kpis: Sequence[Kpi], by: Sequence[str] = ()) -> DataFrame:
    """(by..., kpi_name, numerator, denominator, kpi_value); every fact is aggregated once."""
    parts = []
    for fact in dict.fromkeys(k.fact for k in kpis):
        own = [k for k in kpis if k.fact == fact]
        aggregates = []
        for i, k in enumerate(own):
            aggregates += [k.numerator.alias(f"n{i}"), k.denominator.alias(f"d{i}")]
        entries = _kpi_entries(own)
        grouped = facts[fact].groupBy(*by).agg(*aggregates) if by else facts[fact].agg(*aggregates)
        parts.append(grouped.select(*by, F.inline(F.array(*entries))))
    return _union(parts)


def all_kpis(clean: Clean, domain: Domain) -> DataFrame:
    """Network value of the ten KPIs."""
    facts = {
        "referrals": fact_referrals(clean, domain), "appointments": fact_appointments(clean, domain),
        "ed_visits": fact_ed_visits(clean, domain),
    }
    returns = q.visits_with_previous_discharge(clean)
    return evaluate_kpis({**facts, "returns": returns}, [*kpi_catalogue(), return_kpi(domain)])


def _apply(df: DataFrame, filters: Mapping[str, object], without: frozenset[str] = frozenset()) -> DataFrame:
    """Equality or (from, to) range filters, applied before any aggregation; an unknown column is an error."""
    for column, wanted in filters.items():
        if column in without:
            continue
        if column not in df.columns:
            raise ValueError(f"no column {column!r} to filter by")
        condition = F.col(column).between(*[F.lit(v) for v in wanted]) if isinstance(wanted, tuple) else F.col(column) == wanted
        df = df.where(condition)
    return df


def fact_returns(clean: Clean, domain: Domain) -> DataFrame:
    """Visits beside the discharge before them, with their place and date.

    The visit before is looked for among all visits; filters come after it, or a slice would cut the history.
    """
    visits = q.visits_with_previous_discharge(clean).withColumn("date", F.col("arrival_time").cast("date"))
    places = clean["facilities"].select("facility_id", "hospital_region", "facility_name")
    return visits.join(places, "facility_id", "left")


def return_kpi(domain: Domain) -> Kpi:
    sums = q.return_sums(domain)
    return Kpi("ED return %", "returns", "rate", sums["return_visits_in_window"], sums["visits_with_previous_discharge"])


def cards() -> list[Kpi]:
    """Further measures of the dashboard's pages."""
    oldest = F.col("backlog_wait_band") == schemas.LAST_WAIT_BAND
    return [
        Kpi("Backlog over 60 days %", "referrals", "rate", F.count_if(F.col("backlog_flag") & oldest), F.count_if("backlog_flag")),
        Kpi("Total ED visits", "ed_visits", "count", F.count("*"), F.count("*")),
    ]


def sliced_kpis(clean: Clean, domain: Domain, filters: Mapping[str, object]) -> DataFrame:
    """The ten KPIs and the cards under date, region, facility and department filters.

    The department does not touch ED visits. Filters on counted facts reach the scan.
    """
    place = {"departments", "facilities"}
    facts = {
        "referrals": referral_view(clean, domain, place).withColumn("date", F.col("referral_date")),
        "appointments": appointment_view(clean, domain, place).withColumn("date", F.col("scheduled_date")),
        "ed_visits": ed_visit_view(clean, domain, {"facilities"}).withColumn("date", F.col("arrival_date")),
        "returns": fact_returns(clean, domain),
    }
    department = frozenset({"department_id", "department_name", "specialty_group"})
    sliced = {name: _apply(df, filters, department if name in ("ed_visits", "returns") else frozenset()) for name, df in facts.items()}
    return evaluate_kpis(sliced, [*kpi_catalogue(), return_kpi(domain), *cards()])


#: What the measures are broken down by; ED visits have no department.
LEVELS = {
    "network": (), "region": ("hospital_region",), "facility": ("hospital_region", "facility_name"), "department": q.PLACE,
    "month": ("month_start",), "region and month": ("hospital_region", "month_start"),
}


def kpis_by_level(clean: Clean, domain: Domain, levels: Mapping[str, Sequence[str]] = LEVELS) -> DataFrame:
    """(level, place and month columns, kpi_name, numerator, denominator, kpi_value) of the additive KPIs.

    Each fact is read once: it is counted per department or facility and month, the counts get their names, and
    grouping sets add them up for all levels.
    """
    facilities = clean["facilities"].select("facility_id", "hospital_region", "facility_name")
    sources = {
        "referrals": (fact_referrals(clean, domain), "department_id", q.department_places(clean)),
        "appointments": (fact_appointments(clean, domain), "department_id", q.department_places(clean)),
        "ed_visits": (fact_ed_visits(clean, domain), "facility_id", facilities),
    }
    parts = []
    for fact, (df, key, places) in sources.items():
        own = [k for k in (*kpi_catalogue(), *cards()) if k.fact == fact]
        sums = {f"n{i}": k.numerator for i, k in enumerate(own)} | {f"d{i}": k.denominator for i, k in enumerate(own)}
        counted = df.groupBy(key, month_of(F.col("date")).alias("month_start")).agg(*[c.alias(n) for n, c in sums.items()])
        named = counted.join(places, key, "left")
        names = [c for c in (*q.PLACE, "month_start") if c in named.columns]
        sets = {level: [c for c in columns if c in names] for level, columns in levels.items() if set(columns) <= set(names)}
        grouping = {level: sum((c not in columns) << (len(names) - 1 - i) for i, c in enumerate(names)) for level, columns in sets.items()}
        totals = named.groupingSets([[F.col(c) for c in columns] for columns in sets.values()], *names).agg(
            F.grouping_id().alias("__level"), *[F.sum(n).alias(n) for n in sums]
        )
        level = F.create_map(*[x for name, number in grouping.items() for x in (F.lit(number).cast("long"), F.lit(name))])[F.col("__level")]
        parts.append(totals.select(level.alias("level"), *names, F.inline(F.array(*_kpi_entries(own)))))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


MATRIX_SUMS = (
    "backlog", "backlog_with_target", "backlog_over_target", "attendance_eligible", "no_shows",
    "wait_with_target", "within_wait_target",
)


def performance_matrix(clean: Clean, domain: Domain) -> DataFrame:
    """Region, facility and department with subtotals and a grand total.

    Both facts are reduced to one row per department before the names are joined and rolled up.
    """
    waiting = F.col("backlog_flag")
    referrals = referral_view(clean, domain, {"departments"}).groupBy("department_id").agg(
        F.count_if(waiting).alias("backlog"),
        F.count("backlog_over_target_flag").alias("backlog_with_target"),
        F.count_if("backlog_over_target_flag").alias("backlog_over_target"),
    )
    eligible = F.col("attendance_eligible_flag")
    appointments = appointment_view(clean, domain, {"departments"}).groupBy("department_id").agg(
        F.count_if(eligible).alias("attendance_eligible"),
        F.count_if(eligible & F.col("no_show_flag")).alias("no_shows"),
        F.count("met_wait_target_flag").alias("wait_with_target"),
        F.count_if("met_wait_target_flag").alias("within_wait_target"),
    )
    per_department = referrals.unionByName(appointments, allowMissingColumns=True)
    named = per_department.join(q.department_places(clean), "department_id", "left")
    sums = named.rollup(*q.PLACE).agg(
        F.grouping_id().alias("grouping_level"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in MATRIX_SUMS],
    )
    return sums.withColumns(
        {
            "over_target_percentage": pct(F.col("backlog_over_target"), F.col("backlog_with_target")),
            "no_show_rate_percentage": pct(F.col("no_shows"), F.col("attendance_eligible")),
            "seen_within_target_percentage": pct(F.col("within_wait_target"), F.col("wait_with_target")),
        }
    )


def composition(clean: Clean, domain: Domain) -> DataFrame:
    """Share of visits per disposition and per presenting group."""
    parts = []
    for column in ("disposition", "presenting_group"):
        mix = q.presenting_mix(clean, domain, column)
        parts.append(
            mix.select(
                F.lit(column).alias("category"), F.col(column).alias("category_value"), "total_ed_visits",
                "percentage_of_ed_visits",
            )
        )
    return _union(parts)


def reconcile_measures(clean: Clean, domain: Domain) -> DataFrame:
    """Unfiltered measures against totals summed up from their breakdown by place.

    A fact is read once. Its counts per department or facility are taken twice from there: as they are, and through
    the joins with the names, where a missing or repeated parent would show.
    """
    waited = F.col("attendance_eligible_flag") & F.col("no_show_flag")
    facilities = clean["facilities"].select("facility_id", "hospital_region", "facility_name")
    sources = [
        (
            fact_referrals(clean, domain), "department_id", q.department_places(clean),
            {"Backlog referrals": F.count_if("backlog_flag"), "Backlog over target %": F.count_if("backlog_over_target_flag")},
        ),
        (
            fact_appointments(clean, domain), "department_id", q.department_places(clean),
            {"No-show rate %": F.count_if(waited), "Seen within target %": F.count_if("met_wait_target_flag")},
        ),
        (
            fact_ed_visits(clean, domain), "facility_id", facilities,
            {"Admission rate %": F.count_if("admitted_flag"), "Left before treatment %": F.count_if("left_before_treatment_flag")},
        ),
    ]
    parts = []
    for fact, key, places, measures in sources:
        columns = {f"m{i}": name for i, name in enumerate(measures)}
        counted = fact.groupBy(key).agg(*[c.alias(f"m{i}") for i, c in enumerate(measures.values())])
        both = counted.withColumn("side", F.explode(F.array(F.lit("measured"), F.lit("independent"))))
        named = both.join(
            places.withColumnRenamed(key, "__key"), (F.col(key) == F.col("__key")) & (F.col("side") == "independent"), "left"
        )
        groups = [c for c in q.PLACE if c in places.columns]
        breakdown = named.groupBy("side", *groups).agg(*[F.sum(c).alias(c) for c in columns])
        sides = breakdown.groupBy().pivot("side", ["measured", "independent"]).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])
        entries = [
            F.struct(F.lit(name).alias("measure_name"), F.col(f"measured_{c}").alias("measured"), F.col(f"independent_{c}").alias("independent"))
            for c, name in columns.items()
        ]
        parts.append(sides.select(F.inline(F.array(*entries))))
    return _union(parts).withColumn("difference", F.col("measured") - F.col("independent")).withColumn(
        "validation_status", F.when(F.col("measured").eqNullSafe(F.col("independent")), "PASS").otherwise("REVIEW")
    )
