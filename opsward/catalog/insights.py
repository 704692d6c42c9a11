"""Registered views, business questions, documented metrics and model queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..plans import metrics as m
from ..plans import model
from ..plans import questions as q
from ..plans import sketches, views
from .oracle import avg2, n, n_if, pct, union_all
from .registry import REGISTRY, query

# Views

REFERRAL_COLUMNS = (
    "referral_id", "patient_id", "department_id", "facility_id", "facility_name", "hospital_region", "facility_city",
    "department_name", "specialty_group", "referral_date", "urgency", "referral_status", "referral_source",
    "priority_score", "first_appointment_date", "closed_date", "date_of_birth", "gender", "ethnicity", "patient_city",
    "deprivation_quintile", "target_days", "days_to_first_appointment", "first_appointment_met_target_flag",
    "backlog_flag", "snapshot_date", "backlog_wait_days", "backlog_wait_band", "backlog_over_target_flag",
)
APPOINTMENT_COLUMNS = (
    "appointment_id", "referral_id", "patient_id", "department_id", "facility_id", "facility_name", "hospital_region",
    "facility_city", "department_name", "specialty_group", "scheduled_datetime", "scheduled_date", "scheduled_month",
    "check_in_time", "seen_time", "appointment_status", "appointment_type", "booking_channel", "gender", "ethnicity",
    "patient_city", "deprivation_quintile", "appointment_wait_target_mins", "waiting_minutes",
    "attendance_eligible_flag", "completed_flag", "no_show_flag", "wait_time_eligible_flag", "met_wait_target_flag",
    "patient_id_issue_flag", "department_id_issue_flag", "referral_id_issue_flag", "status_timestamp_issue_flag",
    "timeline_issue_flag",
)
ED_COLUMNS = (
    "visit_id", "patient_id", "facility_id", "facility_name", "hospital_region", "facility_city", "facility_type",
    "arrival_time", "arrival_date", "arrival_month", "discharge_time", "triage_category", "disposition",
    "admitted_flag", "presenting_group", "gender", "ethnicity", "patient_city", "deprivation_quintile",
    "length_of_stay_hours", "length_of_stay_eligible_flag", "left_before_treatment_flag", "patient_id_issue_flag",
    "facility_id_issue_flag", "triage_category_issue_flag", "missing_discharge_time_flag", "timeline_issue_flag",
    "admission_consistency_issue_flag",
)


@query("av01_referral_view", f"SELECT {', '.join(REFERRAL_COLUMNS)} FROM v_referral")
def _(w):
    return views.referral_view(w.clean, w.domain).select(*REFERRAL_COLUMNS)


@query("av02_appointment_view", f"SELECT {', '.join(APPOINTMENT_COLUMNS)} FROM v_appointment")
def _(w):
    return views.appointment_view(w.clean, w.domain).select(*APPOINTMENT_COLUMNS)


@query("av03_ed_view", f"SELECT {', '.join(ED_COLUMNS)} FROM v_ed")
def _(w):
    return views.ed_visit_view(w.clean, w.domain).select(*ED_COLUMNS)


# Business questions

@query("bq01_referrals_by_month_status", f"""
SELECT date_trunc('month', referral_date)::DATE AS referral_month, referral_status, {n()} AS total_referrals
FROM v_referral GROUP BY 1, 2""")
def _(w):
    return q.referrals_by_month_status(w.clean, w.domain)


_over = "count(*) FILTER (WHERE backlog_over_target_flag)"


@query("bq02_backlog_by_department", f"""
SELECT hospital_region, facility_name, department_name, {n()} AS total_backlog,
  {avg2('sum(backlog_wait_days)', 'count(*)')} AS average_wait_days,
  {n('backlog_over_target_flag')} AS target_eligible_referrals, {n_if('backlog_over_target_flag')} AS referrals_over_target,
  {pct(_over, 'count(backlog_over_target_flag)')} AS over_target_percentage
FROM v_referral WHERE backlog_flag GROUP BY ALL""")
def _(w):
    return q.backlog_by_department(w.clean, w.domain)


@query("bq03_backlog_bands", f"""
SELECT hospital_region, backlog_wait_band, {n()} AS referral_count FROM v_referral WHERE backlog_flag GROUP BY 1, 2""")
def _(w):
    return q.backlog_bands(w.clean, w.domain)


_met = "count(*) FILTER (WHERE first_appointment_met_target_flag)"


@query("bq04_first_appointment_target", f"""
SELECT hospital_region, urgency, {n()} AS referrals_with_known_target,
  {avg2('sum(days_to_first_appointment)', 'count(*)')} AS average_days_to_first_appointment,
  {n_if('first_appointment_met_target_flag')} AS referrals_within_target, {pct(_met, 'count(*)')} AS target_met_percentage
FROM v_referral WHERE first_appointment_met_target_flag IS NOT NULL GROUP BY 1, 2""")
def _(w):
    return q.first_appointment_target(w.clean, w.domain)


@query("bq05_appointments_by_month_status", f"""
SELECT scheduled_month, appointment_status, {n()} AS appointment_count FROM v_appointment GROUP BY 1, 2""")
def _(w):
    return q.appointments_by_month_status(w.clean, w.domain)


_no_show = f"""{n()} AS eligible_appointments, {n_if('no_show_flag')} AS no_show_appointments,
  {pct('count(*) FILTER (WHERE no_show_flag)', 'count(*)')} AS no_show_rate_percentage"""


@query("bq06_no_show_by_department", f"""
SELECT hospital_region, facility_name, department_name, {_no_show} FROM v_appointment WHERE attendance_eligible_flag GROUP BY ALL""")
def _(w):
    return q.no_show_by_department(w.clean, w.domain)


_within = "count(*) FILTER (WHERE met_wait_target_flag)"
_wait = f"""{n()} AS appointments_with_wait_time, {avg2('sum(wait_h)', 'count(*)', 2)} AS average_waiting_minutes,
  {n('met_wait_target_flag')} AS target_eligible_appointments, {n_if('met_wait_target_flag')} AS appointments_within_target,
  {pct(_within, 'count(met_wait_target_flag)')} AS target_met_percentage"""


@query("bq07_wait_target_by_department", f"""
SELECT hospital_region, facility_name, department_name, {_wait} FROM v_appointment WHERE wait_time_eligible_flag GROUP BY ALL""")
def _(w):
    return q.wait_target_by_department(w.clean, w.domain)


@query("bq08_no_show_by_channel", f"""
SELECT booking_channel, {_no_show} FROM v_appointment WHERE attendance_eligible_flag GROUP BY 1""")
def _(w):
    return q.no_show_by_channel(w.clean, w.domain)


@query("bq09_no_show_by_quintile", f"""
SELECT deprivation_quintile, {_no_show} FROM v_appointment
WHERE attendance_eligible_flag AND deprivation_quintile IS NOT NULL GROUP BY 1""")
def _(w):
    return q.no_show_by_quintile(w.clean, w.domain)


@query("bq10_ed_by_month_region", f"""
SELECT arrival_month, hospital_region, {n()} AS total_ed_visits FROM v_ed GROUP BY 1, 2""")
def _(w):
    return q.ed_by_month_region(w.clean, w.domain)


@query("bq11_ed_length_of_stay", f"""
SELECT hospital_region, facility_name, {n()} AS eligible_ed_visits,
  {avg2('sum(stay_h)', 'count(*)', 2)} AS average_length_of_stay_hours, max(stay_h) / 100::DOUBLE AS longest_length_of_stay_hours
FROM v_ed WHERE length_of_stay_eligible_flag GROUP BY 1, 2""")
def _(w):
    return q.ed_length_of_stay(w.clean, w.domain)


@query("bq12_admission_and_left", f"""
SELECT hospital_region, facility_name, {n()} AS total_ed_visits, {n_if('admitted_flag')} AS admitted_visits,
  {pct('count(*) FILTER (WHERE admitted_flag)', 'count(*)')} AS admission_rate_percentage,
  {n_if('left_before_treatment_flag')} AS left_before_treatment_visits,
  {pct('count(*) FILTER (WHERE left_before_treatment_flag)', 'count(*)')} AS left_before_treatment_percentage
FROM v_ed GROUP BY 1, 2""")
def _(w):
    return q.admission_and_left(w.clean, w.domain)


@query("bq13_presenting_mix", f"""
SELECT presenting_group, c AS total_ed_visits, {pct('c', '(sum(c) OVER ())')} AS percentage_of_ed_visits
FROM (SELECT presenting_group, {n()} AS c FROM v_ed GROUP BY 1)""")
def _(w):
    return q.presenting_mix(w.clean, w.domain)


_return = f"""{n('previous_discharge_time')} AS visits_with_previous_discharge, {n_if('returned')} AS return_visits_in_window,
  {pct('count(*) FILTER (WHERE returned)', 'count(previous_discharge_time)')} AS return_percentage"""


@query("bq14_return_within_window", f"SELECT facility_name, {_return} FROM v_return GROUP BY 1")
def _(w):
    return q.return_within_window(w.clean, w.domain)


# Insight queries

@query("iq01_extreme_months", f"""
WITH months AS (SELECT date_trunc('month', referral_date)::DATE AS m, {n()} AS c FROM v_referral GROUP BY 1),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY year(m) ORDER BY c) AS low, dense_rank() OVER (PARTITION BY year(m) ORDER BY c DESC) AS high FROM months)
SELECT year(m)::BIGINT AS referral_year, rpad(strftime(m, '%B'), 9, ' ') AS referral_month, c AS total_referrals,
  CASE WHEN high = 1 THEN 'Highest' ELSE 'Lowest' END AS result_type FROM ranked WHERE high = 1 OR low = 1""")
def _(w):
    return q.extreme_months(w.clean, w.domain)


@query("iq02_status_share", f"""
SELECT referral_status, c AS total_referrals, {pct('c', '(sum(c) OVER ())')} AS share_percentage
FROM (SELECT referral_status, {n()} AS c FROM v_referral GROUP BY 1)""")
def _(w):
    return q.status_share(w.clean, w.domain)


@query("iq03_backlog_network", f"""
SELECT {n()} AS total_backlog_referrals, {n('backlog_over_target_flag')} AS target_eligible_referrals,
  {n_if('backlog_over_target_flag')} AS referrals_over_target,
  {pct(_over, 'count(backlog_over_target_flag)')} AS network_over_target_percentage
FROM v_referral WHERE backlog_flag""")
def _(w):
    return q.backlog_network(w.clean, w.domain)


# Documented metrics

_YEARS = (1999, 2000)


def _growth(fact: str, time: str, months: str) -> str:
    return f"""SELECT '{fact}' AS fact_name, '{months}' AS months, a AS base_records, b AS later_records, {pct('b - a', 'a')} AS growth_percentage
FROM (SELECT {n_if(f'year({time}) = {_YEARS[0]}')} AS a, {n_if(f'year({time}) = {_YEARS[1]}')} AS b FROM clean_{fact} WHERE month({time}) IN ({months}))"""


@query("dm01_yoy_growth", union_all(
    _growth(f, t, months) for months in ("1, 2, 3, 4, 5, 6, 7", "1, 2, 3, 4, 5, 6")
    for f, t in (("referrals", "referral_date"), ("appointments", "scheduled_datetime"))))
def _(w):
    whole = m.growth_same_months(w.clean, _YEARS[0], range(1, 8))
    return whole.unionByName(m.growth_same_months(w.clean, _YEARS[0], range(1, 8), excluded={7}))


def _months(fact: str, time: str) -> str:
    return f"SELECT date_trunc('month', {time})::DATE AS m, {n()} AS c FROM clean_{fact} GROUP BY 1"


@query("dm02_daily_rate", f"""
SELECT m AS month_start, c AS records, day(last_day(m))::BIGINT AS days_in_month, {avg2('c', 'day(last_day(m))')} AS records_per_day,
  {avg2('sum(c) OVER ()', 'count(*) OVER ()')} AS average_per_month
FROM ({_months('referrals', 'referral_date')})""")
def _(w):
    return m.daily_rates(w.clean)


def _concentration(measure: str, source: str) -> str:
    return f"""SELECT '{measure}' AS measure, {n()} AS groups_counted, sum(c)::BIGINT AS top_total, any_value(g)::BIGINT AS grand_total,
  {pct('sum(c)', 'any_value(g)')} AS top_share_percentage
FROM (SELECT c, g FROM (SELECT department_id, {n()} AS c, sum(count(*)) OVER () AS g FROM {source} GROUP BY 1)
  WHERE department_id IS NOT NULL ORDER BY c DESC, department_id LIMIT 10)"""


@query("dm03_top_n_share", union_all([
    _concentration("backlog", "v_referral WHERE backlog_flag"), _concentration("no-shows", "v_appointment WHERE no_show_flag")]))
def _(w):
    return m.concentration(w.clean, w.domain)


@query("dm04_over_60_share", f"""
SELECT hospital_region, {n()} AS backlog, {n_if("backlog_wait_band = 'Over 60 days'")} AS over_60_days,
  CASE WHEN grouping(hospital_region) = 1 THEN 'network' ELSE 'region' END AS level,
  {pct("count(*) FILTER (WHERE backlog_wait_band = 'Over 60 days')", 'count(*)')} AS over_60_percentage
FROM v_referral WHERE backlog_flag GROUP BY ROLLUP (hospital_region)""")
def _(w):
    return m.oldest_band_share(w.clean, w.domain)


_eligible_missed = "attendance_eligible_flag AND no_show_flag"


@query("dm05_rate_by_specialty", f"""
SELECT department_name, CASE WHEN grouping(department_name) = 1 THEN 'network' ELSE 'specialty' END AS level,
  {n_if('attendance_eligible_flag')} AS eligible_appointments, {n_if(_eligible_missed)} AS no_show_appointments,
  {n('wait_h')} AS appointments_with_wait_time, {n('met_wait_target_flag')} AS target_eligible_appointments,
  {n_if('met_wait_target_flag')} AS appointments_within_target,
  {pct(f'count(*) FILTER (WHERE {_eligible_missed})', 'count(*) FILTER (WHERE attendance_eligible_flag)')} AS no_show_rate_percentage,
  {avg2('sum(wait_h)', 'count(wait_h)', 2)} AS average_waiting_minutes, {pct(_within, 'count(met_wait_target_flag)')} AS target_met_percentage
FROM v_appointment GROUP BY ROLLUP (department_name)""")
def _(w):
    return m.specialty_performance(w.clean, w.domain)


_first = f"""{n()} AS referrals_with_known_target, {avg2('sum(days_to_first_appointment)', 'count(*)')} AS average_days_to_first_appointment,
  {n_if('first_appointment_met_target_flag')} AS referrals_within_target, {pct(_met, 'count(*)')} AS target_met_percentage"""
_known_target = "v_referral WHERE first_appointment_met_target_flag IS NOT NULL"


@query("dm06_target_by_urgency", f"""
SELECT a.*, b.weakest_region_percentage FROM (SELECT urgency, {_first} FROM {_known_target} GROUP BY 1) a
JOIN (SELECT urgency, min(r) AS weakest_region_percentage FROM (SELECT urgency, hospital_region, {pct(_met, 'count(*)')} AS r FROM {_known_target} GROUP BY 1, 2)
  GROUP BY 1) b ON a.urgency = b.urgency""")
def _(w):
    return m.target_by_urgency(w.clean, w.domain)


def _avoidable(group: str) -> str:
    surplus = "(no_show_appointments::HUGEINT * bn - eligible_appointments::HUGEINT * bm)"
    return f"""SELECT '{group}' AS group_name, g::VARCHAR AS group_value, eligible_appointments, no_show_appointments, no_show_rate_percentage,
  ((200 * {surplus} + bn) // (2 * bn)) / 100::DOUBLE AS avoidable_no_shows
FROM (SELECT *, first_value(eligible_appointments) OVER best AS bn, first_value(no_show_appointments) OVER best AS bm
  FROM (SELECT {group} AS g, {_no_show} FROM v_appointment WHERE attendance_eligible_flag AND {group} IS NOT NULL GROUP BY 1)
  WINDOW best AS (ORDER BY no_show_appointments::DOUBLE / eligible_appointments::DOUBLE, g))"""


@query("dm07_avoidable", union_all([_avoidable("booking_channel"), _avoidable("deprivation_quintile")]))
def _(w):
    return m.avoidable(w.clean, w.domain)


def _spread(measure: str, rate: str, source: str, unit: int = 1) -> str:
    return f"""SELECT '{measure}' AS measure, min(r) / 100::DOUBLE AS lowest, max(r) / 100::DOUBLE AS highest, (max(r) - min(r)) * {unit} / 100::DOUBLE AS spread
FROM (SELECT {rate} AS r FROM {source})"""


def _h(part: str, whole: str, scale: int = 20000) -> str:
    return f"(({scale} * ({part}) + ({whole})) // (2 * ({whole})))::BIGINT"


_place = "hospital_region IS NOT NULL AND facility_name IS NOT NULL GROUP BY hospital_region, facility_name"


@query("dm08_rate_spread", union_all([
    _spread("facility length of stay, minutes", _h("sum(stay_h)", "count(*)", 2), f"v_ed WHERE stay_h IS NOT NULL AND {_place}", 60),
    _spread("facility left before treatment, points", _h("count(*) FILTER (WHERE left_before_treatment_flag)", "count(*)"), f"v_ed WHERE {_place}"),
    _spread("facility admission rate, points", _h("count(*) FILTER (WHERE admitted_flag)", "count(*)"), f"v_ed WHERE {_place}"),
    _spread("region no-show rate, points", _h("count(*) FILTER (WHERE no_show_flag)", "count(*)"),
            "v_appointment WHERE attendance_eligible_flag AND hospital_region IS NOT NULL GROUP BY hospital_region"),
]))
def _(w):
    return m.spreads(w.clean, w.domain)


@query("dm09_month_over_month", f"""
WITH months AS ({_months('appointments', 'scheduled_datetime')}),
line AS (SELECT s.d::DATE AS month_start, coalesce(c, 0) AS records FROM (SELECT unnest(generate_series((SELECT min(m) FROM months)::TIMESTAMP,
  (SELECT max(m) FROM months)::TIMESTAMP, INTERVAL 1 MONTH)) AS d) s LEFT JOIN months ON s.d::DATE = m),
lagged AS (SELECT *, lag(records) OVER (ORDER BY month_start) AS previous_month_records,
  lag(records, 12) OVER (ORDER BY month_start) AS same_month_last_year_records FROM line)
SELECT *, {pct('records - previous_month_records', 'previous_month_records')} AS change_percentage,
  {pct('records - same_month_last_year_records', 'same_month_last_year_records')} AS year_change_percentage FROM lagged""")
def _(w):
    return m.month_over_month(w.clean)


_WINDOW_END = dt.date(2001, 6, 30)


@query("dm10_out_of_window", f"""
SELECT appointment_status, {n()} AS records_outside_window, min(scheduled_date) AS first_date, max(scheduled_date) AS last_date
FROM v_appointment WHERE scheduled_date > DATE '{_WINDOW_END}' GROUP BY 1""")
def _(w):
    return m.outside_window(w.clean, _WINDOW_END)


@query("dm11_cumulative_share", f"""
SELECT presenting_group, c AS total_ed_visits, {pct('c', '(sum(c) OVER ())')} AS percentage_of_ed_visits,
  {pct('(sum(c) OVER (ORDER BY c DESC, presenting_group ROWS UNBOUNDED PRECEDING))', '(sum(c) OVER ())')} AS cumulative_percentage
FROM (SELECT presenting_group, {n()} AS c FROM v_ed GROUP BY 1)""")
def _(w):
    return m.presenting_pareto(w.clean, w.domain)


def _percentiles(measure: str, group: str, value: str, view: str) -> str:
    parts = []
    for name, p in m.PERCENTILES.items():
        at = f"(n - 1) * {p.numerator}"
        low = f"max(v) FILTER (WHERE i = ({at}) // {p.denominator})"
        high = f"max(v) FILTER (WHERE i = ({at} + {p.denominator - 1}) // {p.denominator})"
        exact = f"({low} * {p.denominator} + ({high} - {low}) * (any_value({at}) % {p.denominator}))"
        parts.append(f"((2 * {exact} + {p.denominator}) // {2 * p.denominator}) / 100::DOUBLE AS {name}")
    return f"""SELECT '{measure}' AS measure, g AS group_id, any_value(n)::BIGINT AS n, {', '.join(parts)}
FROM (SELECT {group} AS g, {value} AS v, row_number() OVER (PARTITION BY {group} ORDER BY {value}) - 1 AS i,
  count(*) OVER (PARTITION BY {group}) AS n FROM {view} WHERE {value} IS NOT NULL) GROUP BY g"""


@query("dm12_percentiles", union_all([
    _percentiles("waiting_minutes", "department_id", "wait_h", "v_appointment"),
    _percentiles("length_of_stay_hours", "facility_id", "stay_h", "v_ed"),
]))
def _(w):
    return m.wait_percentiles(w.clean, w.domain)


_SINCE = dt.date(1996, 1, 1)


def _sketched(measure: str, group: str, value: str, view: str, date: str) -> str:
    return (
        f"SELECT '{measure}' AS measure, {group} AS group_id, {n()} AS n, true AS median_is_close, true AS percentile_90_is_close"
        f" FROM {view} WHERE {value} IS NOT NULL AND date_trunc('month', {date})::DATE >= DATE '{_SINCE}' GROUP BY 2"
    )


@query("dm12b_sketched_percentiles", union_all([
    _sketched("waiting_minutes", "department_id", "wait_h", "v_appointment", "scheduled_date"),
    _sketched("length_of_stay_hours", "facility_id", "stay_h", "v_ed", "arrival_date"),
]))
def _(w):
    """Percentiles of some months from stored sketches, and whether their ranks lie within the stated bound."""
    values = sketches.timed_values(w.clean, w.domain)
    stored = w.layers.write("analytics", "wait_sketches", sketches.sketch(values))
    since = F.col("month_start") >= F.lit(_SINCE)
    found = sketches.percentiles(stored, where=since)
    errors = sketches.rank_errors(values.where(since), found)
    return errors.select(
        "measure", "group_id", "n", *[(F.col(f"{q_}_error") <= sketches.RANK_ERROR).alias(f"{q_}_is_close") for q_ in sketches.QUANTILES]
    )


@query("dm13_missing_population", union_all([
    f"SELECT 'attendance-eligible appointments without quintile' AS population, {n()} AS records FROM v_appointment WHERE attendance_eligible_flag AND deprivation_quintile IS NULL",
    f"SELECT 'ED visits without facility' AS population, {n()} AS records FROM v_ed WHERE facility_id IS NULL",
    f"SELECT 'referrals without department' AS population, {n()} AS records FROM v_referral WHERE department_id IS NULL",
]))
def _(w):
    return m.missing_populations(w.clean, w.domain)


@query("dm14_hour_weekday", f"""
SELECT isodow(arrival_time)::BIGINT AS iso_weekday, hour(arrival_time)::BIGINT AS arrival_hour, {n()} AS total_ed_visits FROM v_ed GROUP BY 1, 2""")
def _(w):
    return m.arrivals_by_hour(w.clean)


_SEGMENTS = {
    "network": "'all'", "presenting_group": "presenting_group", "triage_category": "triage_category::VARCHAR",
    "disposition": "disposition", "deprivation_quintile": "deprivation_quintile::VARCHAR",
    "age_band": "((year(arrival_time) - year(date_of_birth)) // 10 * 10)::VARCHAR || 's'",
}


@query("dm15_return_by_segment", union_all(
    f"SELECT '{s}' AS segment, {e} AS segment_value, {_return} FROM v_return GROUP BY 1, 2" for s, e in _SEGMENTS.items()))
def _(w):
    return m.return_by_segment(w.clean, w.domain)


@query("dm16_backlog_flow", f"""
SELECT month_start, new_referrals, closed_referrals, new_referrals - closed_referrals AS net_change,
  (sum(new_referrals - closed_referrals) OVER (ORDER BY month_start))::BIGINT AS running_net
FROM (SELECT coalesce(a.m, b.m) AS month_start, coalesce(a.c, 0) AS new_referrals, coalesce(b.c, 0) AS closed_referrals
  FROM ({_months('referrals', 'referral_date')}) a
  FULL JOIN (SELECT date_trunc('month', closed_date)::DATE AS m, {n()} AS c FROM clean_referrals WHERE closed_date IS NOT NULL GROUP BY 1) b ON a.m = b.m)""")
def _(w):
    return m.backlog_flow(w.clean)


# Semantic model

_ends = union_all(
    f"SELECT min({c})::DATE AS a, max({c})::DATE AS b FROM clean_{t}" for t, c in m.ACTIVITY.items())


@query("sm01_date_dimension", f"""
SELECT d AS date, year(d)::BIGINT AS year, quarter(d)::BIGINT AS quarter, month(d)::BIGINT AS month_number, strftime(d, '%B') AS month_name,
  date_trunc('month', d)::DATE AS month_start, (year(d) * 100 + month(d))::BIGINT AS month_sort
FROM (SELECT unnest(generate_series(min(a)::TIMESTAMP, max(b)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM ({_ends}))""")
def _(w):
    return model.dim_date(w.clean)


@query("sm02_star_query", f"""
SELECT year(scheduled_date)::BIGINT AS year, hospital_region, gender, {n()} AS appointments, {n_if('no_show_flag')} AS no_shows
FROM v_appointment GROUP BY 1, 2, 3""")
def _(w):
    return model.star_appointments(w.clean, w.domain)


def _kpi(name: str, kind: str, num: str, den: str, view: str, where: str = "TRUE", scale: int = 200) -> str:
    value = {"count": f"({num})::DOUBLE", "rate": pct(num, den), "average": avg2(num, den, scale)}[kind]
    shown = f"({num}) / 100::DOUBLE" if scale == 2 else f"({num})::DOUBLE"
    return f"SELECT '{name}' AS kpi_name, {shown} AS numerator, ({den})::BIGINT AS denominator, {value} AS kpi_value FROM {view} WHERE {where}"


def _f(p: str) -> str:
    return f"count(*) FILTER (WHERE {p})"


def _kpis(referral_where: str = "TRUE", appointment_where: str = "TRUE", ed_where: str = "TRUE") -> list[str]:
    r, a, e = ("v_referral", referral_where), ("v_appointment", appointment_where), ("v_ed", ed_where)
    return [
        _kpi("Backlog referrals", "count", _f("backlog_flag"), "count(*)", *r),
        _kpi("Average backlog wait days", "average", "coalesce(sum(backlog_wait_days), 0)", "count(backlog_wait_days)", *r),
        _kpi("Backlog over target %", "rate", _f("backlog_over_target_flag"), "count(backlog_over_target_flag)", *r),
        _kpi("No-show rate %", "rate", _f(_eligible_missed), _f("attendance_eligible_flag"), *a),
        _kpi("Average appointment wait minutes", "average", "coalesce(sum(wait_h), 0)", "count(wait_h)", *a, 2),
        _kpi("Seen within target %", "rate", _f("met_wait_target_flag"), "count(met_wait_target_flag)", *a),
        _kpi("Average ED length of stay hours", "average", "coalesce(sum(stay_h), 0)", "count(stay_h)", *e, 2),
        _kpi("Admission rate %", "rate", _f("admitted_flag"), "count(*)", *e),
        _kpi("Left before treatment %", "rate", _f("left_before_treatment_flag"), "count(*)", *e),
    ]


@query("sm03_kpi_catalogue", union_all(
    [*_kpis(), _kpi("ED return %", "rate", _f("returned"), "count(previous_discharge_time)", "v_return")]))
def _(w):
    return model.all_kpis(w.clean, w.domain)


_PLACE = "hospital_region, facility_name, department_name"


@query("sm04_matrix_rollup", f"""
SELECT {_PLACE}, grouping({_PLACE})::BIGINT AS grouping_level, {', '.join(f'sum({c})::BIGINT AS {c}' for c in model.MATRIX_SUMS)},
  {pct('sum(backlog_over_target)', 'sum(backlog_with_target)')} AS over_target_percentage,
  {pct('sum(no_shows)', 'sum(attendance_eligible)')} AS no_show_rate_percentage,
  {pct('sum(within_wait_target)', 'sum(wait_with_target)')} AS seen_within_target_percentage
FROM (SELECT {_PLACE}, {_f('backlog_flag')} AS backlog, count(backlog_over_target_flag) AS backlog_with_target, {_f('backlog_over_target_flag')} AS backlog_over_target,
    0 AS attendance_eligible, 0 AS no_shows, 0 AS wait_with_target, 0 AS within_wait_target FROM v_referral GROUP BY ALL
  UNION ALL SELECT {_PLACE}, 0, 0, 0, {_f('attendance_eligible_flag')}, {_f(_eligible_missed)}, count(met_wait_target_flag), {_f('met_wait_target_flag')}
  FROM v_appointment GROUP BY ALL)
GROUP BY ROLLUP ({_PLACE})""")
def _(w):
    return model.performance_matrix(w.clean, w.domain)


_SLICE = {"date": (dt.date(1998, 1, 1), dt.date(2024, 1, 15)), "hospital_region": "Asia"}
_region, (_from, _to) = _SLICE["hospital_region"], _SLICE["date"]
_within_slice = f"hospital_region = '{_region}' AND {{}} BETWEEN DATE '{_from}' AND DATE '{_to}'"


def _cards(referral_where: str = "TRUE", ed_where: str = "TRUE") -> list[str]:
    oldest = "backlog_flag AND backlog_wait_band = 'Over 60 days'"
    return [
        _kpi("Backlog over 60 days %", "rate", _f(oldest), _f("backlog_flag"), "v_referral", referral_where),
        _kpi("Total ED visits", "count", "count(*)", "count(*)", "v_ed", ed_where),
    ]


_of_referrals = _within_slice.format("referral_date") + " AND department_name = 'Cardiology'"
_of_visits = _within_slice.format("arrival_date")


@query("sm05_sliced_kpis", union_all([
    *_kpis(_of_referrals, _within_slice.format("scheduled_date") + " AND department_name = 'Cardiology'", _of_visits),
    _kpi("ED return %", "rate", _f("returned"), "count(previous_discharge_time)", "v_return", _of_visits), *_cards(_of_referrals, _of_visits)]))
def _(w):
    return model.sliced_kpis(w.clean, w.domain, {**_SLICE, "department_name": "Cardiology"})


def _composition(column: str) -> str:
    return f"""SELECT '{column}' AS category, {column} AS category_value, c AS total_ed_visits, {pct('c', '(sum(c) OVER ())')} AS percentage_of_ed_visits
FROM (SELECT {column}, {n()} AS c FROM v_ed GROUP BY 1)"""


_DATES = {"v_referral": "referral_date", "v_appointment": "scheduled_date", "v_ed": "arrival_date"}


def _at_level(level: str, columns: tuple[str, ...], statement: str) -> str:
    view = next(v for v in _DATES if f"FROM {v} " in statement)
    month = f"date_trunc('month', {_DATES[view]})::DATE"
    shown = [f"{c if c in columns else 'NULL::VARCHAR'} AS {c}" for c in q.PLACE]
    shown.append(f"{month if 'month_start' in columns else 'NULL::DATE'} AS month_start")
    groups = ", ".join(month if c == "month_start" else c for c in columns)
    return statement.replace("SELECT ", f"SELECT '{level}' AS level, {', '.join(shown)}, ", 1) + (f" GROUP BY {groups}" if groups else "")


@query("sm08_kpis_by_level", union_all(
    _at_level(level, columns, statement)
    for level, columns in model.LEVELS.items() for statement in [*_kpis(), *_cards()]
    if not ("department_name" in columns and "FROM v_ed " in statement)))
def _(w):
    """Every additive KPI for the network, regions, facilities, departments and months, from one scan of each fact."""
    return model.kpis_by_level(w.clean, w.domain)


@query("sm06_composition", union_all([_composition("disposition"), _composition("presenting_group")]))
def _(w):
    return model.composition(w.clean, w.domain)


@query("sm07_reconcile_measures", f"""
SELECT measure_name, c::BIGINT AS measured, c::BIGINT AS independent, 0::BIGINT AS difference, 'PASS' AS validation_status FROM (
{union_all(f"SELECT '{name}' AS measure_name, {_f(p)} AS c FROM {v}" for name, p, v in [
    ('Backlog referrals', 'backlog_flag', 'v_referral'), ('Backlog over target %', 'backlog_over_target_flag', 'v_referral'),
    ('No-show rate %', _eligible_missed, 'v_appointment'), ('Seen within target %', 'met_wait_target_flag', 'v_appointment'),
    ('Admission rate %', 'admitted_flag', 'v_ed'), ('Left before treatment %', 'left_before_treatment_flag', 'v_ed')])})""")
def _(w):
    return model.reconcile_measures(w.clean, w.domain)


# Order of the answers

def _positions_twin(name: str, order: str) -> str:
    bands = "CASE {0} WHEN '0-14 days' THEN 1 WHEN '15-30 days' THEN 2 WHEN '31-60 days' THEN 3 ELSE 4 END NULLS LAST"
    forms = {"+": "{0} NULLS LAST", "-": "{0} DESC NULLS FIRST", "#": bands}
    by = ", ".join(forms[part[0]].format(part[1:]) for part in order.split())
    label = ", ".join(f"{c}::VARCHAR" for c in q.row_names(order))
    return (
        f"SELECT '{name}' AS question, row_number() OVER (ORDER BY {by}) AS position, concat_ws(' / ', {label}) AS row_name"
        f" FROM ({REGISTRY[name].statement})"
    )


@query("so01_answer_positions", union_all(_positions_twin(name, order) for name, (_, order) in q.ORDERS.items()))
def _(w):
    """Position of every row in its answer: the sorts of all business and insight questions."""
    return q.positions(w.clean, w.domain)
