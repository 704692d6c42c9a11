"""Building blocks for the SQL twins of the registered queries.

Each twin is one DuckDB statement over the given tables. Named blocks (raw tables, clean tables,
views) are put in front of a statement when it mentions them.
"""

from __future__ import annotations

import re

from .. import schemas
from ..plans.mappings import mapping_rules
from ..sources.binding import AWKWARD_TEXTS, BOUND_DOMAIN, DAMAGED_ROWS, LINE_ORDER

SNAPSHOT = f"DATE '{BOUND_DOMAIN.snapshot}'"


def trim(x: str) -> str:
    return f"trim({x}, ' ')"


def present(x: str) -> str:
    return f"nullif(trim({x}, ' '), '')"


def nid(x: str) -> str:
    return f"upper({present(x)})"


def key(x: str) -> str:
    return f"lower({present(x)})"


def initcap(x: str) -> str:
    runs = f"regexp_extract_all(lower({x}), '([\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+)')"
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string(list_transform({runs}, lambda w: upper(w[1]) || w[2:]), '') END"


def label(x: str) -> str:
    return initcap(present(x))


def score(x: str) -> str:
    return f"CASE WHEN regexp_full_match({trim(x)}, '[1-5]') THEN {trim(x)}::SMALLINT END"


def positive(x: str) -> str:
    return f"CASE WHEN regexp_full_match({trim(x)}, '[1-9][0-9]*') THEN TRY_CAST({trim(x)} AS INTEGER) END"


_DATE_FORMS = "['%Y%m%d', '%Y/%m/%d', '%d %b %Y', '%b %d, %Y']"
_TIME_FORMS = "['%Y%m%d %H:%M:%S', '%Y/%m/%d %H:%M:%S', '%d %b %Y %H:%M:%S', '%d %b %Y %H:%M', '%Y%m%d', '%Y/%m/%d', '%d %b %Y', '%b %d, %Y']"
_ISO = "'^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}'"


def to_date(x: str) -> str:
    return f"CASE WHEN regexp_matches({trim(x)}, {_ISO}) THEN TRY_CAST({trim(x)} AS DATE) ELSE try_strptime({trim(x)}, {_DATE_FORMS})::DATE END"


def to_ts(x: str) -> str:
    return f"CASE WHEN regexp_matches({trim(x)}, {_ISO}) THEN TRY_CAST({trim(x)} AS TIMESTAMP) ELSE try_strptime({trim(x)}, {_TIME_FORMS}) END"


def sentinel(x: str, values) -> str:
    inside = ", ".join(f"'{v}'" for v in sorted(values))
    return f"(lower(trim(coalesce({x}, ''), ' ')) IN ({inside}))"


def value_case(x: str, values) -> str:
    pairs = values.items() if isinstance(values, dict) else [(v.lower(), v) for v in values]
    whens = " ".join(f"WHEN '{k}' THEN {v if isinstance(v, bool) else repr(v)}" for k, v in pairs)
    return f"CASE {key(x)} {whens} END"


def pct(n: str, d: str) -> str:
    """Rounded half away from zero at two decimals; n may be negative."""
    return (
        f"(CASE WHEN ({d}) = 0 THEN NULL ELSE (CASE WHEN ({n}) < 0 THEN -1 ELSE 1 END)"
        f" * ((20000 * abs({n}) + ({d})) // (2 * ({d}))) / 100::DOUBLE END)"
    )


def avg2(total: str, n: str, scale: int = 200) -> str:
    """Average of an integer total; scale 200 for whole units, 2 for a total in hundredths."""
    return (
        f"(CASE WHEN ({n}) = 0 THEN NULL ELSE (CASE WHEN ({total}) < 0 THEN -1 ELSE 1 END)"
        f" * (({scale} * abs({total}) + ({n})) // (2 * ({n}))) / 100::DOUBLE END)"
    )


def n(expr: str = "*") -> str:
    return f"count({expr})::BIGINT"


def n_if(predicate: str) -> str:
    return f"(count(*) FILTER (WHERE {predicate}))::BIGINT"


def _pad(x: str, width: int) -> str:
    return f"lpad(({x})::VARCHAR, greatest({width}, length(({x})::VARCHAR))::INTEGER, '0')"



_BLOCKS: dict[str, str] = {}

_BLOCKS["raw_facilities"] = f"""
SELECT CASE WHEN k % 5 = 0 THEN ' f' || {_pad('k', 3)} || ' ' ELSE 'F' || {_pad('k', 3)} END AS facility_id,
  n_name || ' base-hospital' AS facility_name,
  CASE k % 4 WHEN 0 THEN upper(r_name) WHEN 1 THEN '  ' || lower(r_name) || ' ' ELSE r_name END AS hospital_region,
  'CITY ' || k AS city,
  CASE k % 3 WHEN 0 THEN 'tertiary hospital' WHEN 1 THEN 'Regional Hospital' ELSE 'community hospital ' END AS facility_type,
  CASE k % 9 WHEN 4 THEN 'n/a' WHEN 5 THEN '0' ELSE (100 + 10 * k)::VARCHAR END AS bed_capacity
FROM (SELECT *, n_nationkey AS k, unnest(CASE WHEN n_nationkey % 8 = 3 THEN [1, 2] ELSE [1] END) AS copy FROM nation)
JOIN region ON n_regionkey = r_regionkey"""

_BLOCKS["raw_departments"] = f"""
SELECT 'D' || {_pad('s', 6)} AS department_id, 'F' || {_pad('s_nationkey', 3)} AS facility_id,
  CASE WHEN s % 6 = 5 THEN ' ' || lower(name) || ' ' ELSE name END AS department_name,
  CASE WHEN s % 8 IN (1, 2, 7) THEN 'Surgical' ELSE 'medical' END AS specialty_group,
  (300 + 30 * (s % 8))::VARCHAR AS routine_target_days, (100 + 20 * (s % 8))::VARCHAR AS urgent_target_days,
  (20 + 5 * (s % 3))::VARCHAR AS appointment_wait_target_mins
FROM (SELECT s_suppkey AS s, s_nationkey,
  ['Cardiology', 'Orthopaedics', 'General Surgery', 'Gastroenterology', 'Respiratory', 'Neurology', 'Dermatology', 'ENT'][s_suppkey % 8 + 1] AS name,
  unnest(CASE WHEN s_suppkey % 20 = 7 THEN [1, 2] ELSE [1] END) AS copy FROM supplier)"""

_BLOCKS["raw_patients"] = f"""
SELECT (CASE WHEN p % 10 = 3 THEN ' p' ELSE 'P' END) || {_pad('p', 7)} AS patient_id,
  CASE p % 40 WHEN 1 THEN 'n/a' WHEN 2 THEN '1899-12-31' WHEN 4 THEN '2030-01-01'
    ELSE strftime(DATE '1930-01-01' + ((p * 7919) % 24000)::INTEGER, '%Y-%m-%d') END AS date_of_birth,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'female' WHEN 'BUILDING' THEN 'M' WHEN 'AUTOMOBILE' THEN ' Gender-Diverse '
    WHEN 'HOUSEHOLD' THEN 'Unknown' ELSE 'MALE' END AS gender,
  CASE p % 11 WHEN 0 THEN '' WHEN 1 THEN 'N/A' WHEN 2 THEN 'maori' WHEN 3 THEN 'PACIFIC' WHEN 4 THEN 'Asian'
    WHEN 5 THEN ' other' ELSE 'European' END AS ethnicity,
  'city ' || c_nationkey AS city, (p % 7)::VARCHAR AS deprivation_quintile,
  strftime(DATE '1996-01-01' + (p % 1000)::INTEGER, '%Y-%m-%d') AS enrolment_date
FROM (SELECT *, c_custkey AS p, unnest(CASE WHEN c_custkey % 30 = 6 THEN [1, 2] ELSE [1] END) AS copy FROM customer)"""

_BLOCKS["raw_referrals"] = f"""
SELECT 'R' || {_pad('o', 7)} AS referral_id,
  CASE WHEN o % 97 = 0 THEN 'P9999999' WHEN o % 89 = 0 THEN '' WHEN o % 13 = 5 THEN ' p' || {_pad('o_custkey', 7)}
    ELSE 'P' || {_pad('o_custkey', 7)} END AS patient_id,
  'D' || {_pad('dep', 6)} AS department_id,
  strftime(received, '%Y-%m-%d') AS referral_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'Semi-Urgent' WHEN '5-LOW' THEN 'Routine'
    WHEN '3-MEDIUM' THEN 'routine ' ELSE '' END AS urgency,
  CASE o_orderstatus WHEN 'O' THEN ['open', 'Waiting ', 'BOOKED'][o % 3 + 1]
    WHEN 'P' THEN CASE WHEN o % 2 = 0 THEN 'waiting' ELSE 'Cancelled' END
    ELSE CASE WHEN o % 5 = 0 THEN 'decline' ELSE 'completed' END END AS referral_status,
  CASE WHEN o % 3 = 2 OR fa IS NULL THEN '' WHEN o % 10 = 0 THEN strftime(fa, '%Y-%m-%d')
    ELSE strftime(received + (abs(fa - received) % 600)::INTEGER, '%Y-%m-%d') END AS first_appointment_date,
  CASE WHEN o % 4 = 1 THEN strftime(cl, '%Y-%m-%d') ELSE '' END AS closed_date,
  ['gp', 'self-referral', 'ED '][o % 3 + 1] AS referral_source,
  (o % 8)::VARCHAR AS priority_score
FROM (SELECT o_orderkey AS o, o_custkey, o_orderstatus, o_orderpriority, o_orderdate::DATE AS received, fa, cl, dep,
    unnest(CASE WHEN o_orderkey % 50 = 9 THEN [1, 2] ELSE [1] END) AS copy
  FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate)::DATE AS fa, max(l_shipdate)::DATE AS cl, min(l_suppkey) AS dep
    FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey)"""

_TS = "'%Y-%m-%d %H:%M:%S'"
_BLOCKS["raw_appointments"] = f"""
SELECT 'A' || {_pad('l_orderkey * 10 + l_linenumber', 8)} || {_pad('repeat', 3)} AS appointment_id, 'P' || {_pad('o_custkey', 7)} AS patient_id,
  CASE WHEN l_orderkey % 101 = 0 THEN 'D999999' ELSE 'D' || {_pad('l_suppkey', 6)} END AS department_id,
  CASE WHEN l_linenumber = 1 THEN '' WHEN l_orderkey % 103 = 0 THEN 'R9999999' ELSE 'R' || {_pad('l_orderkey', 7)} END AS referral_id,
  strftime(scheduled, {_TS}) AS scheduled_datetime, strftime(arrived, {_TS}) AS check_in_time,
  strftime(arrived + to_minutes(l_quantity::BIGINT - 6), {_TS}) AS seen_time,
  CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'completed' WHEN 'AO' THEN 'Completed ' WHEN 'NF' THEN 'no-show'
    WHEN 'NO' THEN 'scheduled' WHEN 'RF' THEN 'cancelled' ELSE 're-scheduled' END AS appointment_status,
  ['first specialist assessment', 'Follow-up', 'PROCEDURE', ' telehealth'][l_suppkey % 4 + 1] AS appointment_type,
  ['referral team', 'Phone', 'PATIENT PORTAL', ' clinic'][l_partkey % 4 + 1] AS booking_channel
FROM (SELECT *, CASE WHEN l_returnflag = 'A' AND l_partkey % 50 <> 0 THEN scheduled - to_minutes(5) END AS arrived,
    unnest(CASE WHEN l_orderkey % 50 = 9 THEN [1, 2] ELSE [1] END) AS copy
  FROM (SELECT *, l_shipdate + to_hours(l_linenumber + 8) AS scheduled,
      row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) AS repeat
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey))"""

_BLOCKS["raw_ed_visits"] = f"""
SELECT 'V' || {_pad('e', 7)} AS visit_id, CASE WHEN e % 61 = 0 THEN 'P9999999' ELSE 'P' || {_pad('user_id', 7)} END AS patient_id,
  CASE WHEN e % 71 = 0 THEN 'F999' ELSE 'F' || {_pad('e % 25', 3)} END AS facility_id,
  strftime(arrival, {_TS}) AS arrival_time, (e % 7)::VARCHAR AS triage_category,
  CASE WHEN e % 45 = 0 THEN '' WHEN e % 60 = 7 THEN strftime(arrival - to_hours(1), {_TS})
    ELSE strftime(arrival + to_seconds(floor(value * 60)::BIGINT), {_TS}) END AS discharge_time,
  CASE event_type WHEN 'view' THEN 'discharged' WHEN 'click' THEN 'Discharged ' WHEN 'purchase' THEN 'admitted'
    WHEN 'signup' THEN 'TRANSFERRED' ELSE 'left before treatment' END AS disposition,
  CASE WHEN event_type = 'purchase' THEN CASE WHEN e % 37 = 0 THEN 'No' ELSE 'Yes' END
    WHEN e % 41 = 0 THEN 'YES' ELSE 'no' END AS admitted_flag,
  ['injury', 'Respiratory', 'CARDIAC', 'abdominal', ' neurological', 'infection', 'other'][k % 7 + 1] AS presenting_group
FROM (SELECT *, event_id AS e, date_trunc('second', ts) AS arrival, json_extract(props, '$.k')::INTEGER AS k,
  unnest(CASE WHEN event_id % 40 = 11 THEN [1, 2] ELSE [1] END) AS copy FROM events)"""


def _sql_value(v: str | None) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


for _t in schemas.TABLES:
    _rows = ", ".join("(" + ", ".join(f"{_sql_value(v)}::VARCHAR" for v in r) + ")" for r in DAMAGED_ROWS[_t])
    _BLOCKS[f"bad_raw_{_t}"] = f"SELECT * FROM raw_{_t} UNION ALL VALUES {_rows}"

    _quoted = [(f"Q{i}", text, *[None] * (len(schemas.RAW_COLUMNS[_t]) - 2)) for i, text in enumerate(AWKWARD_TEXTS)]
    _rows = ", ".join("(" + ", ".join(f"{_sql_value(v)}::VARCHAR" for v in r) + ")" for r in _quoted)
    _BLOCKS[f"csv_{_t}"] = f"SELECT * FROM raw_{_t} UNION ALL VALUES {_rows}"

_pairs = [(g, r, s) for g, values in mapping_rules(BOUND_DOMAIN).items() for r, s in values.items()]
_BLOCKS["mappings"] = (
    "SELECT * FROM (VALUES " + ", ".join(f"('{g}', '{r}', '{s}')" for g, r, s in _pairs)
    + ") AS m(mapping_group, raw_value_normalised, standard_value)"
)


def _mapped(alias: str, group: str, lookup: str) -> str:
    return (
        f"LEFT JOIN mappings {alias} ON {alias}.mapping_group = '{group}' AND {alias}.raw_value_normalised = {lookup}"
    )


for _p in ("", "bad_"):
    _BLOCKS[f"{_p}clean_facilities"] = f"""
SELECT facility_id, facility_name, m.standard_value AS hospital_region, city, facility_type, bed_capacity FROM (
  SELECT DISTINCT {nid('facility_id')} AS facility_id, {label('facility_name')} AS facility_name, {key('hospital_region')} AS region,
    {label('city')} AS city, {label('facility_type')} AS facility_type, {positive('bed_capacity')} AS bed_capacity
  FROM {_p}raw_facilities) f {_mapped('m', 'hospital_region', 'f.region')}"""

    _BLOCKS[f"{_p}clean_departments"] = f"""
SELECT DISTINCT {nid('department_id')} AS department_id, {nid('facility_id')} AS facility_id,
  CASE WHEN {key('department_name')} = 'ent' THEN 'ENT' ELSE {label('department_name')} END AS department_name,
  {label('specialty_group')} AS specialty_group, {positive('routine_target_days')} AS routine_target_days,
  {positive('urgent_target_days')} AS urgent_target_days, {positive('appointment_wait_target_mins')} AS appointment_wait_target_mins
FROM {_p}raw_departments"""

    _dob = to_date("date_of_birth")
    _BLOCKS[f"{_p}clean_patients"] = f"""
SELECT patient_id, date_of_birth, m.standard_value AS gender, ethnicity, city, deprivation_quintile, enrolment_date,
  ethnicity_missing_flag, date_of_birth IS NULL AS date_of_birth_issue_flag,
  deprivation_quintile IS NULL AS deprivation_quintile_issue_flag
FROM (SELECT DISTINCT {nid('patient_id')} AS patient_id,
    CASE WHEN {_dob} BETWEEN DATE '1900-01-01' AND {SNAPSHOT} THEN {_dob} END AS date_of_birth,
    {key('gender')} AS gender_key,
    CASE WHEN {sentinel('ethnicity', schemas.VALUE_SENTINELS)} THEN NULL ELSE {label('ethnicity')} END AS ethnicity,
    {label('city')} AS city, {score('deprivation_quintile')} AS deprivation_quintile,
    {to_date('enrolment_date')} AS enrolment_date,
    {sentinel('ethnicity', schemas.VALUE_SENTINELS)} AS ethnicity_missing_flag
  FROM {_p}raw_patients) p {_mapped('m', 'gender', 'p.gender_key')}"""

    _BLOCKS[f"{_p}clean_referrals"] = f"""
SELECT DISTINCT r.referral_id, p.patient_id, d.department_id, r.referral_date, urgency, m.standard_value AS referral_status,
  CASE WHEN fa >= r.referral_date THEN fa END AS first_appointment_date,
  CASE WHEN cl >= r.referral_date THEN cl END AS closed_date,
  referral_source, priority_score, p.patient_id IS NULL AS patient_id_issue_flag,
  d.department_id IS NULL AS department_id_issue_flag, urgency IS NULL AS urgency_issue_flag,
  priority_score IS NULL AS priority_score_issue_flag,
  (fa IS NOT NULL AND fa < r.referral_date) OR (cl IS NOT NULL AND cl < r.referral_date) AS timeline_issue_flag
FROM (SELECT {nid('referral_id')} AS referral_id, {nid('patient_id')} AS pk, {nid('department_id')} AS dk,
    {to_date('referral_date')} AS referral_date, {value_case('urgency', schemas.URGENCIES)} AS urgency,
    {key('referral_status')} AS sk, {to_date('first_appointment_date')} AS fa, {to_date('closed_date')} AS cl,
    {label('referral_source')} AS referral_source, {score('priority_score')} AS priority_score FROM {_p}raw_referrals) r
LEFT JOIN {_p}clean_patients p ON r.pk = p.patient_id LEFT JOIN {_p}clean_departments d ON r.dk = d.department_id
{_mapped('m', 'referral_status', 'r.sk')}"""

    _BLOCKS[f"{_p}clean_appointments"] = f"""
SELECT DISTINCT a.appointment_id, p.patient_id, d.department_id, r.referral_id, a.scheduled_datetime, a.check_in_time,
  CASE WHEN a.check_in_time IS NULL OR seen >= a.check_in_time THEN seen END AS seen_time,
  m.standard_value AS appointment_status, a.appointment_type, a.booking_channel,
  p.patient_id IS NULL AS patient_id_issue_flag, d.department_id IS NULL AS department_id_issue_flag,
  a.rk IS NOT NULL AND r.referral_id IS NULL AS referral_id_issue_flag,
  m.standard_value = 'Completed' AND (a.check_in_time IS NULL OR seen IS NULL OR seen < a.check_in_time) AS status_timestamp_issue_flag,
  coalesce(seen < a.check_in_time, FALSE) AS timeline_issue_flag
FROM (SELECT {nid('appointment_id')} AS appointment_id, {nid('patient_id')} AS pk, {nid('department_id')} AS dk,
    {nid('referral_id')} AS rk, {to_ts('scheduled_datetime')} AS scheduled_datetime, {to_ts('check_in_time')} AS check_in_time,
    {to_ts('seen_time')} AS seen, {key('appointment_status')} AS sk,
    {value_case('appointment_type', schemas.APPOINTMENT_TYPES)} AS appointment_type,
    {value_case('booking_channel', schemas.BOOKING_CHANNELS)} AS booking_channel FROM {_p}raw_appointments) a
LEFT JOIN {_p}clean_patients p ON a.pk = p.patient_id LEFT JOIN {_p}clean_departments d ON a.dk = d.department_id
LEFT JOIN {_p}clean_referrals r ON a.rk = r.referral_id {_mapped('m', 'appointment_status', 'a.sk')}"""

    _BLOCKS[f"{_p}clean_ed_visits"] = f"""
SELECT DISTINCT e.visit_id, p.patient_id, f.facility_id, e.arrival_time, e.triage_category,
  CASE WHEN left_at >= e.arrival_time THEN left_at END AS discharge_time, e.disposition, e.admitted_flag, e.presenting_group,
  p.patient_id IS NULL AS patient_id_issue_flag, f.facility_id IS NULL AS facility_id_issue_flag,
  e.triage_category IS NULL AS triage_category_issue_flag,
  left_at IS NULL AND e.disposition <> 'Left Before Treatment' AS missing_discharge_time_flag,
  coalesce(left_at < e.arrival_time, FALSE) AS timeline_issue_flag,
  coalesce((e.disposition = 'Admitted') <> e.admitted_flag, TRUE) AS admission_consistency_issue_flag
FROM (SELECT {nid('visit_id')} AS visit_id, {nid('patient_id')} AS pk, {nid('facility_id')} AS fk,
    {to_ts('arrival_time')} AS arrival_time, {score('triage_category')} AS triage_category, {to_ts('discharge_time')} AS left_at,
    {value_case('disposition', schemas.DISPOSITIONS)} AS disposition, {value_case('admitted_flag', schemas.YES_NO)} AS admitted_flag,
    {value_case('presenting_group', schemas.PRESENTING_GROUPS)} AS presenting_group FROM {_p}raw_ed_visits) e
LEFT JOIN {_p}clean_patients p ON e.pk = p.patient_id LEFT JOIN {_p}clean_facilities f ON e.fk = f.facility_id"""

_waited = f"({SNAPSHOT} - r.referral_date)"
_target = "(CASE r.urgency WHEN 'Urgent' THEN d.urgent_target_days WHEN 'Routine' THEN d.routine_target_days END)"
_backlog = "(r.referral_status IN ('Open', 'Waiting'))"
_BLOCKS["v_referral"] = f"""
SELECT r.referral_id, r.patient_id, r.department_id, d.facility_id, f.facility_name, f.hospital_region, f.city AS facility_city,
  d.department_name, d.specialty_group, r.referral_date, r.urgency, r.referral_status, r.referral_source, r.priority_score::BIGINT AS priority_score,
  r.first_appointment_date, r.closed_date, p.date_of_birth, p.gender, p.ethnicity, p.city AS patient_city,
  p.deprivation_quintile::BIGINT AS deprivation_quintile, {_target}::BIGINT AS target_days,
  (r.first_appointment_date - r.referral_date)::BIGINT AS days_to_first_appointment,
  (r.first_appointment_date - r.referral_date) <= {_target} AS first_appointment_met_target_flag,
  {_backlog} AS backlog_flag, {SNAPSHOT} AS snapshot_date,
  CASE WHEN {_backlog} THEN {_waited}::BIGINT END AS backlog_wait_days,
  CASE WHEN NOT {_backlog} THEN NULL WHEN {_waited} BETWEEN 0 AND 14 THEN '0-14 days' WHEN {_waited} BETWEEN 15 AND 30 THEN '15-30 days'
    WHEN {_waited} BETWEEN 31 AND 60 THEN '31-60 days' ELSE 'Over 60 days' END AS backlog_wait_band,
  CASE WHEN NOT {_backlog} OR {_target} IS NULL THEN NULL ELSE {_waited} > {_target} END AS backlog_over_target_flag
FROM clean_referrals r LEFT JOIN clean_patients p ON r.patient_id = p.patient_id
LEFT JOIN clean_departments d ON r.department_id = d.department_id LEFT JOIN clean_facilities f ON d.facility_id = f.facility_id"""

_BLOCKS["v_appointment"] = """
SELECT *, wait_h / 100::DOUBLE AS waiting_minutes, appointment_status IN ('Completed', 'No Show') AS attendance_eligible_flag,
  appointment_status = 'Completed' AS completed_flag, appointment_status = 'No Show' AS no_show_flag,
  wait_h IS NOT NULL AS wait_time_eligible_flag, wait_h <= 100 * appointment_wait_target_mins AS met_wait_target_flag
FROM (SELECT a.*, d.facility_id, f.facility_name, f.hospital_region, f.city AS facility_city, d.department_name, d.specialty_group,
    d.appointment_wait_target_mins::BIGINT AS appointment_wait_target_mins, a.scheduled_datetime::DATE AS scheduled_date,
    date_trunc('month', a.scheduled_datetime)::DATE AS scheduled_month, p.gender, p.ethnicity, p.city AS patient_city,
    p.deprivation_quintile::BIGINT AS deprivation_quintile,
    CASE WHEN a.appointment_status = 'Completed' AND a.check_in_time IS NOT NULL AND a.seen_time IS NOT NULL
      AND NOT coalesce(a.status_timestamp_issue_flag, FALSE) AND NOT coalesce(a.timeline_issue_flag, FALSE)
      THEN (2 * date_diff('microsecond', a.check_in_time, a.seen_time) + 600000) // 1200000 END AS wait_h
  FROM clean_appointments a LEFT JOIN clean_patients p ON a.patient_id = p.patient_id
  LEFT JOIN clean_departments d ON a.department_id = d.department_id LEFT JOIN clean_facilities f ON d.facility_id = f.facility_id)"""

_BLOCKS["v_ed"] = """
SELECT *, stay_h / 100::DOUBLE AS length_of_stay_hours, stay_h IS NOT NULL AS length_of_stay_eligible_flag
FROM (SELECT e.* REPLACE (e.triage_category::BIGINT AS triage_category), f.facility_name, f.hospital_region, f.city AS facility_city,
    f.facility_type, e.arrival_time::DATE AS arrival_date, date_trunc('month', e.arrival_time)::DATE AS arrival_month,
    e.disposition = 'Left Before Treatment' AS left_before_treatment_flag, p.gender, p.ethnicity, p.city AS patient_city,
    p.deprivation_quintile::BIGINT AS deprivation_quintile, p.date_of_birth,
    CASE WHEN e.discharge_time IS NOT NULL AND NOT coalesce(e.timeline_issue_flag, FALSE)
      THEN (2 * date_diff('microsecond', e.arrival_time, e.discharge_time) + 36000000) // 72000000 END AS stay_h
  FROM clean_ed_visits e LEFT JOIN clean_patients p ON e.patient_id = p.patient_id
  LEFT JOIN clean_facilities f ON e.facility_id = f.facility_id)"""

_BLOCKS["v_return"] = f"""
SELECT *, arrival_time > previous_discharge_time AND arrival_time <= previous_discharge_time + to_hours({BOUND_DOMAIN.return_window_hours}) AS returned
FROM (SELECT *, lag(discharge_time) OVER (PARTITION BY patient_id ORDER BY arrival_time, visit_id) AS previous_discharge_time
  FROM v_ed WHERE patient_id IS NOT NULL)"""

_NAME = re.compile(r"\b(" + "|".join(sorted(_BLOCKS, key=len, reverse=True)) + r")\b")


def sql(body: str) -> str:
    """The statement with every block it needs, parents first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            if name not in order:
                visit(_BLOCKS[name])
                if name not in order:
                    order.append(name)

    visit(body)
    if not order:
        return body
    blocks = ",\n".join(f"{name} AS ({_BLOCKS[name]})" for name in order)
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {blocks},\n{body.lstrip()[5:]}"
    return f"WITH {blocks}\n{body}"


def union_all(parts) -> str:
    return "\nUNION ALL\n".join(parts)
