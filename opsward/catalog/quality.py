"""Registered profiling, cleaning, rule and validation queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..plans import constraints as ct
from ..plans import gates
from ..plans import profiling as pf
from ..plans import validation as vl
from ..plans.mappings import MAPPED_COLUMNS, build_mappings, mapping_usage
from ..sources.binding import BOUND_DOMAIN
from ..sources.keyed import KeyedTable
from ..sources.layers import upsert
from .oracle import SNAPSHOT, key, n, n_if, nid, pct, present, sentinel, to_date, to_ts, trim, union_all
from .registry import query

TABLES = schemas.TABLES
PK = {t: schemas.PRIMARY_KEYS[t][0] for t in TABLES}


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Profiles of the raw layer, run over the bound rows and the damaged ones

_ids = union_all(
    f"SELECT '{t}_raw' AS table_name, CASE WHEN {sentinel(PK[t], schemas.ID_SENTINELS)} THEN NULL "
    f"ELSE upper({trim(PK[t])}) END AS id FROM bad_raw_{t}"
    for t in TABLES
)


@query("pf01_identifier_summary", f"""
SELECT table_name, {n()} AS total_rows, {n_if('id IS NULL')} AS missing_or_sentinel_ids, {n('id')} AS non_missing_ids,
  {n('DISTINCT id')} AS unique_ids, {n('id')} - {n('DISTINCT id')} AS duplicate_excess_rows
FROM ({_ids}) GROUP BY 1""")
def _(w):
    return pf.profile_identifiers(w.damaged_raw)


@query("pf02_duplicate_ids", f"""
SELECT table_name, id AS duplicated_id, {n()} AS occurrence_count, {n()} - 1 AS duplicate_excess_rows
FROM ({_ids}) WHERE id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""")
def _(w):
    return pf.duplicate_ids(w.damaged_raw)


@query("pf03_bad_id_format", union_all(
    f"SELECT '{t}_raw' AS table_name, {PK[t]} AS raw_id, '{BOUND_DOMAIN.id_patterns[t]}' AS expected_format FROM bad_raw_{t} "
    f"WHERE {present(PK[t])} IS NOT NULL AND NOT regexp_full_match(upper({trim(PK[t])}), '{BOUND_DOMAIN.id_patterns[t]}')"
    for t in TABLES))
def _(w):
    return pf.bad_id_formats(w.damaged_raw, w.domain)


def _cells(columns) -> str:
    return union_all(
        f"SELECT '{t}_raw' AS table_name, '{c}' AS column_name, {c} AS v FROM bad_raw_{t}"
        for t, cs in columns.items() for c in cs
    )


@query("pf04_category_frequency", f"""
SELECT table_name, column_name, coalesce(v, '[NULL]') AS original_value,
  CASE WHEN {present('v')} IS NULL THEN '[BLANK OR NULL]' WHEN lower({trim('v')}) IN ('n/a', 'na') THEN '[SENTINEL VALUE]'
    ELSE lower({trim('v')}) END AS normalised_value, {n()} AS record_count
FROM ({_cells(pf.CATEGORY_COLUMNS)}) GROUP BY table_name, column_name, v""")
def _(w):
    return pf.category_frequencies(w.damaged_raw)


_scores = union_all(
    f"SELECT '{t}_raw' AS table_name, '{c}' AS column_name, CASE WHEN {sentinel(c, s)} THEN 'Missing or sentinel value' "
    f"WHEN NOT regexp_full_match({trim(c)}, '[0-9]+') THEN 'non-numeric value' "
    f"WHEN {trim(c)}::HUGEINT NOT BETWEEN 1 AND 5 THEN 'outside range 1-5' END AS issue_type FROM bad_raw_{t}"
    for t, (c, s) in pf.SCORE_COLUMNS.items()
)


@query("pf05_numeric_range", f"""
SELECT table_name, column_name, issue_type, {n()} AS affected_rows FROM ({_scores}) WHERE issue_type IS NOT NULL GROUP BY ALL""")
def _(w):
    return pf.score_ranges(w.damaged_raw)


@query("pf06_positive_number", f"""
SELECT table_name, column_name, issue_type, {n()} AS affected_rows FROM (
  SELECT table_name, column_name, CASE WHEN {present('v')} IS NULL THEN 'missing value'
    WHEN NOT regexp_full_match({trim('v')}, '[0-9]+') THEN 'Non numeric value'
    WHEN {trim('v')}::HUGEINT <= 0 THEN 'Zero or negative value' END AS issue_type FROM ({_cells(pf.POSITIVE_COLUMNS)}))
WHERE issue_type IS NOT NULL GROUP BY ALL""")
def _(w):
    return pf.positive_numbers(w.damaged_raw)


@query("pf07_date_validity", f"""
SELECT patient_id, date_of_birth, issue_type FROM (
  SELECT patient_id, date_of_birth, CASE WHEN {sentinel('date_of_birth', schemas.VALUE_SENTINELS)} THEN 'Missing or sentinel date'
    WHEN {to_date('date_of_birth')} IS NULL THEN 'Invalid date format'
    WHEN {to_date('date_of_birth')} < DATE '1900-01-01' THEN 'Birth date requires review: before 1900' END AS issue_type
  FROM bad_raw_patients) WHERE issue_type IS NOT NULL""")
def _(w):
    return pf.birth_date_issues(w.damaged_raw["patients"], domain=w.domain)


@query("pf08_missing_fk", f"""
SELECT table_name, column_name, {n()} AS missing_reference_count FROM ({_cells(pf.REQUIRED_KEYS)})
WHERE {present('v')} IS NULL GROUP BY 1, 2""")
def _(w):
    return pf.missing_foreign_keys(w.damaged_raw)


@query("pf09_orphan_fk", union_all(
    f"SELECT '{c}_raw' AS child_table, '{k}' AS foreign_key_column, '{p}_raw' AS expected_parent_table, {nid('c.' + k)} AS orphan_id, "
    f"{n()} AS affected_rows FROM bad_raw_{c} c WHERE {present('c.' + k)} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM bad_raw_{p} p "
    f"WHERE {nid('p.' + k)} = {nid('c.' + k)}) GROUP BY 1, 2, 3, 4"
    for c, k, p in schemas.RELATIONSHIPS))
def _(w):
    return pf.orphan_foreign_keys(w.damaged_raw)


def _issue(table: str, name: str, predicate: str) -> str:
    return f"SELECT '{table}_raw' AS table_name, {literal(name)} AS issue_type, {PK[table]} AS record FROM bad_raw_{table} WHERE {predicate}"


def _summary(parts) -> str:
    return f"""SELECT table_name, issue_type, {n()} AS affected_rows, {n('DISTINCT record')} AS affected_unique_records
FROM ({union_all(parts)}) GROUP BY 1, 2"""


@query("pf10_impossible_timeline", _summary([
    _issue("patients", "Enrolment before date of birth", f"{to_date('enrolment_date')} < {to_date('date_of_birth')}"),
    _issue("referrals", "First appointment before referral", f"{to_date('first_appointment_date')} < {to_date('referral_date')}"),
    _issue("referrals", "Referral closed before referral date", f"{to_date('closed_date')} < {to_date('referral_date')}"),
    _issue("appointments", "Seen time before check-in time", f"{to_ts('seen_time')} < {to_ts('check_in_time')}"),
    _issue("ed_visits", "Discharge before arrival", f"{to_ts('discharge_time')} < {to_ts('arrival_time')}"),
]))
def _(w):
    return pf.impossible_timelines(w.damaged_raw, w.domain)


_completed = f"lower({trim('appointment_status')}) = 'completed'"


@query("pf11_status_consistency", _summary([
    _issue("appointments", "Completed appointment missing check-in time", f"{_completed} AND {present('check_in_time')} IS NULL"),
    _issue("appointments", "Completed appointment missing seen time", f"{_completed} AND {present('seen_time')} IS NULL"),
    _issue("ed_visits", "Disposition recorded but discharge time missing",
           f"{present('disposition')} IS NOT NULL AND {present('discharge_time')} IS NULL"),
]))
def _(w):
    return pf.status_consistency(w.damaged_raw)


_VISIBLE = {"facilities": ["hospital_region"], "patients": ["gender"], "referrals": ["referral_status"],
            "appointments": ["appointment_status"]}


@query("pf12_visible_values",
       f"SELECT DISTINCT table_name, column_name, '[' || coalesce(v, 'NULL') || ']' AS visible_value FROM ({_cells(_VISIBLE)})")
def _(w):
    parts = [pf.visible_values(w.damaged_raw[t], cs, t) for t, cs in _VISIBLE.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


_dup_upper, _dup_lower = ["department_id", "facility_id"], ["department_name", "specialty_group"]


def _folded(c: str) -> str:
    fold = "upper" if c in _dup_upper else "lower" if c in _dup_lower else ""
    return f"{fold}({trim(c)}) AS {c}"


@query("pf13_exact_duplicates", f"""
SELECT *, {n()} AS occurrence_count FROM (SELECT {', '.join(_folded(c) for c in schemas.RAW_COLUMNS['departments'])} FROM bad_raw_departments)
GROUP BY ALL HAVING count(*) > 1""")
def _(w):
    return pf.exact_duplicates(w.damaged_raw["departments"], _dup_upper, _dup_lower)


@query("jn07_anti_left_null", f"""
SELECT DISTINCT {nid('d.facility_id')} AS unmatched_facility_id FROM bad_raw_departments d
LEFT JOIN clean_facilities f ON {nid('d.facility_id')} = f.facility_id WHERE {present('d.facility_id')} IS NOT NULL AND f.facility_id IS NULL""")
def _(w):
    return pf.unmatched_parents(w.damaged_raw["departments"], w.clean["facilities"], "facility_id")


# Cleaners

@query("cl00_mappings", "SELECT * FROM mappings")
def _(w):
    """Built twice, so the upsert must leave one row per rule."""
    return build_mappings(w.spark, w.domain, build_mappings(w.spark, w.domain))


@query("cl00b_mapping_usage", f"""
SELECT coalesce(m.mapping_group, u.g) AS mapping_group, coalesce(m.raw_value_normalised, u.v) AS raw_value_normalised, m.standard_value,
  coalesce(u.c, 0)::BIGINT AS raw_rows
FROM mappings m FULL JOIN ({union_all(
    f"SELECT '{g}' AS g, {key(g)} AS v, {n()} AS c FROM bad_raw_{t} WHERE {key(g)} IS NOT NULL GROUP BY 2" for g, t in MAPPED_COLUMNS.items())}) u
ON m.mapping_group = u.g AND m.raw_value_normalised = u.v""")
def _(w):
    """Raw rows behind every approved mapping, and raw values without one."""
    return mapping_usage(build_mappings(w.spark, w.domain), w.damaged_raw)


def _clean_query(table: str):
    return lambda w: w.clean[table]


def _wide_integers(table: str) -> str:
    """All columns of a clean table, whole numbers as BIGINT."""
    parts = [p.split() for p in schemas.CLEAN_DDL[table].split(",")]
    return ", ".join(f"{c}::BIGINT AS {c}" if kind in ("int", "smallint") else c for c, kind in parts)


for _i, _t in enumerate(TABLES, start=1):
    query(f"cl{_i:02d}_{_t}", f"SELECT {_wide_integers(_t)} FROM clean_{_t}")(_clean_query(_t))


# Rules over the damaged clean layer

@query("ct01_primary_key", union_all(
    f"SELECT '{t}' AS table_name, '{PK[t]}' AS key_columns, coalesce(sum(c) FILTER (WHERE k IS NULL), 0)::BIGINT AS null_key_rows, "
    f"{n_if('k IS NOT NULL AND c > 1')} AS duplicate_keys, coalesce(sum(c - 1) FILTER (WHERE k IS NOT NULL), 0)::BIGINT AS surplus_rows, "
    f"CASE WHEN count(*) FILTER (WHERE k IS NULL OR c > 1) = 0 THEN 'PASS' ELSE 'FAIL' END AS status "
    f"FROM (SELECT {PK[t]} AS k, count(*) AS c FROM bad_clean_{t} GROUP BY 1)"
    for t in TABLES))
def _(w):
    return ct.primary_keys({t: w.damaged_clean[t] for t in TABLES})


def _rule(table: str, kind: str, name: str, broken: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{kind}' AS rule_kind, '{name}' AS rule_name, {n_if(broken)} AS violations, "
        f"CASE WHEN count(*) FILTER (WHERE {broken}) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM bad_clean_{table}"
    )


def _clean_names(t: str) -> list[str]:
    return [p.split()[0] for p in schemas.CLEAN_DDL[t].split(",")]


_NOT_NULL = [_rule(t, "not_null", c, f"{c} IS NULL") for t in TABLES for c in _clean_names(t) if c not in schemas.NULLABLE[t]]


@query("ct02_not_null", union_all(_NOT_NULL))
def _(w):
    return ct.evaluate(w.damaged_clean, ct.not_null_rules())


_ALLOWED = [
    _rule(t, "allowed_values", c, f"{c} NOT IN ({', '.join(map(literal, v))})")
    for t, cs in schemas.value_lists(BOUND_DOMAIN).items() for c, v in cs.items()
]


@query("ct03_check_domain", union_all(_ALLOWED))
def _(w):
    return ct.evaluate(w.damaged_clean, ct.domain_rules(w.domain))


_RANGES = [_rule(t, "range", c, f"{c} <= 0") for t, cs in pf.POSITIVE_COLUMNS.items() for c in cs]
_RANGES += [_rule(t, "range", c, f"{c} NOT BETWEEN 1 AND 5") for t, (c, _s) in pf.SCORE_COLUMNS.items()]


@query("ct04_check_range", union_all(_RANGES))
def _(w):
    return ct.evaluate(w.damaged_clean, ct.range_rules())


_ORDERED = [
    ("departments", "urgent_target_days", "routine_target_days"), ("patients", "date_of_birth", "enrolment_date"),
    ("referrals", "referral_date", "first_appointment_date"), ("referrals", "referral_date", "closed_date"),
    ("appointments", "check_in_time", "seen_time"), ("ed_visits", "arrival_time", "discharge_time"),
]


_ORDERS = [_rule(t, "order", f"{a} <= {b}", f"{a} > {b}") for t, a, b in _ORDERED]


@query("ct05_check_order", union_all(_ORDERS))
def _(w):
    return ct.evaluate(w.damaged_clean, ct.order_rules())


_BOUNDS = [
    _rule("patients", "date_bounds", "date_of_birth", f"date_of_birth NOT BETWEEN DATE '1900-01-01' AND {SNAPSHOT}"),
    _rule("patients", "date_bounds", "enrolment_date", f"enrolment_date > {SNAPSHOT}"),
]


@query("ct06_check_date_bounds", union_all(_BOUNDS))
def _(w):
    return ct.evaluate(w.damaged_clean, ct.date_bound_rules(w.domain))


_LENGTHS = [
    _rule(t, "max_length", f"{c} <= {limit}", f"length({c}) > {limit}")
    for t, cs in schemas.MAX_LENGTHS.items() for c, limit in cs.items()
]


@query("ct07_max_length", union_all(_LENGTHS))
def _(w):
    return ct.evaluate(w.damaged_clean, ct.length_rules())


_READABLE = [
    _rule(t, "readable", c, f"NOT {sentinel(c, schemas.VALUE_SENTINELS)} AND {read(c)} IS NULL").replace("bad_clean_", "bad_raw_")
    for columns, read in ((schemas.READ_AS_DATE, to_date), (schemas.READ_AS_TIME, to_ts)) for t, cs in columns.items() for c in cs
]


@query("ct08_readable", union_all(_READABLE))
def _(w):
    """Dates and times that no accepted form reads; counted while the damaged tables were written."""
    return gates.stored_rules(w.checks()).where("rule_kind = 'readable'")


@query("ct09_gate_counts", union_all([*_NOT_NULL, *_ALLOWED, *_RANGES, *_ORDERS, *_BOUNDS, *_LENGTHS, *_READABLE]))
def _(w):
    """Every row rule, as counted while the damaged tables were written: no table is read again."""
    return gates.stored_rules(w.checks())


@query("ct10_gate_flags", union_all(
    f"SELECT '{t}' AS table_name, '{f}' AS flag_name, {n_if(f)} AS flagged_rows FROM bad_clean_{t}"
    for t, fs in schemas.QUALITY_FLAGS.items() for f in fs))
def _(w):
    return gates.stored_flags(w.checks())


@query("ct11_gate_completeness", union_all(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {n()} AS total_rows, {n_if(c + ' IS NULL')} AS missing_rows FROM bad_clean_{t}"
    for t in TABLES for c in _clean_names(t)))
def _(w):
    return gates.stored_completeness(w.checks())


@query("ag12_stacked_rules", union_all(
    _rule("referrals", kind, name, broken) for kind, name, broken in [
        ("not_null", "referral_date", "referral_date IS NULL"), ("not_null", "referral_status", "referral_status IS NULL"),
        ("range", "priority_score", "priority_score NOT BETWEEN 1 AND 5"),
        ("order", "referral_date <= closed_date", "referral_date > closed_date")]))
def _(w):
    wanted = {"referral_date", "referral_status", "priority_score", "referral_date <= closed_date"}
    rules = [*ct.not_null_rules(), *ct.range_rules(), *ct.order_rules()]
    return ct.evaluate(w.damaged_clean, [r for r in rules if r.table == "referrals" and r.name in wanted])


# Validation after cleaning

@query("prj05_scalar_subquery", union_all(
    f"SELECT '{t}' AS table_name, (SELECT {n()} FROM raw_{t}) AS raw_rows, (SELECT {n()} FROM clean_{t}) AS clean_rows, "
    f"(SELECT {n()} FROM raw_{t}) - (SELECT {n()} FROM clean_{t}) AS removed_rows" for t in TABLES))
def _(w):
    return vl.reconcile_counts(w.raw, w.clean)


@query("vl02_uniqueness", union_all(
    f"SELECT '{t}' AS table_name, {n()} AS total_rows, {n('DISTINCT ' + PK[t])} AS unique_ids FROM clean_{t}" for t in TABLES))
def _(w):
    return vl.uniqueness(w.clean)


@query("vl03_missing_required", union_all(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {n_if(c + ' IS NULL')} AS missing_rows FROM bad_clean_{t}"
    for t in TABLES for c in _clean_names(t)
    if c not in schemas.NULLABLE[t] and c not in schemas.QUALITY_FLAGS.get(t, ())))
def _(w):
    return vl.missing_required(w.damaged_clean)


@query("vl04_flag_totals", union_all(
    f"SELECT '{t}' AS table_name, '{f}' AS flag_name, {n_if(f)} AS flagged_rows FROM clean_{t}"
    for t, fs in schemas.QUALITY_FLAGS.items() for f in fs))
def _(w):
    return vl.flag_totals(w.clean)


def _both(flag: str, value: str) -> str:
    return f"({flag} AND {value} IS NOT NULL) OR (NOT {flag} AND {value} IS NULL)"


_AGREEMENT = {
    "patients": {
        "ethnicity_missing_flag": _both("ethnicity_missing_flag", "ethnicity"),
        "date_of_birth_issue_flag": _both("date_of_birth_issue_flag", "date_of_birth"),
        "deprivation_quintile_issue_flag": _both("deprivation_quintile_issue_flag", "deprivation_quintile"),
    },
    "referrals": {f"{c}_issue_flag": _both(f"{c}_issue_flag", c) for c in ("patient_id", "department_id", "urgency", "priority_score")},
    "appointments": {
        "patient_id_issue_flag": _both("patient_id_issue_flag", "patient_id"),
        "department_id_issue_flag": _both("department_id_issue_flag", "department_id"),
        "referral_id_issue_flag": "referral_id_issue_flag AND referral_id IS NOT NULL",
        "timeline_issue_flag": "timeline_issue_flag AND seen_time IS NOT NULL",
        "status_timestamp_issue_flag":
            "appointment_status = 'Completed' AND NOT status_timestamp_issue_flag AND (check_in_time IS NULL OR seen_time IS NULL)",
    },
    "ed_visits": {
        "patient_id_issue_flag": _both("patient_id_issue_flag", "patient_id"),
        "facility_id_issue_flag": _both("facility_id_issue_flag", "facility_id"),
        "triage_category_issue_flag": _both("triage_category_issue_flag", "triage_category"),
        "timeline_issue_flag": "timeline_issue_flag AND discharge_time IS NOT NULL",
        "missing_discharge_time_flag": "missing_discharge_time_flag AND discharge_time IS NOT NULL",
    },
}


@query("vl05_flag_agreement", union_all(
    f"SELECT '{t}' AS table_name, '{f}' AS flag_name, {n_if(p)} AS mismatched_rows FROM bad_clean_{t}"
    for t, fs in _AGREEMENT.items() for f, p in fs.items()))
def _(w):
    return vl.flag_agreement(w.damaged_clean)


@query("vl06_timeline_clean", union_all(
    f"SELECT '{t}' AS table_name, '{b} < {a}' AS rule_name, {n_if(f'{b} < {a}')} AS remaining_rows FROM clean_{t}"
    for t, a, b in _ORDERED[2:]))
def _(w):
    return vl.remaining_timelines(w.clean)


@query("vl07_admission_mismatch", """
SELECT * REPLACE (triage_category::BIGINT AS triage_category) FROM bad_clean_ed_visits
WHERE (disposition = 'Admitted' AND NOT admitted_flag) OR (disposition <> 'Admitted' AND admitted_flag)""")
def _(w):
    return vl.admission_mismatches(w.damaged_clean["ed_visits"])


def _review_value(c: str) -> str:
    return f"coalesce({c}::VARCHAR, '[NULL]')"


@query("vl08_category_review", union_all(
    f"SELECT '{t}' AS table_name, '{', '.join(g)}' AS categories, concat_ws(', ', {', '.join(map(_review_value, g))}) AS category_values, "
    f"{n()} AS record_count FROM clean_{t} GROUP BY 3"
    for t, groups in vl.REVIEWED.items() for g in groups))
def _(w):
    return vl.category_review(w.clean)


@query("vl09_completeness", f"""
SELECT {n()} AS total_rows, {n_if('ethnicity IS NULL')} AS missing_rows, {pct('count(ethnicity)', 'count(*)')} AS completeness_percentage
FROM clean_patients""")
def _(w):
    return vl.completeness(w.clean["patients"], "ethnicity")


@query("vl10_flagged_rows", f"""
SELECT {_wide_integers('patients')} FROM clean_patients WHERE ethnicity_missing_flag OR date_of_birth_issue_flag OR deprivation_quintile_issue_flag""")
def _(w):
    return vl.flagged_rows("patients", w.clean["patients"])


@query("vl11_referential_integrity", union_all(
    f"SELECT '{c}' AS child_table, '{k}' AS foreign_key_column, '{p}' AS parent_table, {n()} AS orphan_rows FROM bad_clean_{c} c "
    f"WHERE c.{k} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM bad_clean_{p} p WHERE p.{k} = c.{k})"
    for c, k, p in schemas.RELATIONSHIPS))
def _(w):
    return vl.referential_integrity(w.damaged_clean)


@query("vl12_cross_table_consistency", f"""
SELECT *, CASE WHEN patient_mismatch_count = 0 AND department_mismatch_count = 0 AND appointment_before_referral_count = 0
  THEN 'PASS' ELSE 'REVIEW' END AS validation_status
FROM (SELECT {n()} AS linked_appointment_count, {n_if('a.patient_id <> r.patient_id')} AS patient_mismatch_count,
    {n_if('a.department_id <> r.department_id')} AS department_mismatch_count,
    {n_if('a.scheduled_datetime::DATE < r.referral_date')} AS appointment_before_referral_count
  FROM clean_appointments a JOIN clean_referrals r ON a.referral_id = r.referral_id)""")
def _(w):
    return vl.cross_table_consistency(w.clean)


_births = [("Referral before patient birth", "referrals", "referral_date"),
           ("Appointment before patient birth", "appointments", "scheduled_datetime"),
           ("ED visit before patient birth", "ed_visits", "arrival_time")]


@query("vl13_event_before_birth", f"""
SELECT validation_rule, issue_count, CASE WHEN issue_count = 0 THEN 'PASS' ELSE 'REVIEW' END AS validation_status FROM (
{union_all(f"SELECT '{rule}' AS validation_rule, {n()} AS issue_count FROM clean_{t} e JOIN clean_patients p ON e.patient_id = p.patient_id WHERE e.{c}::DATE < p.date_of_birth" for rule, t, c in _births)})""")
def _(w):
    return vl.event_before_birth(w.clean)


_models = [("Referrals analytical join", "referrals", ["patients", "departments"]),
           ("Appointments analytical join", "appointments", ["patients", "departments", "referrals"]),
           ("ED visits analytical join", "ed_visits", ["patients", "facilities"])]


def _inflation(rule: str, fact: str, dims: list[str]) -> str:
    joins = " ".join(f"LEFT JOIN bad_clean_{d} d{i} ON f.{PK[d]} = d{i}.{PK[d]}" for i, d in enumerate(dims))
    return f"""SELECT '{rule}' AS validation_rule, b AS base_row_count, j AS joined_row_count, j - b AS unexpected_additional_rows,
  CASE WHEN b = j THEN 'PASS' ELSE 'REVIEW' END AS validation_status
FROM (SELECT (SELECT {n()} FROM bad_clean_{fact}) AS b, (SELECT {n()} FROM bad_clean_{fact} f {joins}) AS j)"""


@query("vl14_join_inflation", union_all(_inflation(*m) for m in _models))
def _(w):
    """Over the damaged tables, whose repeated parent keys do inflate the joins."""
    return vl.model_inflation(w.damaged_clean)


def _ready(name: str, table: str, candidate: str, eligible: str) -> str:
    return f"SELECT '{name}' AS metric_name, {n_if(candidate)} AS c, {n_if(f'({candidate}) AND {eligible}')} AS e FROM clean_{table}"


@query("vl15_kpi_readiness", f"""
SELECT metric_name, c AS candidate_records, e AS eligible_records, c - e AS excluded_records, {pct('e', 'c')} AS eligible_percentage FROM (
{union_all([
    _ready('Appointment waiting time', 'appointments', "appointment_status = 'Completed'",
           'check_in_time IS NOT NULL AND seen_time IS NOT NULL AND NOT status_timestamp_issue_flag AND NOT timeline_issue_flag AND department_id IS NOT NULL'),
    _ready('Referral time to first appointment', 'referrals', "referral_status IN ('Completed', 'Booked')",
           'first_appointment_date >= referral_date AND department_id IS NOT NULL'),
    _ready('Open referral backlog', 'referrals', "referral_status IN ('Open', 'Waiting')",
           f'referral_date <= {SNAPSHOT} AND department_id IS NOT NULL'),
    _ready('ED length of stay', 'ed_visits', 'TRUE', 'discharge_time IS NOT NULL AND NOT timeline_issue_flag AND facility_id IS NOT NULL'),
])})""")
def _(w):
    return vl.kpi_readiness(w.clean, w.domain)


@query("vl16_negative_waits", f"""
SELECT {n_if(f"referral_date > {SNAPSHOT}")} AS negative_wait_rows FROM clean_referrals WHERE referral_status IN ('Open', 'Waiting')""")
def _(w):
    return vl.negative_waits(w.clean, w.domain)


# Keyed upsert of regional bed capacities: incoming rows win

@query("snk03_upsert", """
SELECT facility_id, facility_name, bed_capacity::BIGINT AS bed_capacity FROM clean_facilities WHERE bed_capacity IS NULL
UNION ALL SELECT facility_id, upper(facility_name), bed_capacity + 1 FROM clean_facilities WHERE bed_capacity IS NOT NULL
UNION ALL SELECT 'N' || department_id, department_name, routine_target_days FROM clean_departments""")
def _(w):
    base = w.clean["facilities"].select("facility_id", "facility_name", "bed_capacity")
    changed = base.where(F.col("bed_capacity").isNotNull()).select(
        "facility_id", F.upper("facility_name").alias("facility_name"), (F.col("bed_capacity") + 1).alias("bed_capacity")
    )
    new = w.clean["departments"].select(
        F.concat(F.lit("N"), "department_id").alias("facility_id"), F.col("department_name").alias("facility_name"),
        F.col("routine_target_days").alias("bed_capacity"),
    )
    return upsert(base, changed.unionByName(new), ["facility_id"])


_LATE = "referral_date >= DATE '2000-06-01' AND referral_status = 'Open'"


@query("snk03b_keyed_upsert", f"""
SELECT referral_id, department_id, CASE WHEN {_LATE} THEN 'Waiting' ELSE referral_status END AS referral_status FROM clean_referrals
UNION ALL SELECT 'N' || referral_id, department_id, 'Booked' FROM clean_referrals WHERE {_LATE}""")
def _(w):
    """Late open referrals become waiting, and each brings a new one; only the parts of these keys are written again."""
    columns = ["referral_id", "department_id", "referral_status"]
    table = KeyedTable(w.layers, "analytics", "referral_states", ["referral_id"])
    base = w.clean["referrals"].select(*columns)
    table.rebuild(base, parts=16)
    late = w.clean["referrals"].where(_LATE).select("referral_id", "department_id")
    new = late.select(F.concat(F.lit("N"), "referral_id").alias("referral_id"), "department_id", F.lit("Booked").alias("referral_status"))
    incoming = late.withColumn("referral_status", F.lit("Waiting")).unionByName(new)
    table.upsert(incoming)
    return table.upsert(incoming)


@query("vl16_final_review", union_all(
    f"SELECT '{t}' AS table_name, {PK[t]} AS row_key, row_number() OVER (ORDER BY {PK[t]} NULLS LAST) AS review_position FROM bad_clean_{t}"
    for t in TABLES))
def _(w):
    """All rows of all tables in key order; damaged rows include repeated and missing keys."""
    parts = [
        vl.final_review(t, w.damaged_clean[t]).select(F.lit(t).alias("table_name"), F.col(PK[t]).alias("row_key"), "review_position")
        for t in TABLES
    ]
    return reduce(DataFrame.unionByName, parts)
