"""Cleaners against hand-written expectations, and rules that stop or quarantine."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from opsward import schemas
from opsward.plans import cleaning, constraints, mappings, validation
from opsward.schemas import Domain

DOMAIN = Domain()

# The two published raw tables, as text.
FACILITIES = [
    ("F001", "Kowhai Central Hospital", "Northern", "Auckland", "Tertiary Hospital", "480"),
    ("F002", "Waitemata Community Hospital", " northern ", "Henderson", "Community Hospital", "220"),
    ("F003", "Rimu Regional Hospital", "Midland", "Hamilton", "Regional Hospital", "360"),
    ("F004", "Lakes District Hospital", "Midland", "Rotorua", "Regional Hospital", "190"),
    ("F005", "Harbour Regional Hospital", "CENTRAL", "Wellington", "Tertiary Hospital", "410"),
    ("F006", "Manawatu Health Centre", "Central", "Palmerston North", "Community Hospital", "175"),
    ("F007", "Pounamu Regional Hospital", "Southern", "Christchurch", "Tertiary Hospital", "430"),
    ("F008", "Otago Valley Hospital", "southern ", "Dunedin", "Regional Hospital", "260"),
    ("F004", "Lakes District Hospital", "Midland", "Rotorua", "Regional Hospital", "190"),
]
DEPARTMENTS = [
    ("D004", "F001", "Gastroenterology", "Medical", "100", "28", "30"),
    ("D005", "F001", "Respiratory", "Medical", "90", "21", "30"),
    ("D006", "F002", " orthopaedics ", "Surgical", "120", "28", "30"),
    ("D020", "F004", "ENT", "Surgical", "100", "28", "25"),
    ("D038", "F008", " orthopaedics ", "Surgical", "120", "28", "30"),
    ("D039", "F008", " general surgery ", "Surgical", "100", "21", "30"),
    ("D005", "F001", "Respiratory", "Medical", "90", "21", "30"),
    ("D038", "F008", " orthopaedics ", "Surgical", "120", "28", "30"),
]


def raw(spark, table, rows):
    return spark.createDataFrame(rows, schemas.raw_schema(table))


@pytest.fixture(scope="module")
def maps(spark):
    return mappings.build_mappings(spark, DOMAIN)


@pytest.fixture(scope="module")
def clean(spark, maps):
    facilities = cleaning.clean_facilities(raw(spark, "facilities", FACILITIES), maps)
    departments = cleaning.clean_departments(raw(spark, "departments", DEPARTMENTS))
    patients = cleaning.clean_patients(
        raw(spark, "patients", [
            (" p000001", "1990-02-03", "M", "maori", "city one", "3", "2020-01-01"),
            ("P000001", "1990-02-03 ", " m", "Maori ", "City One", "3", "2020-01-01"),
            ("P000002", "1899-12-31", "Gender-Diverse", "N/A", "x", "9", "2020-01-01"),
            ("P000003", "n/a", "f", "", "x", None, "2020-01-01"),
        ]), maps, DOMAIN)
    return {"facilities": facilities, "departments": departments, "patients": patients, "reference_mappings": maps}


def test_mapping_table_has_24_rules(maps):
    assert maps.count() == 24


def test_facilities_golden(clean):
    found = clean["facilities"]
    assert found.count() == 8
    regions = {r.hospital_region: r["count"] for r in found.groupBy("hospital_region").count().collect()}
    assert regions == {"Northern": 2, "Midland": 2, "Central": 2, "Southern": 2}
    assert found.where("facility_id = 'F004'").first().bed_capacity == 190


def test_departments_golden(clean):
    found = {r.department_id: r for r in clean["departments"].collect()}
    assert len(found) == 6
    assert found["D006"].department_name == "Orthopaedics" and found["D020"].department_name == "ENT"
    assert found["D039"].department_name == "General Surgery" and found["D039"].urgent_target_days == 21


def test_patients_collapse_after_cleaning(clean):
    assert clean["patients"].count() == 3
    found = {r.patient_id: r for r in clean["patients"].collect()}
    first, second, third = found["P000001"], found["P000002"], found["P000003"]
    assert (first.gender, first.ethnicity, first.city) == ("Male", "Maori", "City One")
    assert first.date_of_birth == dt.date(1990, 2, 3) and not first.date_of_birth_issue_flag
    assert second.gender == "Gender Diverse" and second.date_of_birth is None and second.date_of_birth_issue_flag
    assert second.deprivation_quintile_issue_flag and second.ethnicity_missing_flag
    assert third.gender is None  # not an approved spelling; the NOT NULL rule reports it


def test_referrals(spark, clean, maps):
    found = cleaning.clean_referrals(
        raw(spark, "referrals", [
            ("R0000001", " p000001", "D005", "2026-01-10", "urgent", "Waiting ", "2026-01-05", None, "self-referral", "2"),
            ("R0000001", "P000001", "d005", "2026-01-10", "URGENT", "waiting", "2026-01-01", "", "Self-Referral", "2"),
            ("R0000002", "P999999", None, "2026-01-10", "asap", "decline", "2026-02-01", "2026-01-10", "gp", "9"),
        ]), clean["patients"], clean["departments"], maps).orderBy("referral_id").collect()
    assert len(found) == 2  # the two impossible dates are dropped, which makes the rows equal
    first, second = found
    assert first.timeline_issue_flag and first.first_appointment_date is None and first.referral_source == "Self-Referral"
    assert (second.patient_id, second.department_id, second.urgency, second.priority_score) == (None,) * 4
    assert second.patient_id_issue_flag and second.department_id_issue_flag and second.urgency_issue_flag
    assert second.referral_status == "Declined" and second.closed_date == dt.date(2026, 1, 10)
    assert not second.timeline_issue_flag


def test_appointments(spark, clean, maps):
    referrals = spark.createDataFrame([("R0000001",)], "referral_id string")
    at = "2026-01-10 09:{:02d}:00"
    found = cleaning.clean_appointments(
        raw(spark, "appointments", [
            ("A1", "P000001", "D005", "", at.format(0), at.format(5), at.format(9), "completed", "FOLLOW-UP", "phone"),
            ("A2", "P000001", "D005", "R9", at.format(0), at.format(5), at.format(1), "Completed", "procedure", "clinic"),
            ("A3", "P000001", "D005", "r0000001", at.format(0), None, at.format(9), "no-show", "x", "clinic"),
        ]), clean["patients"], clean["departments"], referrals, maps).orderBy("appointment_id").collect()
    first, second, third = found
    assert first.appointment_type == "Follow-up" and not first.referral_id_issue_flag and not first.status_timestamp_issue_flag
    assert second.referral_id is None and second.referral_id_issue_flag
    assert second.seen_time is None and second.timeline_issue_flag and second.status_timestamp_issue_flag
    assert third.seen_time is not None and third.referral_id == "R0000001" and third.appointment_type is None
    assert third.appointment_status == "No Show" and third.status_timestamp_issue_flag is False


def test_ed_visits(spark, clean):
    at = "2026-01-10 {:02d}:00:00"
    found = cleaning.clean_ed_visits(
        raw(spark, "ed_visits", [
            ("V1", "P000001", "f001", at.format(9), "3", at.format(8), "admitted", "no", "injury"),
            ("V2", None, "F999", at.format(9), "urgent", None, "left before treatment", "no", " cardiac"),
            ("V3", "P000002", "F002", at.format(9), "5", None, None, "yes", "other"),
        ]), clean["patients"], clean["facilities"]).orderBy("visit_id").collect()
    first, second, third = found
    assert first.timeline_issue_flag and first.discharge_time is None and first.admission_consistency_issue_flag
    assert not first.missing_discharge_time_flag
    assert second.missing_discharge_time_flag is False and second.triage_category_issue_flag
    assert second.facility_id_issue_flag and second.patient_id_issue_flag and not second.admission_consistency_issue_flag
    assert third.missing_discharge_time_flag is None and third.admission_consistency_issue_flag


def test_cleaning_clean_text_changes_nothing(spark, clean, maps):
    again = cleaning.clean_facilities(clean["facilities"].select(*[F.col(c).cast("string") for c in clean["facilities"].columns]), maps)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, clean["facilities"].collect()))


def test_require_stops_and_quarantine_splits(clean):
    rules = constraints.row_rules(DOMAIN)
    own = [r for r in rules if r.table == "patients"]
    with pytest.raises(constraints.RuleViolation, match="patients not_null gender: 1"):
        constraints.require({"patients": clean["patients"]}, own)
    good, bad = constraints.quarantine("patients", clean["patients"], rules)
    assert {r.patient_id for r in good.collect()} == {"P000001", "P000002"}
    assert [(r.patient_id, r.broken_rules) for r in bad.collect()] == [("P000003", ["not_null: gender"])]
    repeated = good.unionByName(good.where("patient_id = 'P000001'").withColumn("city", F.lit("Elsewhere")))
    good, bad = constraints.quarantine("patients", repeated, rules)
    assert {r.patient_id for r in good.collect()} == {"P000002"} and bad.count() == 2


def test_row_rules_count():
    kinds = [r.kind for r in constraints.row_rules(DOMAIN)]
    checks = ("allowed_values", "range", "order", "date_bounds")
    assert sum(k in checks for k in kinds) == 27


def test_flag_mismatch_rows_finds_a_lie(clean):
    lying = clean["patients"].withColumn("ethnicity_missing_flag", F.lit(True))
    assert validation.flag_mismatch_rows("patients", clean["patients"]).count() == 0
    assert [r.patient_id for r in validation.flag_mismatch_rows("patients", lying).collect()] == ["P000001"]


def test_every_form_of_a_time_is_tried_once(spark, clean, maps):
    rows = raw(spark, "appointments", [("A1", "P000001", "D005", "", "2026-01-01 09:00:00", None, "", "completed", "procedure", "phone")])
    referrals = spark.createDataFrame([], schemas.CLEAN_DDL["referrals"])
    found = cleaning.clean_appointments(rows, clean["patients"], clean["departments"], referrals, maps, DOMAIN)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    forms = len(DOMAIN.time_formats) + len(DOMAIN.date_formats)
    assert plan.count("gettimestamp(") == 3 * forms
