"""The whole way from CSV files to answers."""

import datetime as dt

import pytest

from opsward import pipeline, schemas
from opsward.plans import constraints, questions
from opsward.schemas import Domain
from opsward.session import byte_size, scan_bytes, spread_shuffles
from opsward.sources.layers import Layers

ROWS = {
    "facilities": ["F001,Kowhai Central Hospital,Northern,Auckland,Tertiary Hospital,480",
                   "F001,Kowhai Central Hospital,northern ,Auckland,Tertiary Hospital,480"],
    "departments": ["D001,F001,Cardiology,Medical,90,21,30", "D002,F001, ent ,Surgical,100,28,25"],
    "patients": ["P000001,1980-01-01,Female,European,Auckland,2,2020-01-01",
                 "P000002,n/a,m,,Auckland,7,2020-01-01"],
    "referrals": ["R0000001,P000001,D001,2026-07-25,Urgent,Open,,,gp,1",
                  "R0000002,P000001,D001,2026-01-01,Routine,waiting,,,gp,3",
                  "R0000003,P000009,D002,2026-03-01,Semi-Urgent,Completed,2026-03-20,2026-04-01,gp,9"],
    "appointments": ["A0000001,P000001,D001,,2026-05-01 09:00:00,2026-05-01 08:50:00,2026-05-01 09:30:00,completed,follow-up,phone",
                     "A0000002,P000002,D001,,2026-05-02 09:00:00,,,no-show,procedure,clinic"],
    "ed_visits": ["V0000001,P000001,F001,2026-05-01 01:00:00,3,2026-05-01 05:00:00,Discharged,no,injury",
                  "V0000002,P000001,F001,2026-05-08 05:00:00,2,2026-05-08 06:00:00,Admitted,yes,cardiac",
                  "V0000003,P000001,F001,2026-05-15 06:00:01,2,,Left Before Treatment,no,cardiac"],
}


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for table, lines in ROWS.items():
        text = "\n".join([",".join(schemas.RAW_COLUMNS[table]), *lines]) + "\n"
        (folder / f"{table}_raw.csv").write_text(text, encoding="utf-8-sig")
    return folder


def test_csv_to_answers(spark, landing, tmp_path):
    domain, layers = Domain(), Layers(spark, str(tmp_path / "base"))
    raw = pipeline.load(layers, str(landing))
    pipeline.build_clean(layers, domain)
    clean = pipeline.open_clean(layers)
    assert clean["facilities"].count() == 1 and clean["reference_mappings"].count() == 24

    backlog = questions.backlog_by_department(clean, domain).collect()
    assert [tuple(r) for r in backlog] == [("Northern", "Kowhai Central Hospital", "Cardiology", 2, 109.5, 2, 1, 50.0)]
    bands = {(r.backlog_wait_band, r.referral_count) for r in questions.backlog_bands(clean, domain).collect()}
    assert bands == {("0-14 days", 1), ("Over 60 days", 1)}
    wait = questions.wait_target_by_department(clean, domain).first()
    assert (wait.average_waiting_minutes, wait.appointments_within_target) == (40.0, 0)
    # Seven days to the second count as a return, one second more does not.
    again = questions.return_within_window(clean, domain).first()
    assert tuple(again) == ("Kowhai Central Hospital", 2, 1, 50.0)

    checks = pipeline.report(raw, clean, domain)
    assert checks["rules"].where("status = 'FAIL'").count() == 0
    assert {r.orphan_rows for r in checks["references"].collect()} == {0}
    assert {r.unexpected_additional_rows for r in checks["join_inflation"].collect()} == {0}
    flags = {(r.table_name, r.flag_name): r.flagged_rows for r in checks["flag_totals"].collect()}
    assert flags["referrals", "patient_id_issue_flag"] == 1 and flags["patients", "date_of_birth_issue_flag"] == 1


def test_violations_stop_or_move(spark, landing, tmp_path):
    with open(landing / "patients_raw.csv", "a", encoding="utf-8") as f:
        f.write("P000003,1990-01-01,f,Asian,Napier,1,2020-01-01\n")
    domain, layers = Domain(), Layers(spark, str(tmp_path / "base"))
    pipeline.load(layers, str(landing))
    with pytest.raises(constraints.RuleViolation, match="patients not_null gender: 1"):
        pipeline.build_clean(layers, domain)
    clean = pipeline.build_clean(layers, domain, on_violation="quarantine")
    assert clean["patients"].count() == 2
    rejected = layers.read("clean_rejected", "patients").first()
    assert (rejected.patient_id, rejected.broken_rules) == ("P000003", ["not_null: gender"])
    with pytest.raises(ValueError):
        pipeline.build_clean(layers, domain, on_violation="ignore")


def test_large_parents_give_the_same_clean_rows(spark, landing, tmp_path):
    """Beyond the broadcast limit only keys without a parent are joined with the facts."""
    layers, domain = Layers(spark, str(tmp_path / "base")), Domain()
    pipeline.load(layers, str(landing))
    small = {t: sorted(map(str, df.collect())) for t, df in pipeline.build_clean(layers, domain).items()}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        other = Layers(spark, str(tmp_path / "other"))
        pipeline.load(other, str(landing))
        large = {t: sorted(map(str, df.collect())) for t, df in pipeline.build_clean(other, domain).items()}
        orphans = [r[0] for r in other.read("clean_orphans", "referrals_patient_id").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert large == small and orphans == ["P000009"]


def test_own_mappings_survive_a_rebuild(spark, landing, tmp_path):
    layers, domain = Layers(spark, str(tmp_path / "base")), Domain()
    approved = pipeline.refresh_mappings(layers, domain)
    extra = [("gender", "f", "Female"), ("gender", "male", "Wrong")]
    own = spark.createDataFrame(extra, schemas.CLEAN_DDL["reference_mappings"])
    kept = [tuple(r) for r in approved.where("raw_value_normalised <> 'male'").collect()]
    layers.write_clean("reference_mappings", own.unionByName(spark.createDataFrame(kept, own.schema)))
    found = {(r[0], r[1]): r[2] for r in pipeline.refresh_mappings(layers, domain).collect()}
    assert len(found) == 25 and found["gender", "f"] == "Female" and found["gender", "male"] == "Male"


def test_repeated_key_stops(spark, landing, tmp_path):
    with open(landing / "departments_raw.csv", "a", encoding="utf-8") as f:
        f.write("D001,F001,Cardiology,Medical,91,21,30\n")
    layers = Layers(spark, str(tmp_path / "base"))
    pipeline.load(layers, str(landing))
    with pytest.raises(constraints.RuleViolation, match="departments primary_key: 0 incomplete, 1 repeated"):
        pipeline.build_clean(layers, Domain())


def test_snapshot_is_a_parameter(spark, landing, tmp_path):
    layers = Layers(spark, str(tmp_path / "base"))
    pipeline.load(layers, str(landing))
    later = Domain(snapshot=dt.date(2026, 12, 1))
    clean = pipeline.build_clean(layers, later, clustered=False)
    bands = {r.backlog_wait_band for r in questions.backlog_bands(clean, later).collect()}
    assert bands == {"Over 60 days"}


def test_shuffle_sizing_only_raises(spark):
    key, split = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(split)
    try:
        spread_shuffles(spark, 1 << 20)
        assert spark.conf.get(key, None) is None
        spread_shuffles(spark, 100 << 40)
        assert spark.conf.get(key) == "32768" and byte_size(spark.conf.get(split)) == 512 << 20
        spread_shuffles(spark, 1 << 40)
        assert spark.conf.get(key) == "32768"
    finally:
        spark.conf.unset(key)
        spark.conf.set(split, before)
    assert byte_size("128m") == 128 << 20 and byte_size("4096b") == 4096
    assert scan_bytes(spark.range(10)) > 0
