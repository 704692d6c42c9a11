"""Access paths: buckets, hot keys apart, pruned lookups, windows without a shuffle."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from opsward import schemas
from opsward.catalog import run
from opsward.plans import questions
from opsward.schemas import Domain
from opsward.sources import access
from opsward.sources.layers import Layers


@pytest.fixture(scope="module")
def visits(spark):
    start = dt.datetime(2026, 1, 1)
    rows = [
        (f"V{i:05d}", None if i % 50 == 7 else "P-hot" if i % 3 == 0 else f"P{i % 211}", start + dt.timedelta(hours=i % 97),
         start + dt.timedelta(hours=i % 97, minutes=i % 60) if i % 4 else None)
        for i in range(4000)
    ]
    columns = spark.createDataFrame(rows, "visit_id string, patient_id string, arrival_time timestamp_ntz, discharge_time timestamp_ntz")
    fields = [part.strip().split(" ") for part in schemas.CLEAN_DDL["ed_visits"].split(",")]
    return columns.select(*[(F.col(c) if c in columns.columns else F.lit(None)).cast(kind).alias(c) for c, kind in fields]).cache()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", [False, True])
def test_rows_come_back_and_open_again(spark, visits, tmp_path, hot):
    layers = Layers(spark, str(tmp_path / f"base-{hot}"))
    limits = {"share": 5, "min_rows": 100, "range_rows": 200} if hot else {}
    written = access.write_access(layers, "ed_visits_by_patient", visits, buckets=16, **limits)
    wanted = sorted(map(str, visits.where("patient_id IS NOT NULL").collect()))
    assert sorted(map(str, written.every().collect())) == wanted
    assert (written.hot is not None) == hot and written.placed().where("misplaced").count() == 0
    if hot:
        assert {r[0] for r in written.hot.select("patient_id").distinct().collect()} == {"P-hot"}
        assert written.rows.where("patient_id = 'P-hot'").count() == 0
        assert written.hot.groupBy("__range").count().agg(F.max("count")).first()[0] < 800
    spark.sql(f"DROP TABLE {access.table_name(layers, 'ed_visits_by_patient')}")  # as in a new application
    again = access.open_access(layers, "ed_visits_by_patient")
    assert sorted(map(str, again.every().collect())) == wanted and again.buckets == 16
    assert sorted(map(str, again.history("P-hot", "P5").collect())) == sorted(map(str, visits.where("patient_id IN ('P-hot', 'P5')").collect()))
    access.write_access(layers, "ed_visits_by_patient", visits.limit(10), buckets=8)
    assert access.open_access(layers, "ed_visits_by_patient").every().count() == 10 - visits.limit(10).where("patient_id IS NULL").count()


@pytest.mark.parametrize("ignore_nulls", [False, True])
def test_previous_visit_needs_no_shuffle(spark, visits, tmp_path, ignore_nulls):
    layers = Layers(spark, str(tmp_path / "base"))
    plain = {"ed_visits": visits}
    wanted = sorted(map(str, questions.visits_with_previous_discharge(plain, ignore_nulls=ignore_nulls).collect()))
    stored = {"ed_visits": visits, "ed_visits_by_patient": access.write_access(layers, "ed_visits_by_patient", visits, buckets=16)}
    found = questions.visits_with_previous_discharge(stored, ignore_nulls=ignore_nulls)
    assert "Exchange" not in plan_of(found) and "Window" in plan_of(found)
    assert sorted(map(str, found.collect())) == wanted
    hot = access.write_access(layers, "ed_visits_by_patient", visits, buckets=16, share=5, min_rows=100, range_rows=200)
    found = questions.visits_with_previous_discharge({"ed_visits_by_patient": hot}, ignore_nulls=ignore_nulls)
    assert sorted(map(str, found.collect())) == wanted


def test_a_lookup_reads_one_bucket(spark, visits, tmp_path):
    stored = access.write_access(Layers(spark, str(tmp_path / "base")), "ed_visits_by_patient", visits, buckets=16)
    key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(key, "false")  # else the plan does not name the buckets it reads
    try:
        assert "SelectedBucketsCount: 1 out of 16" in plan_of(stored.history("P5"))
    finally:
        spark.conf.unset(key)
    found = stored.history("P5")
    assert found.rdd.getNumPartitions() == 1 < stored.every().rdd.getNumPartitions()
    assert found.count() == visits.where("patient_id = 'P5'").count()


def test_tables_by_one_key_join_without_a_shuffle(spark, visits, tmp_path):
    layers = Layers(spark, str(tmp_path / "base"))
    left = access.write_access(layers, "ed_visits_by_patient", visits, buckets=16).rows.select("patient_id", "visit_id")
    referrals = visits.select(F.col("visit_id").alias("referral_id"), "patient_id", F.col("arrival_time").cast("date").alias("referral_date"))
    right = access.write_access(layers, "referrals_by_patient", referrals, buckets=16).rows
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan_of(left.join(right, "patient_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_bucket_number():
    assert access.bucket_number(1) == 8 and access.bucket_number(3 << 30) == 16 and access.bucket_number(100 << 40) == 65_536


def test_registered_questions_shuffle_no_visit(spark):
    for name in ("bq14_return_within_window", "dm15_return_by_segment", "wn01_lag"):
        below = plan_of(run(name, spark, "/root/testdata/sf0.001")).split("Window")[-1].split("Scan parquet")[0]
        assert "Sort" in below and "Exchange" not in below, name


def test_empty_table(spark, visits, tmp_path):
    stored = access.write_access(Layers(spark, str(tmp_path / "base")), "ed_visits_by_patient", visits.limit(0), buckets=8)
    assert stored.every().count() == 0 and stored.previous("discharge_time", "before", ["visit_id"]).count() == 0
    assert questions.return_within_window({"ed_visits_by_patient": stored, "facilities": spark.createDataFrame([], schemas.CLEAN_DDL["facilities"])}, Domain()).count() == 0


def test_buckets_are_sized_by_rows_in_memory(spark, visits, tmp_path, monkeypatch):
    monkeypatch.setattr(access, "scan_bytes", lambda df: 1 << 30)
    stored = access.write_access(Layers(spark, str(tmp_path / "base")), "ed_visits_by_patient", visits.limit(0))
    assert stored.buckets == 64
