"""Joins and aggregates with one key, or no key, on a third of the rows."""

import pytest
from pyspark.sql import functions as F

from opsward.operators.joins import enrich, orphan_counts, resolve_fk
from opsward.operators.rollups import sums_by_dimension

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_thresholds(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(params=["hot", None])
def fact(spark, request, tmp_path):
    key = F.when(F.col("id") % 3 == 0, F.lit(request.param)).otherwise(F.concat(F.lit("p"), F.col("id") % 5000))
    rows = spark.range(300_000).select("id", key.alias("patient_id"), F.sha2(F.col("id").cast("string"), 256).alias("note"))
    rows.write.parquet(str(tmp_path / "fact"))
    return spark.read.parquet(str(tmp_path / "fact"))


@pytest.fixture
def dim(spark):
    return spark.range(5000).select(
        F.concat(F.lit("p"), "id").alias("patient_id"), (F.col("id") % 5).alias("quintile")
    ).unionByName(spark.createDataFrame([("hot", 9)], "patient_id string, quintile long"))


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_join_splits_the_hot_partition(spark, small_thresholds, fact, dim):
    joined = enrich(fact, [(dim, "patient_id")]).select("id", "patient_id", "note", "quintile")
    rows = joined.collect()
    assert len(rows) == 300_000
    assert "skew=true" in final_plan(joined)


def test_key_resolution_splits_the_hot_partition(spark, small_thresholds, fact, dim):
    found = resolve_fk(fact.withColumnRenamed("patient_id", "k"), dim, "k", "patient_id", "issue")
    counts = {r.issue: r["count"] for r in found.groupBy("issue").count().collect()}
    hot_is_known = fact.where("patient_id = 'hot'").count() > 0
    assert counts.get(True, 0) == (0 if hot_is_known else 100_000)


def test_sums_shuffle_one_row_per_key_and_task(spark, small_thresholds, fact, dim):
    sums = sums_by_dimension(fact, "patient_id", dim, ["quintile"], {"n": F.count("*")})
    assert sum(r.n for r in sums.collect()) == 300_000
    plan = final_plan(sums)
    scan_to_shuffle = plan[plan.rindex("partial_count"):]
    assert "Exchange" not in scan_to_shuffle.split("FileScan")[0]


def test_orphans_of_a_hot_key(spark, small_thresholds, fact, dim):
    known = dim.where("patient_id <> 'hot'")
    lost = {r.orphan_id: r.affected_rows for r in orphan_counts(fact, known, "patient_id", "patient_id").collect()}
    assert lost == ({"HOT": 100_000} if fact.where("patient_id = 'hot'").count() else {})
