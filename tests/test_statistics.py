"""Column statistics in the catalog, and a plan that changes with them."""

import pytest
from pyspark.sql import functions as F

from opsward import schemas
from opsward.sources import statistics
from opsward.sources.access import table_name
from opsward.sources.layers import Layers


@pytest.fixture
def layers(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "base"))
    given = {
        "referral_id": F.concat(F.lit("R"), F.lpad(F.col("id").cast("string"), 7, "0")),
        "patient_id": F.when(F.col("id") % 4 != 0, F.concat(F.lit("P"), (F.col("id") % 900).cast("string"))),
        "referral_date": F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 200).cast("int")),
        "referral_status": F.when(F.col("id") % 500 == 0, "Cancelled").otherwise("Open"),
    }
    df = spark.range(20_000).select(*[given.get(c, F.lit(None)).alias(c) for c in schemas.clean_columns("referrals")])
    layers.write_clean("referrals", df)
    yield layers
    statistics.forget(layers, "referrals")
    spark.conf.unset("spark.sql.cbo.enabled")


def test_counts_of_the_catalog(spark, layers):
    statistics.refresh(layers, ["referrals"])
    found = {r.column_name: r for r in statistics.column_statistics(layers, {"referrals": statistics.ANALYSED["referrals"]}).collect()}
    assert len(found) == len(statistics.ANALYSED["referrals"]) and {r.row_count for r in found.values()} == {20_000}
    assert (found["patient_id"].null_count, found["referral_status"].distinct_count) == (5000, 2)
    assert abs(found["referral_id"].distinct_count - 20_000) < 3000
    assert (found["referral_date"].min, found["referral_date"].max) == ("2026-01-01", "2026-07-19")
    # A rebuild is seen after the next refresh.
    few = spark.createDataFrame(layers.read("clean", "referrals").limit(10).collect(), schemas.CLEAN_DDL["referrals"])
    layers.write_clean("referrals", few)
    statistics.refresh(layers, ["referrals"])
    assert statistics.column_statistics(layers, {"referrals": ["referral_id"]}).first().row_count == 10


def test_a_plan_changes_with_them(spark, layers):
    """The hundred referrals of one day are few enough to broadcast, which the size of the files cannot tell."""

    def joined(referrals):
        day = referrals.where("referral_date = DATE '2026-01-01'").select("referral_id", "patient_id")
        return referrals.select("referral_id", "department_id").join(day, "referral_id")

    def plan(df):
        return df._jdf.queryExecution().sparkPlan().toString()

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        unknown = joined(layers.read("clean", "referrals"))
        assert "SortMergeJoin" in plan(unknown)
        statistics.refresh(layers, ["referrals"])
        known = joined(statistics.open_table(layers, "referrals"))
        assert "BroadcastHashJoin" in plan(known)
        assert sorted(map(str, known.collect())) == sorted(map(str, unknown.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_without_statistics_the_files_are_read(spark, layers):
    assert statistics.open_table(layers, "referrals").count() == 20_000
    assert not spark.catalog.tableExists(table_name(layers, "referrals"))
