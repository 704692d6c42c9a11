"""Positions in a total order, and the order the questions themselves return."""

import pytest
from pyspark.sql import functions as F

from opsward.catalog.workspace import workspace
from opsward.operators.ordering import with_position
from opsward.plans import questions as q

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("rows", [0, 1, 5000])
def test_positions_follow_the_order(spark, rows):
    df = spark.range(rows).select(F.when(F.col("id") % 9 != 0, F.col("id") * 37 % 101).alias("metric"), F.col("id").alias("name")).repartition(7)
    got = with_position(df, [F.col("metric").desc_nulls_first(), F.col("name")]).orderBy("position").collect()
    wanted = sorted(df.collect(), key=lambda r: (r.metric is not None, -(r.metric or 0), r.name))
    assert [(r.metric, r.name, r.position) for r in got] == [(r.metric, r.name, i) for i, r in enumerate(wanted, 1)]


def test_ranges_are_many_and_no_window_sees_the_rows(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    kept = {}

    def store(name, df):
        from opsward.session import stored

        kept[name] = stored(name, df)
        return kept[name]

    try:
        placed = with_position(spark.range(10_000), [F.col("id").desc()], store=store)
        assert placed.agg(F.sum(F.col("position") + F.col("id"))).first()[0] == 10_000 * 10_000
        sizes = [r["count"] for r in kept["positions"].groupBy(F.shiftright("__at", 33)).count().collect()]
        assert len(sizes) > 1 and max(sizes) < 10_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("name", sorted(q.ORDERS))
def test_questions_return_their_stated_order(spark, name):
    w = workspace(spark, SF_DIR)
    answer, order = q.ORDERS[name]
    rows = answer(w.clean, w.domain).collect()
    placed = with_position(answer(w.clean, w.domain), q.order_columns(order)).orderBy("position").drop("position").collect()
    assert list(map(str, rows)) == list(map(str, placed))
