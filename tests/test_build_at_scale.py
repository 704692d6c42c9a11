"""What keeps the first build of the layers in memory when the tables grow."""

import datetime as dt

import pytest

from opsward import schemas
from opsward.operators.keys import exact_dedupe_marked
from opsward.plans import constraints, gates
from opsward.schemas import Domain
from opsward.session import byte_size, small_splits, spread_shuffles
from opsward.sources import binding
from opsward.sources.layers import Layers

SPLIT = "spark.sql.files.maxPartitionBytes"


def test_shuffles_follow_the_rows_in_memory(spark):
    """564 MB of orders, lines and events are 36 million appointments, of 300 bytes each by estimate."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        spread_shuffles(spark, 564_000_000)
        assert 36_000_000 * 300 / int(spark.conf.get(key)) < 128 << 20
    finally:
        spark.conf.unset(key)


@pytest.mark.parametrize("split, inside", [("128m", 32 << 20), ("16m", 16 << 20), ("512m", 512 << 20)])
def test_cleaning_reads_small_splits(spark, split, inside):
    before = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, split)
    try:
        with small_splits(spark):
            assert byte_size(spark.conf.get(SPLIT)) == inside
        assert spark.conf.get(SPLIT) == split
    finally:
        spark.conf.set(SPLIT, before)


def test_rows_that_all_stay_are_not_sorted_by_verdict(spark, tmp_path):
    """They go into the folder of the sound rows; rejected rows of an earlier write do not stay beside them."""
    layers, rules = Layers(spark, str(tmp_path)), constraints.row_rules(Domain())
    columns = {"facility_id": "f", "hospital_region": "nowhere", "facility_type": "Regional Hospital"}
    rows = [{**columns, "facility_id": f"F00{i}", "hospital_region": "Central" if i else "nowhere"} for i in range(3)]
    full = [tuple(r.get(c) or (5 if c == "bed_capacity" else "x") for c in schemas.clean_columns("facilities")) for r in rows]
    df = spark.createDataFrame(full, schemas.CLEAN_DDL["facilities"])
    gates.write_gated(layers, "facilities", df, rules, quarantine=True)
    assert layers.read("clean_rejected", "facilities").count() == 1
    gated = gates.write_gated(layers, "facilities", df, rules)
    assert gated.found["allowed_values", "hospital_region"] == 1 and gated.clean.count() == 3
    assert not layers.exists("clean_rejected", "facilities")
    assert "broken_rules" not in spark.read.parquet(layers.path("clean", "facilities")).columns


def test_copies_collapse_by_all_flags(spark):
    """False, true and unknown are three values, and flags beyond the packed ones count as well."""
    names = [f"f{i}" for i in range(40)]
    ddl = "id int, " + ", ".join(f"{n} boolean" for n in names) + ", unreadable int"
    plain = [True, False, None] * 13 + [True]
    other = plain[:-1] + [None]
    rows = [(1, *plain, 1), (1, *plain, 2), (1, *other, 4), (1, *([None] * 40), 0), (None, *plain, 1)]
    df = spark.createDataFrame(rows, ddl)
    found = exact_dedupe_marked(df, "unreadable")
    assert found.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(
        map(repr, [(1, *plain, 3), (1, *other, 4), (1, *([None] * 40), 0), (None, *plain, 1)])
    )
    plan = exact_dedupe_marked(df.select("id", "f0", "f1", "unreadable"), "unreadable")._jdf.queryExecution().toString()
    assert "hashpartitioning(id#" in plan and ", f0#" not in plan.split("hashpartitioning(")[1].split(")")[0]


def test_lines_are_shuffled_once(spark, tmp_path):
    """Numbering the lines of an order and joining the order need the same distribution."""
    day = dt.datetime(2000, 1, 1)
    lines = [(o, 1, 3, n, 7.0, 1.0, 0.0, 0.0, "A", "F", day) for o in (1, 2, None) for n in (1, 2, 2)]
    ddl = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
           "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")  # fmt: skip
    spark.createDataFrame(lines, ddl).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 5), (2, 6), (None, 7)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = binding.appointments(spark, str(tmp_path))
        found = sorted(r.appointment_id for r in df.collect())
        plan = df._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == ["A00000011001", "A00000012001", "A00000012002", "A00000021001", "A00000022001", "A00000022002"]
    initial = plan.split("== Initial Plan ==")[1]
    assert initial.count("Exchange hashpartitioning") == 2  # one of the lines, one of the orders
