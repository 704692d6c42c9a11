"""Upserts by key: touched parts are rewritten, the files of all others keep their names."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from opsward.operators.keys import DuplicateKeyError
from opsward.sources.keyed import PART, KeyedTable
from opsward.sources.layers import Layers


@pytest.fixture
def table(spark, tmp_path):
    table = KeyedTable(Layers(spark, str(tmp_path / "base")), "analytics", "states", ["a", "b"])
    table.rebuild(spark.range(2000).select((F.col("id") % 50).alias("a"), F.col("id").cast("string").alias("b"), F.lit(0).alias("v")), parts=12)
    return table


def files(table):
    found = {}
    for f in Path(table.path).rglob("*.parquet"):
        found.setdefault(f.parent.name, set()).add(f.name)
    return found


def test_untouched_files_stay(spark, table):
    before = files(table)
    assert len(before) == 12
    incoming = spark.createDataFrame([(7, "7", 1), (7, "new", 2)], "a long, b string, v int")
    touched = {f"{PART}={r[0]}" for r in incoming.select(table.part(12)).collect()}
    table.upsert(incoming)
    after = files(table)
    assert {k for k in before if before[k] != after[k]} == touched and after.keys() == before.keys()
    rows = {(r.a, r.b): r.v for r in table.read().collect()}
    assert len(rows) == 2001 and rows[7, "7"] == 1 and rows[7, "new"] == 2 and sum(rows.values()) == 3


def test_twice_changes_nothing_and_extra_columns_are_left_out(spark, table):
    incoming = spark.range(100).select((F.col("id") % 50).alias("a"), F.col("id").cast("string").alias("b"), F.lit(9).alias("v"), F.lit("x").alias(PART))
    once = sorted(map(tuple, table.upsert(incoming).collect()))
    assert sorted(map(tuple, table.upsert(incoming).collect())) == once and len(once) == 2000
    assert sum(r[2] for r in once) == 900
    assert sorted(map(tuple, table.upsert(incoming.limit(0)).collect())) == once


def test_bad_keys_are_errors(spark, table):
    with pytest.raises(DuplicateKeyError):
        table.upsert(spark.createDataFrame([(1, "1", 1), (1, "1", 2)], "a long, b string, v int"))
    with pytest.raises(ValueError, match="NULL"):
        table.upsert(spark.createDataFrame([(1, None, 1)], "a long, b string, v int"))
    assert table.read().count() == 2000
