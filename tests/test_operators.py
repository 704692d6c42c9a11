"""Keys, joins, shares and percentiles on small hand-made tables."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsward.operators import joins, keys, shares
from opsward.operators.rollups import sums_by_dimension
from opsward.sources.layers import upsert


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_wins_on_key_and_is_idempotent(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    incoming = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    once = upsert(base, incoming, ["k"])
    assert rows(once) == [("a", 1), ("b", 20), ("c", 30)]
    assert rows(upsert(once, incoming, ["k"])) == rows(once)
    repeated = spark.createDataFrame([("b", 1), ("b", 2)], "k string, v int")
    with pytest.raises(keys.DuplicateKeyError):
        upsert(base, repeated, ["k"])


def test_split_conflicts_loses_no_row(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), (None, 1), (None, 2), ("c", 3)], "k string, v int")
    unique, conflicting = keys.split_conflicts(df, ["k"])
    assert rows(unique) == [("a", 1), ("c", 3)]
    assert unique.count() + conflicting.count() == df.count()
    keys.assert_unique(unique, ["k"])


def test_exact_dedupe_collapses_a_group_of_copies(spark):
    df = spark.createDataFrame([("x", 1)] * 500 + [("y", i) for i in range(500)], "k string, v int")
    assert keys.exact_dedupe(df).count() == 501


def test_resolve_fk_required_and_optional(spark):
    parent = spark.createDataFrame([("P1",), ("P2",)], "pid string")
    child = spark.createDataFrame([(1, "P1"), (2, "P9"), (3, None)], "id int, look string")
    required = joins.resolve_fk(child, parent, "look", "pid", "issue").select("id", "pid", "issue")
    assert rows(required) == [(1, "P1", False), (2, None, True), (3, None, True)]
    optional = joins.resolve_fk(child, parent, "look", "pid", "issue", optional=True).select("id", "pid", "issue")
    assert rows(optional) == [(1, "P1", False), (2, None, True), (3, None, False)]


def test_resolve_fk_beyond_the_broadcast_limit(spark, monkeypatch):
    parent = spark.createDataFrame([(f"P{i}",) for i in range(50)], "pid string")
    child = spark.createDataFrame([(i, None if i % 7 == 0 else f"P{i % 60}") for i in range(500)], "id int, look string")
    stored = []

    def store(name, df):
        stored.append((name, sorted(r[0] for r in df.collect())))
        return df

    for optional in (False, True):
        direct = joins.resolve_fk(child, parent, "look", "pid", "issue", optional)
        monkeypatch.setattr(joins, "broadcastable", lambda _: False)
        by_missing_keys = joins.resolve_fk(child, parent, "look", "pid", "issue", optional, store)
        assert rows(by_missing_keys) == rows(direct)
    assert stored[0] == ("pid", [f"P{i}" for i in range(50, 60)])


def test_orphans_use_normalised_keys(spark):
    parent = spark.createDataFrame([(" f1",), ("F2 ",)], "fid string")
    child = spark.createDataFrame([("F1",), (" f9 ",), ("F9",), ("",), (None,)], "fid string")
    assert rows(joins.orphan_counts(child, parent, "fid", "fid")) == [("F9", 2)]
    assert joins.orphans(child, parent, "fid", "fid").count() == 2


def test_join_inflation_reports_repeated_parent_keys(spark):
    fact = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    clean = spark.createDataFrame([("a",), ("b",)], "k string")
    doubled = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(joins.join_inflation(fact, [(clean, "k")], "r")) == [("r", 4, 4, 0, "PASS")]
    assert rows(joins.join_inflation(fact, [(doubled, "k")], "r")) == [("r", 4, 6, 2, "REVIEW")]


def test_sums_by_dimension_equals_join_then_group(spark):
    fact = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("z", 4), (None, 5)], "k string, v int")
    dim = spark.createDataFrame([("a", "one"), ("b", "one"), ("c", "two")], "k string, name string")
    early = sums_by_dimension(fact, "k", dim, ["name"], {"n": F.count("*"), "s": F.sum("v")}, {"m": F.max("v")})
    late = fact.join(dim, "k", "left").groupBy("name").agg(F.count("*"), F.sum("v"), F.max("v"))
    assert rows(early) == rows(late)


def test_shares(spark):
    counts = spark.createDataFrame([("a", 50), ("b", 30), ("c", 20), (None, 100)], "g string, n long")
    assert rows(shares.share_of_total(counts, "n", "p")) == [("a", 50, 25.0), ("b", 30, 15.0), ("c", 20, 10.0), (None, 100, 50.0)]
    assert rows(shares.top_n_share(counts, "n", ["g"], 2)) == [(2, 80, 200, 40.0)]
    running = {r.g: r.p for r in shares.cumulative_share(counts, "n", "g", "p").collect()}
    assert running == {None: 50.0, "a": 75.0, "b": 90.0, "c": 100.0}


def test_top_n_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 5), ("d", 9)], "k string, n int")
    assert [r.k for r in shares.top_n(df, "n", ["k"], 3).collect()] == ["d", "a", "b"]


def test_percentiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    groups = {g: np.round(rng.gamma(2.0, 20.0, size), 2) for g, size in (("a", 1), ("b", 2), ("c", 101), ("d", 500))}
    data = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(data, "g string, v double").select("g", F.col("v").cast("decimal(18,2)").alias("v"))
    found = shares.exact_percentiles(df, "v", ["g"], {"p50": Fraction(1, 2), "p90": Fraction(9, 10)})
    for r in found.collect():
        assert r.n == len(groups[r.g])
        assert r.p50 == pytest.approx(np.percentile(groups[r.g], 50), abs=0.00501)
        assert r.p90 == pytest.approx(np.percentile(groups[r.g], 90), abs=0.00501)


def test_repeated_parent_keys_never_repeat_a_child(spark):
    child = spark.createDataFrame([(1, "A"), (2, "B"), (3, "Z"), (4, None)], "id int, ref string")
    parent = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "k string")
    direct = rows(joins.resolve_fk(child, parent, "ref", "k", "bad"))
    stored = rows(joins.resolve_fk(child, parent, "ref", "k", "bad", store=lambda _, df: df))
    assert direct == stored == [(1, "A", False), (2, "B", False), (3, None, True), (4, None, True)]


def test_inflation_counts_rows_of_repeated_keys(spark):
    fact = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "k string")
    dim = spark.createDataFrame([("A",), ("A",), ("A",), (None,)], "k string")
    (got,) = joins.join_inflation(fact, [(dim, "k")], "r").collect()
    assert (got.base_row_count, got.joined_row_count, got.validation_status) == (4, 8, "REVIEW")
