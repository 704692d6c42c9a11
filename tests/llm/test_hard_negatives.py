"""Hard negatives against brute force over all pairs, with ties, odd rows and blocks of few rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsward.llm import hard_negatives
from opsward.llm.hard_negatives import Block, search


def brute_force(rows):
    """rows: (id, label, vector) that take part."""
    out = []
    for a, label, x in rows:
        if a % 5:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, other) for i, other, y in rows if i != a)
        for s, positive, _ in [t for t in scored if t[2] == label][:5]:
            inside = [t for t in scored if t[2] != label and 50 * -s <= 100 * -t[0] <= 95 * -s][:3]
            out += [(a, positive, rank, i, -s, -t) for rank, (t, i, _) in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows, anchors_each", [(8192, 512), (7, 3)])
def test_equals_brute_force(spark, monkeypatch, block_rows, anchors_each):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(hard_negatives, "GROUP_ANCHORS", anchors_each)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).round(1).tolist(), int(rng.choice([0, 0, 0, 1, 2]))) for i in range(150)]
    rows += [(200 + i, [0.5, -0.5, 0.25, 0.0, 0.0, 0.0], i % 2) for i in range(40)]  # ties
    rows += [(300, [0.0] * 6, 0), (305, [1.0, 1.0], 1), (310, [], 2)]
    odd = [(400, None, 1), (405, [None, 1.0], 1), (410, [math.nan], 1), (415, [math.inf], 1), (420, [1.0], None), (None, [1.0], 1)]
    again = [(5, rows[5][1], rows[5][2] + 1), rows[10]]
    table = [(i, v, label, "x") for i, v, label in rows + odd + again]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int, id string").repartition(3)
    got = hard_negatives.hard_negatives(df, F.col("id") % 5 == 0)
    whole = [(i, label, [math.floor(256 * x) for x in v] + [0] * (6 - len(v))) for i, v, label in rows]
    assert sorted(map(tuple, got.collect())) == brute_force(whole)
    assert hard_negatives.hard_negatives(df.limit(0), F.col("id") % 5 == 0).count() == 0


def test_no_pack_goes_through_the_driver(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 7)
    monkeypatch.setattr(hard_negatives, "GROUP_ANCHORS", 3)
    rows = [(i, [float(i % 7), 1.0, float(i % 3)], i % 4) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    plans, store = [], hard_negatives.store

    def ran(part):
        return part._jdf.queryExecution().executedPlan().toString()

    def stored(part, name):
        out = store(part, name)
        part.collect()
        plans.append(ran(part))
        return out

    monkeypatch.setattr(hard_negatives, "store", stored)
    found = hard_negatives.hard_negatives(df, F.col("id") % 5 == 0)
    got = found.collect()
    plans.append(ran(found))
    assert not [p for p in plans if "Broadcast" in p or "Generate" in p]
    assert sum("CartesianProduct" in p for p in plans) == 2
    assert sorted(map(tuple, got)) == brute_force([(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows])


@pytest.mark.parametrize("block_lanes, group_lanes", [(1000, 20), (2, 3), (1, 1)])
def test_lanes_do_not_change_the_result(spark, monkeypatch, block_lanes, group_lanes):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 5)
    monkeypatch.setattr(hard_negatives, "GROUP_ANCHORS", 2)
    monkeypatch.setattr(hard_negatives, "BLOCK_LANES", block_lanes)
    monkeypatch.setattr(hard_negatives, "GROUP_LANES", group_lanes)
    rows = [(i, [float(i % 11), 1.0, float(i % 5)], i % 3) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hard_negatives.hard_negatives(df, F.col("id") % 5 == 0).collect()
    assert sorted(map(tuple, got)) == brute_force([(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows])


def block(vectors, ids=None):
    vectors = np.array(vectors, np.int64)
    ids = np.arange(len(vectors)) if ids is None else np.array(ids)
    lists = np.argsort(vectors.T, axis=1)[:, ::-1].astype(np.int32)
    fields = {"ids": ids.astype(np.int64), "labels": np.zeros(len(vectors), np.int64), "vectors": vectors, "lists": lists}
    return Block({"n": len(vectors), "dims": vectors.shape[1]} | {c: a.tobytes() for c, a in fields.items()})


def test_reading_stops_early_and_ties_are_met():
    n = 4000
    vectors = np.stack([np.arange(n), np.arange(n)], 1)
    vectors[-40:] = n  # forty equal best rows; the smallest id stands deepest
    b = block(vectors, np.arange(n)[::-1])
    calls = []
    b.kinds[np.float64] = (read := Counted(vectors.astype(float), calls)), np.take_along_axis(vectors.T.astype(float), b.lists, 1)
    assert read is not None
    (at, scores), = search(b, np.array([1, 1]), np.ones(n, bool), [(-np.inf, np.inf)], 3)
    assert b.ids[at].tolist() == [0, 1, 2] and scores.tolist() == [2 * n] * 3
    assert sum(calls) < n // 10


class Counted:
    def __init__(self, rows, calls):
        self.rows, self.calls, self.dtype = rows, calls, rows.dtype

    def __getitem__(self, at):
        self.calls.append(len(at))
        return self.rows[at]


def test_very_large_components_stay_exact():
    big = 1 << 40
    b = block([[big, 1], [big, 0], [big, 2], [-big, 5]])
    (at, scores), = search(b, np.array([big, 1]), np.ones(4, bool), [(-np.inf, np.inf)], 2)
    assert at.tolist() == [2, 0] and [int(s) for s in scores] == [big * big + 2, big * big + 1]
