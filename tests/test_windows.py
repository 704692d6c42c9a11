"""Previous value per key against brute force, with one key holding a large part of the rows."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from opsward.operators.windows import hot_keys, previous_value
from opsward.session import stored

SCHEMA = "visit string, patient string, arrival timestamp_ntz, discharge timestamp_ntz"


def make_rows(seed, n=600):
    rng = random.Random(seed)
    start = dt.datetime(2026, 1, 1)
    rows = []
    for i in range(n):
        patient = "hot" if rng.random() < 0.4 else f"p{rng.randrange(60)}"
        # Coarse times give ties within an hour, across slice borders, and long gaps without visits.
        arrival = start + dt.timedelta(minutes=20 * rng.randrange(400))
        if rng.random() < 0.03:
            arrival = None
        discharge = None if rng.random() < 0.3 else start + dt.timedelta(minutes=i)
        rows.append((f"v{i:05d}", patient, arrival, discharge))
    return rows


def brute_force(rows, ignore_nulls):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    result = {}
    for visits in groups.values():
        visits.sort(key=lambda r: (r[2] is None, r[2] or dt.datetime.min, r[0]))
        last = None
        for r in visits:
            result[r[0]] = last
            if not ignore_nulls or r[3] is not None:
                last = r[3]
    return result


@pytest.mark.parametrize("ignore_nulls", [False, True])
@pytest.mark.parametrize("range_rows", [10, 100])
@pytest.mark.parametrize("share", [4, 1000])
def test_matches_brute_force(spark, ignore_nulls, range_rows, share):
    rows = make_rows(seed=share + range_rows)
    df = spark.createDataFrame(rows, SCHEMA)
    found = previous_value(
        df, "patient", "arrival", "visit", "discharge", "before", ignore_nulls=ignore_nulls, share=share, min_rows=0, range_rows=range_rows
    )
    assert found.columns == ["visit", "patient", "arrival", "discharge", "before"]
    got = {r.visit: r.before for r in found.collect()}
    assert len(got) == len(rows)
    assert got == brute_force(rows, ignore_nulls)


def test_hot_keys_are_bounded(spark):
    df = spark.createDataFrame(make_rows(seed=7), SCHEMA)
    assert [r[0] for r in hot_keys(df, "patient", 4, 0).collect()] == ["hot"]
    assert 0 < hot_keys(df, "patient", 1000, 0).count() < 1000
    assert hot_keys(df, "patient").count() == 0  # all keys are small


NO_TIME = [None] * 3000
ONE_HOUR = [dt.datetime(2026, 1, 1, 9) + dt.timedelta(seconds=i % 3600) for i in range(3000)]
ONE_MOMENT = [dt.datetime(2026, 1, 1, 9)] * 3000


@pytest.mark.parametrize("times", [NO_TIME, ONE_HOUR, ONE_MOMENT, NO_TIME[:1500] + ONE_HOUR[:1500]])
@pytest.mark.parametrize("ignore_nulls", [False, True])
def test_hot_key_is_spread_whatever_its_times(spark, times, ignore_nulls):
    """All rows in one hour, at one moment or without a time: every range stays small, answers are those of one window."""
    rng = random.Random(1)
    discharges = [dt.datetime(2026, 1, 2) + dt.timedelta(minutes=i) if rng.random() < 0.4 else None for i in range(len(times))]
    rows = [(f"v{i:05d}", "hot", t, d) for i, (t, d) in enumerate(zip(times, discharges))] + make_rows(seed=5, n=100)[:50]
    rows = [(f"{v}{'' if p == 'hot' else 'x'}", p, t, d) for v, p, t, d in rows]
    rows = list({r[0]: r for r in rows}.values())
    kept = {}

    def store(name, df):
        kept[name] = stored(name, df)
        return kept[name]

    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = previous_value(
        df, "patient", "arrival", "visit", "discharge", "before", ignore_nulls, share=10, min_rows=100, range_rows=200, store=store
    )
    sizes = [r["count"] for r in kept["hot_ranges"].groupBy("patient", "__range").count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 600
    assert {r.visit: r.before for r in found.collect()} == brute_force(rows, ignore_nulls)


def test_without_hot_keys_there_is_one_window(spark):
    df = spark.createDataFrame(make_rows(seed=3), SCHEMA)
    plan = previous_value(df, "patient", "arrival", "visit", "discharge", "before")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Window") == 1 and "Union" not in text


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert previous_value(df, "patient", "arrival", "visit", "discharge", "before").count() == 0


def test_null_ties_order_alike_on_both_paths(spark):
    df = spark.createDataFrame(
        [("k", "2024-01-01 10:00:00", None, 1), ("k", "2024-01-01 10:00:00", "b", 2), ("k", "2024-01-01 12:00:00", "c", 3)],
        "k string, t string, id string, v int",
    ).selectExpr("k", "cast(t as timestamp_ntz) t", "id", "v")
    plain = previous_value(df, "k", "t", "id", "v", "before")
    hot = previous_value(df, "k", "t", "id", "v", "before", share=10, min_rows=0, range_rows=1)
    assert sorted(map(str, plain.collect())) == sorted(map(str, hot.collect()))
