"""Measures of the model: how often facts are read, and histories under filters."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from opsward.catalog.workspace import workspace
from opsward.functions import norm_id
from opsward.operators import joins
from opsward.plans import model, profiling, sketches, validation
from opsward.plans import questions as q
from opsward.sources.layers import VERDICT

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def w(spark):
    return workspace(spark, SF_DIR)


def scans(df):
    """How often each clean table is read in a plan."""
    leaves, found = df._jdf.queryExecution().optimizedPlan().collectLeaves(), {}
    for i in range(leaves.size()):
        if "LogicalRelation" in leaves.apply(i).getClass().getName():
            paths = leaves.apply(i).relation().location().rootPaths().toString()
            for table in re.findall(rf"/(?:clean|raw)/(\w+)/{VERDICT}", paths):
                found[table] = found.get(table, 0) + 1
    return found


@pytest.mark.parametrize("measure", [model.reconcile_measures, model.kpis_by_level])
def test_each_fact_is_read_once(w, measure):
    found = scans(measure(w.clean, w.domain))
    assert {t: found[t] for t in ("referrals", "appointments", "ed_visits")} == {"referrals": 1, "appointments": 1, "ed_visits": 1}


def test_the_star_reads_no_other_fact(w):
    assert {"referrals", "ed_visits"}.isdisjoint(scans(model.star_appointments(w.clean, w.domain)))


def test_a_slice_keeps_the_history_before_it(spark, w):
    """A visit in the slice whose predecessor lies before it still counts as a return."""
    visits = q.visits_with_previous_discharge(w.clean).collect()
    window = dt.timedelta(hours=w.domain.return_window_hours)
    returns = [v for v in visits if v.previous_discharge_time and v.previous_discharge_time < v.arrival_time <= v.previous_discharge_time + window]
    chosen = max(returns, key=lambda v: v.arrival_time.date() > v.previous_discharge_time.date())
    day = chosen.arrival_time.date()
    sliced = {r.kpi_name: r for r in model.sliced_kpis(w.clean, w.domain, {"date": (day, day)}).collect()}
    assert len(sliced) == 12
    inside = [v for v in visits if v.arrival_time and v.arrival_time.date() == day]
    assert sliced["ED return %"].denominator == sum(v.previous_discharge_time is not None for v in inside)
    assert int(sliced["ED return %"].numerator) == sum(v in returns for v in inside) > 0


def test_filters_of_counted_facts_reach_the_scan(w):
    df = model.sliced_kpis(w.clean, w.domain, {"date": (dt.date(2000, 1, 1), dt.date(2000, 1, 31))})
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(referral_date,2000-01-01)" in text


def test_levels_add_up(w):
    rows = model.kpis_by_level(w.clean, w.domain).where("kpi_name = 'Total ED visits'").collect()
    total = next(r.numerator for r in rows if r.level == "network")
    for level in ("region", "facility", "month", "region and month"):
        assert sum(r.numerator for r in rows if r.level == level) == total
    assert all(r.department_name is None for r in rows)


def test_a_lost_parent_shows_in_the_reconciliation(w):
    damaged = {t: w.clean[t] for t in ("facilities", "departments", "patients", "referrals", "appointments", "ed_visits")}
    damaged["facilities"] = damaged["facilities"].unionByName(damaged["facilities"].where("facility_id = 'F001'"))
    found = {r.measure_name: r for r in model.reconcile_measures(damaged, w.domain).collect()}
    assert found["Admission rate %"].validation_status == "REVIEW" and found["Admission rate %"].difference < 0
    plain = model.reconcile_measures(w.clean, w.domain).collect()
    assert {r.validation_status for r in plain} == {"PASS"}


@pytest.mark.parametrize("name", ["pf09", "vl11"])
def test_orphans_of_all_relationships_read_each_child_once(w, name):
    """Four children and four parents, whatever the number of relationships."""
    found = scans(profiling.orphan_foreign_keys(w.raw) if name == "pf09" else validation.referential_integrity(w.clean))
    # Departments and referrals are children and parents.
    assert found == {"facilities": 1, "departments": 2, "patients": 1, "referrals": 2, "appointments": 1, "ed_visits": 1}


def test_orphan_keys_by_brute_force(spark):
    parents = {"p": spark.createDataFrame([("A",), ("B",), (None,)], "k string"), "q": spark.createDataFrame([("Z",)], "m string")}
    rows = [("a", "z"), (" c ", "y"), ("C", None), ("", "y"), (None, "Z")]
    children = {"x": spark.createDataFrame(rows, "k string, m string"), "y": spark.createDataFrame([("D",)], "k string")}
    found = joins.orphan_keys(children, parents, [("x", "k", "p"), ("x", "m", "q"), ("y", "k", "p")], norm_id)
    assert sorted(map(tuple, found.select("child_table", "foreign_key_column", "parent_table", "orphan_id", "affected_rows").collect())) == [
        ("x", "k", "p", "C", 2), ("x", "m", "q", "Y", 2), ("y", "k", "p", "D", 1)
    ]


def test_sketches_add_up_within_their_bound(spark):
    """Percentiles of any filter come from the sketches of its months; small groups are exact."""
    values = spark.range(200_000).select(
        F.lit("m").alias("measure"), F.when(F.col("id") % 1000 == 0, "small").otherwise("large").alias("group_id"),
        F.add_months(F.lit("2026-01-01").cast("date"), (F.col("id") % 24).cast("int")).alias("month_start"),
        (F.pmod(F.hash("id"), F.lit(5000)) + F.when(F.col("id") % 24 >= 12, 5000).otherwise(0)).cast("long").alias("hundredths"),
    )
    stored = sketches.sketch(values)
    assert stored.count() > 24
    for where in (F.lit(True), F.col("month_start") < "2027-01-01"):
        found = sketches.percentiles(stored, where=where)
        errors = {r.group_id: r for r in sketches.rank_errors(values.where(where), found).collect()}
        assert all(max(r.median_error, r.percentile_90_error) <= sketches.RANK_ERROR for r in errors.values())
        small = sorted(r[0] for r in values.where(where).where("group_id = 'small'").select("hundredths").collect())
        got = found.where("group_id = 'small'").first()
        assert got.n == len(small) and small[0] <= got.median * 100 <= small[-1] and errors["small"].median_error == 0
    off = sketches.rank_errors(values, sketches.percentiles(stored).withColumn("median", F.lit(10.0)))
    assert off.agg(F.max("median_error")).first()[0] > 0.3
