"""Every registered query against its SQL twin, and the shape of its physical plan."""

import pytest

import __spark_entry__ as contract
from compare import connect, differences, duck_rows, spark_rows
from conftest import SF_DIR
from opsward.catalog import workspace as workspaces
from opsward.catalog.registry import REGISTRY, plain_types
from opsward.plans import model, questions, views

QUERIES, TWINS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", REGISTRY)
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in plan
    assert differences(spark_rows(df), duck_rows(duck, TWINS[name])) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.fixture(scope="module")
def w(spark):
    return workspaces.workspace(spark, SF_DIR)


def test_results_do_not_depend_on_broadcasts(spark, w, duck):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("bq02_backlog_by_department", "bq09_no_show_by_quintile", "sm04_matrix_rollup", "pf09_orphan_fk"):
            df = QUERIES[name](spark, SF_DIR)
            assert differences(spark_rows(df), duck_rows(duck, TWINS[name])) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(w):
    df = questions.backlog_by_department(w.clean, w.domain)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "referral_status" in line)
    assert "PushedFilters: [In(referral_status, [Open,Waiting])]" in scan
    assert "referral_source" not in scan and "patient_id" not in scan


def test_views_join_only_wanted_dimensions(w):
    bare = views.appointment_view(w.clean, w.domain, ())
    assert "Join" not in bare._jdf.queryExecution().optimizedPlan().toString()


def test_views_keep_the_grain(w):
    for view, table in (
        (views.referral_view, "referrals"), (views.appointment_view, "appointments"), (views.ed_visit_view, "ed_visits"),
    ):
        assert view(w.clean, w.domain).count() == w.clean[table].count()


def test_registered_views_answer_sql(spark, w):
    views.register_views(w.clean, w.domain)
    row = spark.sql("SELECT count(*) AS n FROM vw_referral_analysis WHERE backlog_flag").first()
    assert row.n == questions.backlog_network(w.clean, w.domain).first().total_backlog_referrals


def test_everything_can_stay_lazy(spark, duck, monkeypatch):
    """Without a shared folder nothing is stored and the answers are the same."""
    monkeypatch.setattr(workspaces, "shared_folder", lambda _: None)
    lazy = workspaces.Workspace(spark, SF_DIR)
    assert lazy.layers is None
    for name in ("bq02_backlog_by_department", "bq14_return_within_window", "cl04_referrals"):
        df = plain_types(REGISTRY[name].build(lazy))
        assert differences(spark_rows(df), duck_rows(duck, TWINS[name])) is None


def test_kpis_per_group_add_up_to_the_network(w):
    facts = {"ed_visits": views.ed_visit_view(w.clean, w.domain, {"facilities"})}
    kpis = [k for k in model.kpi_catalogue() if k.fact == "ed_visits"]
    whole = {r.kpi_name: r for r in model.evaluate_kpis(facts, kpis).collect()}
    regional = model.evaluate_kpis(facts, kpis, ["hospital_region"]).collect()
    for name, row in whole.items():
        assert sum(r.denominator for r in regional if r.kpi_name == name) == row.denominator
        assert sum(r.numerator for r in regional if r.kpi_name == name) == row.numerator
        assert all(0 <= r.kpi_value <= 100 for r in regional if r.kpi_name == name and name.endswith("%"))


def test_breakdowns_add_up(w):
    total = w.clean["ed_visits"].count()
    for df, column in (
        (questions.ed_by_month_region(w.clean, w.domain), "total_ed_visits"),
        (questions.presenting_mix(w.clean, w.domain), "total_ed_visits"),
        (questions.admission_and_left(w.clean, w.domain), "total_ed_visits"),
    ):
        assert sum(r[column] for r in df.collect()) == total


def test_every_line_becomes_an_appointment(spark, w):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    copies = lines.where("l_orderkey % 50 = 9").count()
    assert w.raw["appointments"].count() == lines.count() + copies
    assert w.raw["appointments"].select("appointment_id").distinct().count() == lines.count()


def test_unknown_slicers_are_refused(w):
    with pytest.raises(ValueError):
        model.sliced_kpis(w.clean, w.domain, {"region": "Asia"})
