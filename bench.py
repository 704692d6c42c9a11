"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data folder and the number of local cores. Every query is
run to its last row into a sink that discards it. ``build_layers`` is the time to shape, clean and
store all six tables and the visits by patient; the other queries read the stored layers.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from opsward.catalog import run
from opsward.catalog.workspace import workspace
from opsward.schemas import TABLES

HEADLINE = [
    "av01_referral_view", "av02_appointment_view", "av03_ed_view",
    "bq01_referrals_by_month_status", "bq02_backlog_by_department", "bq03_backlog_bands",
    "bq04_first_appointment_target", "bq05_appointments_by_month_status", "bq06_no_show_by_department",
    "bq07_wait_target_by_department", "bq08_no_show_by_channel", "bq09_no_show_by_quintile",
    "bq10_ed_by_month_region", "bq11_ed_length_of_stay", "bq12_admission_and_left", "bq13_presenting_mix",
    "bq14_return_within_window", "iq01_extreme_months", "iq02_status_share", "iq03_backlog_network",
    "pf01_identifier_summary", "pf04_category_frequency", "pf09_orphan_fk", "pf10_impossible_timeline",
    "vl11_referential_integrity", "vl12_cross_table_consistency", "vl13_event_before_birth",
    "vl14_join_inflation", "vl15_kpi_readiness", "dm12_percentiles", "dm15_return_by_segment",
    "sm03_kpi_catalogue", "sm04_matrix_rollup", "sm07_reconcile_measures",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("opsward-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the engine before the clock

    times: dict[str, float] = {}
    start = time.perf_counter()
    w = workspace(spark, sf_dir)
    for table in (*TABLES, "ed_visits_by_patient"):
        _ = w.clean[table]
    times["build_layers"] = time.perf_counter() - start
    for layer in ("damaged_raw", "damaged_clean"):
        for table in TABLES:
            _ = getattr(w, layer)[table]
    for name in HEADLINE:
        start = time.perf_counter()
        run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = time.perf_counter() - start
        print(f"{name}: {times[name]:.2f}", file=sys.stderr)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": {name: round(t, 3) for name, t in times.items()}, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
