"""From six CSV files to the clean layer and the analytic views.

    layers = Layers(spark, "s3a://bucket/ops")
    load(layers, "s3a://bucket/landing")
    build_clean(layers, Domain(), on_violation="quarantine")
    statistics.refresh(layers)
    clean = open_clean(layers)
    questions.backlog_by_department(clean, Domain()).show()

Run as a module: ``python -m opsward.pipeline LANDING BASE [raise|quarantine|report]``.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from . import schemas
from .plans import constraints, gates, validation, views
from .plans.cleaning import clean_table
from .plans.mappings import build_mappings
from .schemas import Domain
from .session import configure, scan_bytes, spread_shuffles
from .sources import statistics
from .sources.access import ACCESS_PATHS, Access, open_access, write_access
from .sources.layers import LAYOUTS, Layers, layout_order, load_raw

MODES = ("raise", "quarantine", "report")


def load(layers: Layers, csv_dir: str, multiline: bool = False, on_broken: str = "raise") -> dict[str, DataFrame]:
    """Full refresh of the raw layer from ``<table>_raw.csv`` files (or folders of files)."""
    return {t: load_raw(layers, f"{csv_dir.rstrip('/')}/{t}_raw.csv", t, multiline, on_broken) for t in schemas.TABLES}


def build_clean(
    layers: Layers, domain: Domain, on_violation: str = "raise", clustered: bool = True
) -> dict[str, DataFrame]:
    """Rebuild the clean layer in dependency order.

    Each table is cleaned and written once, and its rules are counted on the way. ``raise`` stops at
    the first table that breaks a rule, ``quarantine`` puts the offending rows into ``clean_rejected``,
    ``report`` keeps them. ``clustered`` lays the facts out by month and access key and stores them by patient
    and referral as well.
    """
    if on_violation not in MODES:
        raise ValueError(f"on_violation must be one of {MODES}")
    rules = constraints.row_rules(domain)
    clean = {"reference_mappings": refresh_mappings(layers, domain)}
    spread_shuffles(layers.spark, sum(scan_bytes(layers.read("raw", t)) for t in schemas.TABLES))
    for table in schemas.TABLES:
        statistics.forget(layers, table)
        df = clean_table(table, layers.read("raw", table), clean, domain, layers.orphan_store(table))
        order = layout_order(*LAYOUTS[table]) if clustered and table in LAYOUTS else ()
        gated = gates.write_gated(layers, table, df, rules, on_violation == "quarantine", order)
        gates.store_checks(layers, table, gated)
        clean[table] = gated.clean
        if on_violation == "raise":
            gates.require_none(table, gated)
            constraints.require_keys({table: clean[table]})
    for name, path in ACCESS_PATHS.items():
        if clustered:
            write_access(layers, name, clean[path.table])
        else:
            layers.drop("analytics", f"{name}_about")  # an older path would not match the new tables
    return clean


def refresh_mappings(layers: Layers, domain: Domain) -> DataFrame:
    """Upsert the approved mappings into the stored table; mappings added by others stay."""
    name = "reference_mappings"
    existing = layers.read("clean", name) if layers.exists("clean", name) else None
    staged = layers.write_clean(name, build_mappings(layers.spark, domain, existing), "clean_staged")
    return layers.write_clean(name, staged)


def open_clean(layers: Layers) -> dict[str, DataFrame | Access]:
    """The clean tables, with statistics if they have been analysed, and the access paths that were stored with them."""
    tables = {t: statistics.open_table(layers, t) for t in schemas.TABLES}
    tables["reference_mappings"] = layers.read("clean", "reference_mappings")
    return tables | {n: open_access(layers, n) for n in ACCESS_PATHS if layers.exists("analytics", f"{n}_about")}


def open_checks(layers: Layers) -> DataFrame:
    """What was counted while the clean tables were written."""
    return reduce(DataFrame.unionByName, [layers.read("analytics", f"checks_{t}") for t in schemas.TABLES])


def report(
    raw: Mapping[str, DataFrame], clean: Mapping[str, DataFrame], domain: Domain, checks: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Every check after cleaning, by name; nothing runs until a result is read.

    With the counts that ``build_clean`` stored, rules and flags need no scan.
    """
    tables = {t: clean[t] for t in schemas.TABLES}
    if checks is None:
        counted = {"rules": constraints.evaluate(tables, constraints.row_rules(domain)), "flag_totals": validation.flag_totals(clean)}
    else:
        counted = {
            "rules": gates.stored_rules(checks, "in_clean"), "rules_before_quarantine": gates.stored_rules(checks),
            "flag_totals": gates.stored_flags(checks), "completeness": gates.stored_completeness(checks),
        }
    return counted | {
        "row_counts": validation.reconcile_counts(raw, clean),
        "primary_keys": constraints.primary_keys(tables),
        "flag_agreement": validation.flag_agreement(clean),
        "timelines": validation.remaining_timelines(clean),
        "references": validation.referential_integrity(clean),
        "cross_table": validation.cross_table_consistency(clean),
        "before_birth": validation.event_before_birth(clean),
        "join_inflation": validation.model_inflation(clean),
        "kpi_readiness": validation.kpi_readiness(clean, domain),
    }


def main(arguments: list[str]) -> None:
    landing, base, *mode = arguments
    spark = configure(SparkSession.builder.appName("opsward").getOrCreate())
    layers, domain = Layers(spark, base), Domain()
    raw = load(layers, landing)
    build_clean(layers, domain, *mode)
    statistics.refresh(layers)
    clean = open_clean(layers)
    views.register_views(clean, domain)
    for name, result in report(raw, clean, domain, open_checks(layers)).items():
        stored = layers.write("analytics", f"report_{name}", result)
        print(f"{name}: {stored.count()} rows in {layers.path('analytics', f'report_{name}')}")


if __name__ == "__main__":
    main(sys.argv[1:])
