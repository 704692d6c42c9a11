"""Catalog tables over the clean layer with column statistics for the cost-based optimizer.

A clean table is registered over its files and analysed in one scan: rows, nulls, distinct values, smallest and largest
value of every column in ANALYSED. Spark then estimates what a filter or join leaves, not only how large the files are, and
chooses join sides and strategies by it. A rebuild forgets the statistics it outdates.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.stacking import stack_columns
from .access import table_name
from .layers import Layers

STATISTICS_DDL = "table_name string, column_name string, row_count long, null_count long, distinct_count long, min string, max string"
#: Columns that filters, joins and groups use.
ANALYSED = {
    "facilities": ("facility_id", "hospital_region"),
    "departments": ("department_id", "facility_id", "specialty_group"),
    "patients": ("patient_id", "gender", "deprivation_quintile", "date_of_birth"),
    "referrals": ("referral_id", "patient_id", "department_id", "referral_date", "closed_date", "urgency", "referral_status"),
    "appointments": ("appointment_id", "patient_id", "department_id", "referral_id", "scheduled_datetime", "appointment_status", "booking_channel"),
    "ed_visits": ("visit_id", "patient_id", "facility_id", "arrival_time", "triage_category", "disposition", "presenting_group"),
}


def refresh(layers: Layers, tables: Iterable[str] = schemas.TABLES) -> None:
    """Register the clean tables, collect their statistics anew, and let the optimizer use them."""
    spark = layers.spark
    spark.conf.set("spark.sql.cbo.enabled", "true")
    for table in tables:
        name = table_name(layers, table)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schemas.CLEAN_DDL[table]}) USING parquet LOCATION '{layers.path('clean', table)}'")
        spark.sql(f"REFRESH TABLE {name}")
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(ANALYSED[table])}")


def distinct_counts(layers: Layers, columns: dict[str, Iterable[str]]) -> DataFrame:
    """Exact distinct values of some columns, to judge the estimates by: (table_name, column_name, exact)."""
    parts = []
    for table, names in columns.items():
        counts = open_table(layers, table).agg(*[F.count_distinct(c).alias(c) for c in names])
        parts.append(stack_columns(counts, list(names), "column_name", "exact").withColumn("table_name", F.lit(table)))
    return reduce(DataFrame.unionByName, parts)


def forget(layers: Layers, table: str) -> None:
    """Take a table and its statistics out of the catalog; its files stay."""
    layers.spark.sql(f"DROP TABLE IF EXISTS {table_name(layers, table)}")


def open_table(layers: Layers, table: str) -> DataFrame:
    """A clean table, with its statistics if it has been analysed."""
    name = table_name(layers, table)
    return layers.spark.table(name) if layers.spark.catalog.tableExists(name) else layers.read("clean", table)


def _described(spark: SparkSession, name: str, column: str) -> dict[str, str | None]:
    rows = spark.sql(f"DESCRIBE EXTENDED {name} {column}").collect()
    return {r.info_name: None if r.info_value == "NULL" else r.info_value for r in rows}


def _row_count(spark: SparkSession, name: str) -> int | None:
    found = [r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "Statistics"]
    return next((int(word) for text in found for word, unit in zip(text.split(), text.split()[1:]) if unit.startswith("row")), None)


def column_statistics(layers: Layers, columns: dict[str, Iterable[str]] | None = None) -> DataFrame:
    """What the catalog knows: one row per analysed column. Reads metadata only."""
    spark, rows = layers.spark, []
    for table, names in (columns or ANALYSED).items():
        name = table_name(layers, table)
        total = _row_count(spark, name)
        for column in names:
            known = _described(spark, name, column)
            nulls, distinct = (int(known[k]) if known.get(k) else None for k in ("num_nulls", "distinct_count"))
            rows.append((table, column, total, nulls, distinct, known.get("min"), known.get("max")))
    return spark.createDataFrame(rows, STATISTICS_DDL)
