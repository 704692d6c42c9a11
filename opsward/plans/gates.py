"""One write per clean table: rules are counted while its rows are written, and a row's verdict names its folder.

The counts come from ``observe`` in the stage that writes, so a table is neither cleaned nor read a second time for its
rules, flags and completeness, and a retried task is counted once. In quarantine mode rows that break a rule go
to the ``verdict=rejected`` folder of the same write, so the others keep their clustering. Only a primary key needs
other rows to judge: it is checked in a scan of the key columns of what was written, and only if a key
repeats are its rows moved.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas
from ..operators.keys import duplicate_keys, split_conflicts
from ..session import short_methods, small_splits
from ..sources.layers import VERDICT, Layers, typed
from .cleaning import UNREADABLE
from .constraints import Rule, RuleViolation, readable_rules

BROKEN = "broken_rules"
SOUND, REJECTED = "sound", "rejected"
CHECKS_DDL = "table_name string, measure string, name string, counted long, in_clean long"


@dataclass(frozen=True)
class Gated:
    """A written table and what was counted on the way: found in all rows, and left in the clean table."""

    clean: DataFrame
    found: dict[tuple[str, str], int]
    left: dict[tuple[str, str], int]

    def broken(self) -> dict[tuple[str, str], int]:
        return {k: n for k, n in self.found.items() if n and k[0] not in ("rows", "flag", "filled")}


def measures(table: str, rules: Sequence[Rule]) -> dict[tuple[str, str], Column]:
    """What is counted of a table, by kind and name."""
    counted = {("rows", "all"): F.lit(True)}
    counted |= {(r.kind, r.name): r.broken for r in rules}
    counted |= {("flag", f): F.col(f) for f in schemas.QUALITY_FLAGS.get(table, ())}
    return counted | {("filled", c): F.col(c).isNotNull() for c in schemas.clean_columns(table)}


def write_gated(
    layers: Layers, table: str, df: DataFrame, rules: Sequence[Rule], quarantine: bool = False,
    order: Sequence[Column] = (), layer: str = "clean",
) -> Gated:
    """Write a cleaned table once, counted and split by verdict, range-partitioned and sorted by ``order`` if given."""
    marks = [c for c in df.columns if c == UNREADABLE]
    own = [r for r in (*rules, *(readable_rules() if marks else ())) if r.table == table]
    marked = typed(table, df, marks)
    if quarantine:
        broken = F.array_compact(F.array(*[F.when(r.broken, F.lit(f"{r.kind}: {r.name}")) for r in own]))
        marked = marked.withColumn(BROKEN, broken).withColumn(VERDICT, F.when(F.size(BROKEN) > 0, REJECTED).otherwise(SOUND))
        marked = marked.withColumn(BROKEN, F.when(F.col(VERDICT) == REJECTED, F.col(BROKEN)))
    if order:
        marked = marked.repartitionByRange(*order)
    counted, seen = measures(table, own), Observation(f"{layer}_{table}")
    columns = [F.count_if(p).alias(f"found_{i}") for i, p in enumerate(counted.values())]
    if quarantine:  # else all rows stay
        sound = F.col(VERDICT) == SOUND
        columns += [F.count_if(p & sound).alias(f"left_{i}") for i, p in enumerate(counted.values())]
    observed = marked.observe(seen, *columns).drop(*marks)
    by = [*([F.col(VERDICT)] if quarantine else []), *order]
    observed = observed.sortWithinPartitions(*by) if by else observed
    with short_methods(layers.spark), small_splits(layers.spark):
        if quarantine:
            observed.write.mode("overwrite").partitionBy(VERDICT).parquet(layers.root(layer, table))
        else:  # one folder: no row is sorted by its verdict
            layers.drop(f"{layer}_rejected", table)
            observed.write.mode("overwrite").parquet(layers.path(layer, table))
    numbers = seen.get
    found, left = (
        {k: numbers[f"{side}_{i}"] for i, k in enumerate(counted)} for side in ("found", "left" if quarantine else "found")
    )

    nothing = layers.spark.createDataFrame([], schemas.CLEAN_DDL[table])
    rows = ("rows", "all")
    if not left[rows]:
        layers.write(layer, table, nothing)
    if quarantine and left[rows] == found[rows]:
        layers.write(f"{layer}_rejected", table, nothing.withColumn(BROKEN, F.lit(None).cast("array<string>")))
    clean = layers.read(layer, table)
    if quarantine:
        clean = _move_conflicts(layers, layer, table, clean)
    return Gated(clean, found, left)


def _move_conflicts(layers: Layers, layer: str, table: str, clean: DataFrame) -> DataFrame:
    """Reject all rows that share a key: nothing tells which of them is right."""
    keys = schemas.PRIMARY_KEYS[table]
    if duplicate_keys(clean, keys).isEmpty():
        return clean
    unique, conflicting = split_conflicts(clean, keys)
    staged = layers.write(f"{layer}_staged", table, unique)
    marked = conflicting.withColumn(BROKEN, F.array(F.lit("primary_key: repeated")))
    marked.write.mode("append").parquet(layers.path(f"{layer}_rejected", table))
    return layers.write(layer, table, staged)


def require_none(table: str, gated: Gated) -> None:
    """Stop when rows broke a rule; the table is written by then."""
    if gated.broken():
        raise RuleViolation("; ".join(f"{table} {kind} {name}: {n}" for (kind, name), n in gated.broken().items()))


def store_checks(layers: Layers, table: str, gated: Gated) -> DataFrame:
    """Keep the counts of a table beside it: (table_name, measure, name, counted, in_clean)."""
    rows = [(table, kind, name, n, gated.left[kind, name]) for (kind, name), n in gated.found.items()]
    return layers.write("analytics", f"checks_{table}", layers.spark.createDataFrame(rows, CHECKS_DDL))


def stored_rules(checks: DataFrame, counted: str = "counted") -> DataFrame:
    """(table_name, rule_kind, rule_name, violations, status) of the rules, without a scan of any table."""
    return checks.where(~F.col("measure").isin("rows", "flag", "filled")).select(
        "table_name", F.col("measure").alias("rule_kind"), F.col("name").alias("rule_name"), F.col(counted).alias("violations"),
        F.when(F.col(counted) == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def stored_flags(checks: DataFrame) -> DataFrame:
    """(table_name, flag_name, flagged_rows) of the clean rows."""
    flags = checks.where("measure = 'flag'")
    return flags.select("table_name", F.col("name").alias("flag_name"), F.col("in_clean").alias("flagged_rows"))


def stored_completeness(checks: DataFrame) -> DataFrame:
    """(table_name, column_name, total_rows, missing_rows) of every clean column."""
    totals = checks.where("measure = 'rows'").select("table_name", F.col("in_clean").alias("total_rows"))
    filled = checks.where("measure = 'filled'").select("table_name", F.col("name").alias("column_name"), "in_clean")
    return filled.join(totals, "table_name").select("table_name", "column_name", "total_rows", (F.col("total_rows") - F.col("in_clean")).alias("missing_rows"))

