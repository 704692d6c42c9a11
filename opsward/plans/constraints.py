"""Declarative rules of the clean layer, evaluated with one aggregate per table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators.keys import split_conflicts
from ..operators.stacking import count_rules
from ..schemas import Domain
from .cleaning import UNREADABLE


class RuleViolation(ValueError):
    pass


@dataclass(frozen=True)
class Rule:
    """A check on single rows; ``broken`` is true for a violating row, NULL passes."""

    table: str
    kind: str
    name: str
    broken: Column


def not_null_rules() -> list[Rule]:
    rules = []
    for table in schemas.TABLES:
        for part in schemas.CLEAN_DDL[table].split(","):
            column = part.split()[0]
            if column not in schemas.NULLABLE[table]:
                rules.append(Rule(table, "not_null", column, F.col(column).isNull()))
    return rules


def domain_rules(domain: Domain) -> list[Rule]:
    return [
        Rule(table, "allowed_values", column, ~F.col(column).isin(*values))
        for table, columns in schemas.value_lists(domain).items()
        for column, values in columns.items()
    ]


def range_rules() -> list[Rule]:
    positive = {
        "facilities": ["bed_capacity"],
        "departments": ["routine_target_days", "urgent_target_days", "appointment_wait_target_mins"],
    }
    scores = {"patients": "deprivation_quintile", "referrals": "priority_score", "ed_visits": "triage_category"}
    rules = [Rule(t, "range", c, F.col(c) <= 0) for t, columns in positive.items() for c in columns]
    return rules + [Rule(t, "range", c, ~F.col(c).between(1, 5)) for t, c in scores.items()]


def order_rules() -> list[Rule]:
    """The first column must not exceed the second."""
    pairs = [
        ("departments", "urgent_target_days", "routine_target_days"),
        ("patients", "date_of_birth", "enrolment_date"),
        ("referrals", "referral_date", "first_appointment_date"),
        ("referrals", "referral_date", "closed_date"),
        ("appointments", "check_in_time", "seen_time"),
        ("ed_visits", "arrival_time", "discharge_time"),
    ]
    return [Rule(t, "order", f"{a} <= {b}", F.col(a) > F.col(b)) for t, a, b in pairs]


def date_bound_rules(domain: Domain) -> list[Rule]:
    born = F.col("date_of_birth").between(F.lit(schemas.FIRST_VALID_BIRTH_DATE), F.lit(domain.snapshot))
    return [
        Rule("patients", "date_bounds", "date_of_birth", ~born),
        Rule("patients", "date_bounds", "enrolment_date", F.col("enrolment_date") > F.lit(domain.snapshot)),
    ]


def length_rules() -> list[Rule]:
    return [
        Rule(table, "max_length", f"{column} <= {limit}", F.length(column) > limit)
        for table, columns in schemas.MAX_LENGTHS.items()
        for column, limit in columns.items()
    ]


def readable_rules() -> list[Rule]:
    """Rules on a cleaned frame that still has its marks: a date or time that stood there was read."""
    return [
        Rule(table, "readable", column, F.col(UNREADABLE).bitwiseAND(F.lit(1 << i)) != 0)
        for table, columns in schemas.READ_FROM_TEXT.items()
        for i, column in enumerate(columns)
    ]


def row_rules(domain: Domain) -> list[Rule]:
    return [
        *not_null_rules(), *domain_rules(domain), *range_rules(), *order_rules(), *date_bound_rules(domain),
        *length_rules(),
    ]


def _status(violations: Column) -> Column:
    return F.when(violations == 0, "PASS").otherwise("FAIL").alias("status")


def evaluate(tables: Mapping[str, DataFrame], rules: Iterable[Rule]) -> DataFrame:
    """(table_name, rule_kind, rule_name, violations, status)."""
    per_table: dict[str, list[Rule]] = {}
    for rule in rules:
        per_table.setdefault(rule.table, []).append(rule)
    parts = []
    for table, own in per_table.items():
        counted = count_rules(tables[table], table, {f"{r.kind}|{r.name}": r.broken for r in own})
        split = F.split("rule_name", r"\|", 2)
        parts.append(
            counted.select(
                "table_name", split[0].alias("rule_kind"), split[1].alias("rule_name"), "violations",
                _status(F.col("violations")),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def primary_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows with an incomplete key, keys that repeat and surplus rows, per table."""
    parts = []
    for table, df in tables.items():
        keys = schemas.PRIMARY_KEYS[table]
        incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
        parts.append(
            counts.agg(
                F.coalesce(F.sum(F.when(incomplete, F.col("n"))), F.lit(0)).alias("null_key_rows"),
                F.count_if(~incomplete & (F.col("n") > 1)).alias("duplicate_keys"),
                F.coalesce(F.sum(F.when(~incomplete, F.col("n") - 1)), F.lit(0)).alias("surplus_rows"),
            ).select(
                F.lit(table).alias("table_name"), F.lit(", ".join(keys)).alias("key_columns"), "null_key_rows",
                "duplicate_keys", "surplus_rows", _status(F.col("null_key_rows") + F.col("duplicate_keys")),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def require(tables: Mapping[str, DataFrame], rules: Iterable[Rule]) -> None:
    """Stop on the first report with violations; only rule totals reach the driver."""
    failed = [r for r in evaluate(tables, rules).where("violations > 0").collect()]
    if failed:
        raise RuleViolation("; ".join(f"{r.table_name} {r.rule_kind} {r.rule_name}: {r.violations}" for r in failed))


def require_keys(tables: Mapping[str, DataFrame]) -> None:
    """Stop when a primary key is incomplete or repeats."""
    failed = primary_keys(tables).where("status = 'FAIL'").collect()
    if failed:
        raise RuleViolation(
            "; ".join(f"{r.table_name} primary_key: {r.null_key_rows} incomplete, {r.duplicate_keys} repeated" for r in failed)
        )


def quarantine(table: str, df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule and have a unique key, and the others with the names of broken rules.

    All rows that share a key are rejected: nothing tells which of them is right.
    """
    own = [r for r in rules if r.table == table]
    broken = F.array_compact(F.array(*[F.when(r.broken, F.lit(f"{r.kind}: {r.name}")) for r in own]))
    checked = df.withColumn("broken_rules", broken)
    sound = checked.where(F.size("broken_rules") == 0)
    unique, conflicting = split_conflicts(sound.drop("broken_rules"), schemas.PRIMARY_KEYS[table])
    rejected = checked.where(F.size("broken_rules") > 0).unionByName(
        conflicting.withColumn("broken_rules", F.array(F.lit("primary_key: repeated")))
    )
    return unique, rejected
