"""Many measures or columns as rows, from one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack_columns(df: DataFrame, columns: Sequence[str], name: str, value: str, keep: Sequence[str] = ()) -> DataFrame:
    """Turn the given columns of equal type into (name, value) rows."""
    return df.unpivot([F.col(c) for c in keep], [F.col(c) for c in columns], name, value)


def unpivot_text(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """(table_name, column_name, raw_value) for some text columns; the table is scanned once."""
    return stack_columns(df.select(*columns), columns, "column_name", "raw_value").select(
        F.lit(table).alias("table_name"), "column_name", "raw_value"
    )


def count_rules(df: DataFrame, table: str, rules: Mapping[str, Column], value: str = "violations") -> DataFrame:
    """Count the rows that satisfy each predicate, in one aggregate: (table_name, rule_name, value)."""
    names = list(rules)
    counts = df.agg(*[F.count_if(rules[n]).alias(f"r{i}") for i, n in enumerate(names)])
    entries = [F.struct(F.lit(n).alias("rule_name"), F.col(f"r{i}").alias(value)) for i, n in enumerate(names)]
    return counts.select(F.lit(table).alias("table_name"), F.inline(F.array(*entries)))
