"""Duplicates and key uniqueness."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType


class DuplicateKeyError(ValueError):
    pass


def exact_dedupe(df: DataFrame) -> DataFrame:
    """One copy of every identical row.

    ``distinct`` collapses copies inside each input partition before it shuffles, so a row copied
    a billion times costs one shuffled row per task.
    """
    return df.distinct()


def exact_dedupe_marked(df: DataFrame, marks: str) -> DataFrame:
    """One copy of every row that is identical but for its marks, with the marks of all copies (bits of a number).

    Rows are hashed, compared and shuffled with all their flags as one number, two bits a flag.
    """
    flags = [f.name for f in df.schema if isinstance(f.dataType, BooleanType)][:MOST_PACKED]
    others = [c for c in df.columns if c != marks and c not in flags]
    packed = reduce(Column.__add__, [_flag_bits(F.col(c), 2 * i) for i, c in enumerate(flags)], F.lit(0).cast("long"))
    kept = df.select(*others, packed.alias("__flags"), marks).groupBy(*others, "__flags").agg(F.bit_or(marks).alias(marks))
    read = {c: F.shiftright("__flags", 2 * i).bitwiseAND(F.lit(3)) for i, c in enumerate(flags)}
    return kept.select(*[F.when(read[c] != 2, read[c] == 1).alias(c) if c in read else F.col(c) for c in df.columns])


#: Flags of two bits each that one long holds beside its sign.
MOST_PACKED = 31


def _flag_bits(c: Column, shift: int) -> Column:
    """False, true and NULL as 0, 1 and 2, moved to their place."""
    return F.when(c.isNull(), F.lit(2 << shift)).when(c, F.lit(1 << shift)).otherwise(F.lit(0)).cast("long")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the count and the surplus."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("occurrence_count"))
        .where(F.col("occurrence_count") > 1)
        .withColumn("duplicate_excess_rows", F.col("occurrence_count") - 1)
    )


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise when a key repeats; only a sample of the offending keys reaches the driver."""
    examples = duplicate_keys(df, keys).limit(5).collect()
    if examples:
        raise DuplicateKeyError(f"duplicate keys {list(keys)}: {[tuple(r)[:len(keys)] for r in examples]}")
    return df


def split_conflicts(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is unique, and the quarantined rows that share a key."""
    repeated = duplicate_keys(df, keys).select(*[F.col(k).alias(f"__{k}") for k in keys])
    same: Column = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return df.join(repeated, same, "left_anti"), df.join(repeated, same, "left_semi")
