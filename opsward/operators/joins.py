"""Lookup, key-resolution and anti joins.

No join carries a broadcast hint: Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and sorts or hashes otherwise, with skewed partitions
split at run time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import norm_id, trimmed
from ..session import byte_size, scan_bytes

# Keeps a frame under a name in a shared folder and returns the stored frame.
Store = Callable[[str, DataFrame], DataFrame]


def enrich(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Left-outer star join; the grain of the fact is kept as long as dimension keys are unique."""
    for dim, key in dims:
        fact = fact.join(dim, key, "left")
    return fact


def map_by_table(df: DataFrame, lookup: str, mappings: DataFrame, group: str, output: str) -> DataFrame:
    """Standard value for a normalised key from one mapping group; unmapped keys give NULL."""
    rules = mappings.where(F.col("mapping_group") == group).select(
        F.col("raw_value_normalised").alias("__raw"), F.col("standard_value").alias(output)
    )
    return df.join(rules, F.col(lookup) == F.col("__raw"), "left").drop("__raw")


def resolve_fk(
    child: DataFrame,
    parent: DataFrame,
    lookup: str,
    key: str,
    flag_name: str,
    optional: bool = False,
    store: Store | None = None,
) -> DataFrame:
    """Replace ``lookup`` by ``key``, which is NULL when the parent does not exist, plus an issue flag.

    A blank key counts as an issue unless the relationship is optional. A repeated parent key never repeats a child.

    A parent small enough to broadcast is joined directly. Joining a larger one would shuffle the
    whole child, so with a ``store`` the child's distinct keys are compared with the parent
    instead: that shuffles one narrow row per key and task however often a key occurs, and leaves
    the keys without a parent. Those are stored, which tells Spark their size, and the child is
    joined with them: by broadcast as long as they are few, by shuffle otherwise.
    """
    others = [c for c in child.columns if c not in (lookup, key)]
    known = parent.select(F.col(key).alias("__parent")).where(F.col("__parent").isNotNull()).distinct()
    if store is None or broadcastable(parent.select(key)):
        found = child.join(known, F.col(lookup) == F.col("__parent"), "left")
        resolved, unknown = F.col("__parent"), F.col("__parent").isNull()
    else:
        used = child.select(F.col(lookup).alias("__missing")).where(F.col(lookup).isNotNull()).distinct()
        missing = store(key, used.join(known, F.col("__missing") == F.col("__parent"), "left_anti"))
        found = child.join(missing, F.col(lookup) == F.col("__missing"), "left")
        unknown = F.col("__missing").isNotNull() | F.col(lookup).isNull()
        resolved = F.when(~unknown, F.col(lookup))
    issue = unknown & F.col(lookup).isNotNull() if optional else unknown
    return found.select(*others, resolved.alias(key), issue.alias(flag_name))


def broadcastable(df: DataFrame) -> bool:
    """Whether Spark would broadcast this side by its estimated size."""
    limit = byte_size(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    return 0 <= scan_bytes(df) <= limit


def orphan_counts(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Normalised non-blank child keys without a parent, with their row count.

    The child is counted per key before the join, so one row per key and task is shuffled however
    often a key occurs.
    """
    keys = (
        child.where(trimmed(F.col(child_key)).isNotNull())
        .groupBy(norm_id(F.col(child_key)).alias("orphan_id"))
        .agg(F.count("*").alias("affected_rows"))
    )
    known = parent.select(norm_id(F.col(parent_key)).alias("orphan_id"))
    return keys.join(known, "orphan_id", "left_anti")


def orphan_keys(
    children: Mapping[str, DataFrame], parents: Mapping[str, DataFrame], relationships: Sequence[tuple[str, str, str]],
    normal: Callable[[Column], Column],
) -> DataFrame:
    """(child_table, foreign_key_column, parent_table, orphan_id, affected_rows) for many relationships at once.

    A child is read once for all its keys and a parent once for all its children. The children's rows are
    counted per key where they are read, and the counts of all relationships are compared with all parents in one join.
    NULL keys are no orphans.
    """
    parts = []
    for child in dict.fromkeys(c for c, _, _ in relationships):
        keys = [
            F.struct(F.lit(key).alias("foreign_key_column"), F.lit(parent).alias("parent_table"), normal(F.col(key)).alias("orphan_id"))
            for c, key, parent in relationships if c == child
        ]
        cells = children[child].select(F.inline(F.array(*keys))).where(F.col("orphan_id").isNotNull())
        counted = cells.groupBy("foreign_key_column", "parent_table", "orphan_id").agg(F.count("*").alias("affected_rows"))
        parts.append(counted.select(F.lit(child).alias("child_table"), "*"))
    known = [
        parents[parent].select(F.lit(parent).alias("parent_table"), normal(F.col(key)).alias("orphan_id"))
        for key, parent in dict.fromkeys((key, parent) for _, key, parent in relationships)
    ]
    used, known = reduce(DataFrame.unionByName, parts), reduce(DataFrame.unionByName, known).distinct()
    # Not an anti join: Spark would push it below the union and read the parents once for each child.
    met = used.join(known.withColumn("__known", F.lit(True)), ["parent_table", "orphan_id"], "left")
    return met.where(F.col("__known").isNull()).drop("__known")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows with a non-blank key that no parent row has."""
    known = parent.select(norm_id(F.col(parent_key)).alias("__known"))
    present = child.where(trimmed(F.col(child_key)).isNotNull())
    return present.join(known, norm_id(F.col(child_key)) == F.col("__known"), "left_anti")


def join_inflation(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], rule: str) -> DataFrame:
    """Row count of a fact before and after its dimension joins; only key columns are read.

    Each dimension is counted per key first, so the joined rows are added up and never made.
    """
    keys = list(dict.fromkeys(k for _, k in dims))
    joined, rows = fact.select(*keys), F.lit(1).cast("long")
    for i, (dim, key) in enumerate(dims):
        counts = dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(f"__rows_{i}"))
        joined = joined.join(counts, key, "left")
        rows = rows * F.coalesce(f"__rows_{i}", F.lit(1))
    counted = joined.agg(F.count("*").alias("base_row_count"), F.coalesce(F.sum(rows), F.lit(0)).alias("joined_row_count"))
    extra = F.col("joined_row_count") - F.col("base_row_count")
    return counted.select(
        F.lit(rule).alias("validation_rule"), "base_row_count", "joined_row_count",
        extra.alias("unexpected_additional_rows"),
        F.when(extra == 0, "PASS").otherwise("REVIEW").alias("validation_status"),
    )
