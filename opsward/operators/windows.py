"""Previous value per key, safe for very hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .joins import Store

# A key is hot when it holds more than one row in HOT_KEY_SHARE. There are then fewer hot keys than
# HOT_KEY_SHARE at any data size, a few megabytes at most, so the list may be broadcast. Keys below
# HOT_KEY_ROWS fit a task anyway.
HOT_KEY_SHARE = 100_000
HOT_KEY_ROWS = 1_000_000
# Rows of hot keys that one range holds, about.
RANGE_ROWS = 500_000
RANGE = "__range"


def hot_keys(df: DataFrame, key: str, share: int = HOT_KEY_SHARE, min_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Keys with more than min_rows rows and more than 1/share of all rows (fewer than ``share`` keys), with their rows."""
    counts = df.groupBy(key).agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    hot = counts.where((F.col("__n") > min_rows) & (F.col("__n") * share > total))
    return hot.select(F.col(key).alias("__hot_key"), "__n")


def split_hot(
    df: DataFrame, key: str, share: int = HOT_KEY_SHARE, min_rows: int = HOT_KEY_ROWS, store: Store = stored
) -> tuple[DataFrame, DataFrame | None, int]:
    """Rows of other keys, rows of hot keys and their number; without a hot key the frame itself, None and 0.

    The keys are counted at once, in a scan of the key column. Rows without a key are among the others.
    """
    hot = hot_keys(df.where(F.col(key).isNotNull()), key, share, min_rows)
    kept = store("hot_keys", hot)
    n_hot = kept.agg(F.sum("__n")).first()[0] or 0
    if not n_hot:
        return df, None, 0
    keys = F.broadcast(kept.select("__hot_key"))
    same = F.col(key) == F.col("__hot_key")
    return df.join(keys, same, "left_anti"), df.join(keys, same, "left_semi"), n_hot


def _ascending(names: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in names]


def in_ranges(rows: DataFrame, key: str, order: Sequence[str], n_ranges: int) -> DataFrame:
    """Rows sorted by key and order, with the number of their range.

    Spark samples whole positions (key and all columns of the order) and cuts between them, so a key with all rows in
    one hour, or without any time, is cut by the tie-breaker. Store the result before it is used: another
    run may draw another sample.
    """
    at = [F.col(key).asc_nulls_last(), *_ascending(order)]
    return rows.repartitionByRange(n_ranges, *at).sortWithinPartitions(*at).withColumn(RANGE, F.spark_partition_id())


def previous_in_key(df: DataFrame, key: str, order: Sequence[str], value: str, output: str, ignore_nulls: bool = False) -> DataFrame:
    """One window per key; without a shuffle where the rows are bucketed by the key."""
    return df.withColumn(output, _earlier(Window.partitionBy(key).orderBy(*_ascending(order)), value, ignore_nulls))


def _earlier(window, value: str, ignore_nulls: bool) -> Column:
    if ignore_nulls:
        return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return F.lag(value, 1).over(window)


def previous_in_ranges(
    ranged: DataFrame, key: str, order: Sequence[str], value: str, output: str, ignore_nulls: bool = False
) -> DataFrame:
    """One window per key and range of stored rows from ``in_ranges``; the last value of a range is carried into the next.

    The carry is one extra row per key and range, in front of the range's rows and dropped afterwards.
    """
    position = F.struct(*[c for o in order for c in (F.col(o).isNull(), F.col(o))])
    counted = F.when(F.col(value).isNotNull(), position) if ignore_nulls else position
    last = F.max_by(F.struct(F.col(value)), counted).getField(value)
    per_range = ranged.groupBy(key, RANGE).agg(last.alias("__last"))
    ranges = Window.partitionBy(key).orderBy(RANGE)
    if ignore_nulls:
        per_range = per_range.withColumn("__last", F.last("__last", ignorenulls=True).over(ranges))
    carry = per_range.select(
        F.col(key), F.lead(RANGE).over(ranges).alias(RANGE), F.col("__last").alias(value), F.lit(True).alias("__carry")
    ).where(F.col(RANGE).isNotNull())
    every = ranged.withColumn("__carry", F.lit(False)).unionByName(carry, allowMissingColumns=True)
    window = Window.partitionBy(key, RANGE).orderBy(F.col("__carry").desc(), *_ascending(order))
    found = every.withColumn(output, _earlier(window, value, ignore_nulls))
    return found.where(~F.col("__carry")).drop("__carry", RANGE)


def previous_value(
    df: DataFrame,
    key: str,
    time: str,
    tie_breaker: str,
    value: str,
    output: str,
    ignore_nulls: bool = False,
    share: int = HOT_KEY_SHARE,
    min_rows: int = HOT_KEY_ROWS,
    range_rows: int = RANGE_ROWS,
    store: Store = stored,
) -> DataFrame:
    """``lag(value)`` per key in order of time, then tie_breaker; NULL times sort last.

    A window puts a whole key into one task. The rows of hot keys are therefore cut into ranges of positions, each range
    is its own window, and its last value travels on to the next one. Rows without a key form one key
    like others and are never hot: filter them out where there are many. With ``ignore_nulls`` the
    last non-NULL earlier value is taken.
    """
    order = (time, tie_breaker)
    others, hot, n_hot = split_hot(df, key, share, min_rows, store)
    found = previous_in_key(others, key, order, value, output, ignore_nulls)
    if hot is None:
        return found
    ranged = store("hot_ranges", in_ranges(hot, key, order, -(-n_hot // range_rows)))
    return found.unionByName(previous_in_ranges(ranged, key, order, value, output, ignore_nulls))
