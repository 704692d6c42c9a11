"""Positions in a total order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .joins import Store

# monotonically_increasing_id() counts a partition's rows in the lower bits and its number above them.
_ROW_BITS = 33


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position", store: Store = stored) -> DataFrame:
    """Every row with its number, from 1, in the given order; rows that tie in it are numbered in any order.

    The rows are cut into ranges, sorted and numbered inside them, and stored, so that ranges and numbers are
    those of one run. A range starts after the rows of all ranges before it: a sum over one count per range.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = store("positions", ranged.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", _ROW_BITS)
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = kept.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    starts = starts.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    row = F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = kept.join(starts, part == F.col("__part"))
    return placed.select(*df.columns, (F.col("__before") + row + 1).alias(name))
