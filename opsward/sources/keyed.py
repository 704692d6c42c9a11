"""Tables that are updated by key: an upsert rewrites the parts its keys fall into and leaves all other files alone.

The rows are spread by the hash of their key over numbered parts, one folder each. An upsert reads the parts of the
incoming keys, replaces equal keys, adds the rest, and overwrites only those parts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import assert_unique
from ..session import scan_bytes
from .layers import Layers

PART = "key_part"
PART_BYTES = 256 << 20


class KeyedTable:
    """A table of one layer whose rows are found and replaced by key; keys hold no NULL."""

    def __init__(self, layers: Layers, layer: str, table: str, keys: Sequence[str]):
        self.layers, self.layer, self.table, self.keys = layers, layer, table, list(keys)
        self.path = layers.root(layer, table)

    def part(self, parts: int) -> Column:
        return F.pmod(F.hash(*self.keys), F.lit(parts))

    def _about(self):
        return self.layers.read(self.layer, f"{self.table}_about").first()

    def _parts_of(self, df: DataFrame, parts: int) -> DataFrame:
        missing = reduce(Column.__or__, [F.col(k).isNull() for k in self.keys])
        if not df.where(missing).isEmpty():
            raise ValueError(f"{self.table}: a key of {self.keys} is NULL")
        return df.withColumn(PART, self.part(parts))

    def rebuild(self, df: DataFrame, parts: int | None = None) -> DataFrame:
        """Write the whole table; the number of parts follows its size and stays until the next rebuild."""
        n = parts or max(1, -(-scan_bytes(df) // PART_BYTES))
        assert_unique(df, self.keys)
        self._write(self._parts_of(df, n), n, "static")
        about = self.layers.spark.range(1).select(F.lit(n).alias("parts"))
        self.layers.write(self.layer, f"{self.table}_about", about)
        return self.read()

    def _write(self, df: DataFrame, parts: int, mode: str) -> None:
        spread = df.repartition(min(parts, 10_000), PART).sortWithinPartitions(PART, *self.keys)
        spread.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(PART).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(PART)

    def _stored(self) -> DataFrame:
        return self.layers.spark.read.parquet(self.path)

    def upsert(self, incoming: DataFrame) -> DataFrame:
        """Incoming rows win on equal keys; running it twice changes nothing. A key that occurs twice among them is an error."""
        n = self._about().parts
        assert_unique(incoming, self.keys)
        stored = self._stored()
        fresh = self._parts_of(incoming.select(*[c for c in stored.columns if c != PART]), n)
        touched = [r[0] for r in fresh.select(PART).distinct().collect()]  # numbers below the number of parts
        if touched:
            kept = stored.where(F.col(PART).isin(touched)).join(fresh, [PART, *self.keys], "left_anti")
            self._write(kept.select(*stored.columns).unionByName(fresh), n, "dynamic")
            self.layers.spark.catalog.refreshByPath(self.path)
        return self.read()
