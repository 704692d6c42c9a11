"""Access paths by patient and by referral: bucketed, sorted tables beside the clean layer.

The clean facts are clustered by month and department or facility. What follows one patient or one referral through time
(histories, returns, joins on the key) reads an access path instead: the rows that have the key, hashed by
it into buckets and sorted by key and time, one file a bucket. A window or join on the key then needs no
shuffle, and a lookup reads one bucket. A key that holds a large part of the table would make one bucket as large, so
the rows of hot keys are stored apart, cut into ranges of (key, time) by sampled positions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.windows import HOT_KEY_ROWS, HOT_KEY_SHARE, RANGE, RANGE_ROWS, in_ranges, previous_in_key, previous_in_ranges, split_hot
from ..session import scan_bytes
from .layers import Layers

BUCKET_BYTES = 256 << 20
# Sorted rows take about ten times the bytes of their Parquet files (measured: 201 MB of a task for 21 MB of appointments).
MEMORY_GROWTH = 10


@dataclass(frozen=True)
class AccessPath:
    """Rows of a table that have the key, by key and order; the order ends with the primary key."""

    table: str
    key: str
    order: tuple[str, ...]


ACCESS_PATHS = {
    "referrals_by_patient": AccessPath("referrals", "patient_id", ("referral_date", "referral_id")),
    "appointments_by_patient": AccessPath("appointments", "patient_id", ("scheduled_datetime", "appointment_id")),
    "appointments_by_referral": AccessPath("appointments", "referral_id", ("scheduled_datetime", "appointment_id")),
    "ed_visits_by_patient": AccessPath("ed_visits", "patient_id", ("arrival_time", "visit_id")),
}


@dataclass(frozen=True)
class Access:
    """A stored access path: bucketed rows, and the rows of hot keys with their ranges (None: there are none)."""

    path: AccessPath
    rows: DataFrame
    hot: DataFrame | None
    buckets: int

    def every(self) -> DataFrame:
        return self.rows if self.hot is None else self.rows.unionByName(self.hot.drop(RANGE))

    def history(self, *keys: object) -> DataFrame:
        """All rows of some keys: their buckets, and the row groups of hot ranges that can hold them."""
        wanted = F.col(self.path.key).isin(*keys)
        found = self.rows.where(wanted)
        return found if self.hot is None else found.unionByName(self.hot.where(wanted).drop(RANGE))

    def placed(self) -> DataFrame:
        """The key of every row, and whether the row is in the file of another bucket than the one its key hashes to."""
        bucket = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)(?:\.c\d+)?\.", 1).cast("int")
        misplaced = bucket != F.pmod(F.hash(self.path.key), F.lit(self.buckets))
        found = self.rows.select(self.path.key, misplaced.alias("misplaced"))
        return found if self.hot is None else found.unionByName(self.hot.select(self.path.key, F.lit(False).alias("misplaced")))

    def previous(self, value: str, output: str, columns: Sequence[str], ignore_nulls: bool = False) -> DataFrame:
        """The value of the key's row before, beside the columns; no row is shuffled but those of hot keys."""
        key, order = self.path.key, self.path.order
        needed = list(dict.fromkeys([key, *order, value, *columns]))
        found = previous_in_key(self.rows.select(*needed), key, order, value, output, ignore_nulls)
        if self.hot is not None:
            hot = previous_in_ranges(self.hot.select(*needed, RANGE), key, order, value, output, ignore_nulls)
            found = found.unionByName(hot)
        return found.select(*dict.fromkeys([*columns, value, output]))


def bucket_number(n_bytes: int, limit: int = 65_536) -> int:
    """A power of two, so that tables of different size still join bucket by bucket; Spark's own limit is 100,000."""
    wanted = max(8, -(-n_bytes // BUCKET_BYTES))
    return min(limit, 1 << (wanted - 1).bit_length())


def table_name(layers: Layers, name: str) -> str:
    """Name in the session's catalog, different for every base folder."""
    return f"opsward_{hashlib.sha256(layers.base_path.encode()).hexdigest()[:12]}_{name}"


def write_access(
    layers: Layers, name: str, df: DataFrame, buckets: int | None = None,
    share: int = HOT_KEY_SHARE, min_rows: int = HOT_KEY_ROWS, range_rows: int = RANGE_ROWS,
) -> Access:
    """Rebuild an access path from its clean table; rows without the key are not on it."""
    path = ACCESS_PATHS[name]
    n = buckets or bucket_number(scan_bytes(df) * MEMORY_GROWTH)
    known = df.where(F.col(path.key).isNotNull())
    others, hot, n_hot = split_hot(known, path.key, share, min_rows)
    if hot is not None:
        layers.write("analytics", f"{name}_hot", in_ranges(hot, path.key, path.order, -(-n_hot // range_rows)))
    by = (path.key, *path.order)
    (
        # The same hash deals rows to tasks and to buckets: each task writes the one file of its bucket.
        others.repartition(n, path.key).sortWithinPartitions(*by)
        .write.mode("overwrite").format("parquet").option("path", layers.path("analytics", name))
        .bucketBy(n, path.key).sortBy(*by).saveAsTable(table_name(layers, name))
    )
    about = layers.spark.range(1).select(F.lit(n).alias("buckets"), F.lit(hot is not None).alias("hot"))
    layers.write("analytics", f"{name}_about", about)
    return open_access(layers, name)


def open_access(layers: Layers, name: str) -> Access:
    """A stored access path, also one that another application wrote."""
    path, spark, table = ACCESS_PATHS[name], layers.spark, table_name(layers, name)
    about = layers.read("analytics", f"{name}_about").first()
    if not spark.catalog.tableExists(table):
        where = layers.path("analytics", name)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.read.parquet(where).schema)
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({path.key})"
            f" SORTED BY ({', '.join((path.key, *path.order))}) INTO {about.buckets} BUCKETS LOCATION '{where}'"
        )
    hot = layers.read("analytics", f"{name}_hot") if about.hot else None
    return Access(path, spark.table(table), hot, about.buckets)
