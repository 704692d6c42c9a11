"""Raw and clean layers of one data folder, built on first use.

The layers are written once per application as Parquet tables in the shared folder and read back
by every query, so a question costs one scan instead of the whole cleaning pipeline, lost
executors only repeat a scan, and Spark knows the exact size of every table it may broadcast.
The folder is removed when the application ends. A cluster has to name one in ``spark.checkpoint.dir``; only under a
local master may everything stay lazy, without access paths and stored counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping
from functools import reduce
from threading import RLock

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..plans import constraints, gates
from ..plans.cleaning import clean_table
from ..plans.mappings import build_mappings
from ..session import configure, drop_on_exit, scan_bytes, shared_folder, spread_shuffles
from ..sources import binding
from ..sources.access import ACCESS_PATHS, write_access
from ..sources.layers import LAYOUTS, Layers, layout, read_raw, typed


class LazyTables(Mapping):
    """Tables by name; each is built once, when first asked for, whichever thread asks."""

    def __init__(self, names: tuple[str, ...], build: Callable[[str], DataFrame], lock: RLock):
        self._names, self._build, self._lock, self._built = names, build, lock, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        with self._lock:
            if name not in self._built:
                self._built[name] = self._build(name)
            return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.domain = configure(spark), sf_dir, binding.BOUND_DOMAIN
        folder = shared_folder(spark)
        if not folder and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        self.layers = None
        if folder:
            base = f"{folder}/opsward-{spark.sparkContext.applicationId}"
            drop_on_exit(spark, base)
            self.layers = Layers(spark, f"{base}/{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}")
        spread_shuffles(spark, sum(scan_bytes(self.source(t)) for t in ("lineitem", "orders", "events")))
        lock = RLock()
        with_mappings = (*schemas.TABLES, "reference_mappings")
        self.raw = LazyTables(schemas.TABLES, self._build_raw, lock)
        self.clean = LazyTables((*with_mappings, *(ACCESS_PATHS if self.layers else ())), self._build_clean, lock)
        self.csv = LazyTables(schemas.TABLES, self._build_csv, lock)
        self.clustered = LazyTables(tuple(LAYOUTS), self._build_clustered, lock)
        self.damaged_raw = LazyTables(schemas.TABLES, self._build_damaged_raw, lock)
        self.damaged_clean = LazyTables(with_mappings, self._build_damaged_clean, lock)

    def source(self, name: str) -> DataFrame:
        return binding.table(self.spark, self.sf_dir, name)

    def _build_raw(self, name: str) -> DataFrame:
        df = binding.BINDINGS[name](self.spark, self.sf_dir)
        return self.layers.write("raw", name, df) if self.layers else df

    def _build_csv(self, name: str) -> DataFrame:
        """The raw table as it would arrive: CSV files with a header, quotes, commas, backslashes and line breaks in values."""
        path = f"{self.layers.base_path}/landing/{name}"
        self.raw[name].unionByName(binding.awkward_rows(self.spark, name)).write.mode("overwrite").options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path)
        return read_raw(self.spark, path, name, multiline=True)

    def _build_clustered(self, name: str) -> DataFrame:
        return self.layers.write("analytics", f"{name}_clustered", layout(self.clean[name], *LAYOUTS[name]))

    def _build_damaged_raw(self, name: str) -> DataFrame:
        return self.raw[name].unionByName(binding.damaged_rows(self.spark, name))

    def _build_clean(self, name: str) -> DataFrame:
        if name in ACCESS_PATHS:
            return write_access(self.layers, name, self.clean[ACCESS_PATHS[name].table])
        return self._finish("clean", name, self.raw, self.clean)

    def _build_damaged_clean(self, name: str) -> DataFrame:
        return self._finish("clean_damaged", name, self.damaged_raw, self.damaged_clean)

    def _finish(self, layer: str, name: str, raw: Mapping, clean: Mapping) -> DataFrame:
        if name == "reference_mappings":
            return build_mappings(self.spark, self.domain)
        if not self.layers:
            return typed(name, clean_table(name, raw[name], clean, self.domain))
        df = clean_table(name, raw[name], clean, self.domain, self.layers.orphan_store(name, layer))
        gated = gates.write_gated(self.layers, name, df, constraints.row_rules(self.domain), layer=layer)
        if layer == "clean_damaged":
            gates.store_checks(self.layers, name, gated)
        return gated.clean

    def checks(self) -> DataFrame:
        """What was counted while the damaged tables were written."""
        for name in schemas.TABLES:
            _ = self.damaged_clean[name]
        return reduce(DataFrame.unionByName, [self.layers.read("analytics", f"checks_{t}") for t in schemas.TABLES])


_open: dict[tuple[str, str], Workspace] = {}
_open_lock = RLock()


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _open_lock:
        if key not in _open:
            _open[key] = Workspace(spark, sf_dir.rstrip("/"))
        return _open[key]
