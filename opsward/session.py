"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the engine counts on. AQE picks join strategies from measured sizes and
# splits skewed join partitions; results are compared in UTC.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# A row of text in memory takes many times the bytes of the compressed columns it comes from (by estimate 300 bytes
# of an appointment that is deduplicated for about 16 of its line and order).
ROW_GROWTH = 32
SHUFFLE_PARTITION_BYTES = 128 << 20
MAX_SHUFFLE_PARTITIONS = 32_768
LARGE_INPUT_BYTES = 8 << 40
LARGE_SPLIT_BYTES = 512 << 20
# Stored text that one cleaning task reads: its rows, collapsed in memory before they are shuffled, take about 15 times that by estimate.
CLEAN_SPLIT_BYTES = 32 << 20

# HotSpot never compiles a method with more bytecode than this.
COMPILED_METHOD_BYTES = "8000"

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def _set_while(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Run what is executed inside without fused stages that the JVM would interpret row by row.

    A stage as long as a cleaner's becomes one method that is too large to be compiled. Above the limit Spark runs
    the operators one by one, each in short methods.
    """
    with _set_while(spark, "spark.sql.codegen.hugeMethodLimit", COMPILED_METHOD_BYTES):
        yield


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Read files inside in splits whose rows a task can hold in memory while it collapses copies.

    Splits raised for a very large input stay as they are.
    """
    key = "spark.sql.files.maxPartitionBytes"
    now = byte_size(spark.conf.get(key))
    with _set_while(spark, key, str(now if now >= LARGE_SPLIT_BYTES else min(now, CLEAN_SPLIT_BYTES))):
        yield


def spread_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Start shuffles with enough partitions for the input; AQE merges the small ones afterwards.

    Very large inputs are also read in larger splits, which keeps the map-output bookkeeping of
    the driver small. Only raises the numbers: the session's own settings stay when larger.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    current = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(input_bytes * ROW_GROWTH // SHUFFLE_PARTITION_BYTES, MAX_SHUFFLE_PARTITIONS)
    if wanted > current:
        spark.conf.set(key, str(wanted))
    if input_bytes > LARGE_INPUT_BYTES:
        split = "spark.sql.files.maxPartitionBytes"
        if byte_size(spark.conf.get(split)) < LARGE_SPLIT_BYTES:
            spark.conf.set(split, str(LARGE_SPLIT_BYTES))


def byte_size(text: str) -> int:
    """Number of bytes in a Spark size setting such as 128m or 134217728b."""
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    digits = str(text).lower().rstrip("b")
    return int(digits[:-1]) << units[digits[-1]] if digits[-1] in units else int(digits)


def scan_bytes(df: DataFrame) -> int:
    """Size of the files a scan reads, from the optimizer's statistics."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def drop_on_exit(spark: SparkSession, path: str) -> None:
    """Create a folder that the session's file system removes when the application ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)


def shared_folder(spark: SparkSession) -> str | None:
    """Folder every executor can reach, or None when the cluster names none.

    The cluster's ``spark.checkpoint.dir`` wins. Only a local master, where driver and executors
    share one machine, falls back to a temporary folder.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        return None
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="opsward-")
    return _local_scratch[app]


def stored(name: str, df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: it is computed once, and a lost executor costs a scan.

    It goes when the application ends.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{folder}/opsward-{spark.sparkContext.applicationId}/kept/{name}-{uuid.uuid4().hex}"
    drop_on_exit(spark, path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
