"""Helpers shared by the training-data operators.

Texts are read through ``whole_text``: null counts as the empty text. Only the columns an operator
names are read, so further columns of the input, whatever their names, never clash.
"""

from __future__ import annotations

import string
import uuid
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, drop_on_exit, scan_bytes, shared_folder

#: What counts as white space in the contracts: blank and U+0009 to U+000D.
WHITE = r"[\x20\x09-\x0D]"
SHARD_BYTES = 64 << 20
UNKNOWN_BYTES = 1 << 60


#: Rows and bytes that reach a Python worker at once (a single longer row stays whole): its memory is bounded where texts are long.
ARROW_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    for key, value in ARROW_BATCHES.items():
        spark.conf.set(key, value)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def own_prefix(df: DataFrame) -> str:
    """Underscores that no column of the table begins with: names with this prefix never clash with its own."""
    return "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in df.columns), default=0))


def own_columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into a fold; a null id falls into none."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % folds == fold, F.lit(False))


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; it goes when the application ends."""
    shared = shared_folder(spark)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{shared}/opsward-llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    drop_on_exit(spark, path)
    return path


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here and survives lost executors."""
    path = work_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mapped_path(folder: str) -> str:
    """The folder as a path that processes can map into memory."""
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        raise ValueError(f"{folder}: files are mapped into memory, so the shared folder must be mounted (file:)")
    return url.path if url.scheme else folder


def shards(df: DataFrame, bytes_each: int = SHARD_BYTES, least: int = 16) -> int:
    """Number of shards for a table, from the bytes its scan reads; the session's number where none are known."""
    known = scan_bytes(df)
    if known >= UNKNOWN_BYTES:
        return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, -(-known // bytes_each))
