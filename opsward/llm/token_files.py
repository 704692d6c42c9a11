"""Token ids of documents as flat binary files with 64-bit document offsets.

Documents are range-partitioned and sorted by doc_id (then text digest, so equal ids of different texts
can be split). Every partition writes one shard: ``ids-N`` with the ids of its documents one after the
other (16 bits wide where the vocabulary fits, else 32), ``ends-N`` with the 64-bit end of each document
inside the shard, and ``docs-N`` with doc_id and whether it is null. A shard appears under its name by one
rename, so a repeated or speculative attempt replaces it by the same bytes. The manifest (one row per
shard) holds the prefix sums of tokens and documents: a document's place is its shard's base plus its
offset inside. Readers map shards into memory.

Defined cases: null text is empty and gives the end id alone; null ids come first; rows that repeat an
id keep one entry each; an empty table gives an empty manifest.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mapped_path, shards, store, whole_text, work_folder
from .tokens import crc, encoder

DOC = np.dtype([("doc_id", "<i8"), ("known", "?")])
ROWS_AT_ONCE = 10_000


def _write_shards(root: str, tokenizer: str, width: str):
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        shard, attempt = context.partitionId(), context.taskAttemptId()
        names = {kind: os.path.join(root, f"{kind}-{shard:06d}") for kind in ("ids", "ends", "docs")}
        files = {kind: open(f"{name}.{attempt}", "wb") for kind, name in names.items()}  # noqa: SIM115
        encode, end, docs = encoder(tokenizer).ids, 0, 0
        for frame in frames:
            ends = np.empty(len(frame), "<i8")
            keys = np.zeros(len(frame), DOC)
            keys["known"] = frame["doc_id"].notna()
            keys["doc_id"] = frame["doc_id"].fillna(0).astype("int64")
            for i, text in enumerate(frame["text"]):
                ids = encode(text)
                files["ids"].write(ids.astype(width).tobytes())
                end += len(ids)
                ends[i] = end
            files["ends"].write(ends.tobytes())
            files["docs"].write(keys.tobytes())
            docs += len(frame)
        for kind, file in files.items():
            file.close()
            os.replace(file.name, names[kind])
        yield pd.DataFrame({"shard": [shard], "docs": [docs], "tokens": [end]})

    return write


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write the files into a folder (a new one below the shared folder by default) and return the manifest."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    folder = folder or work_folder(spark, "tokens")
    root = mapped_path(folder)
    os.makedirs(root, exist_ok=True)
    width = "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"
    rows = docs.select("doc_id", whole_text().alias("text")).withColumn("tie", F.xxhash64("text"))
    placed = rows.repartitionByRange(shards(docs, 16 << 20), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    written = placed.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        _write_shards(root, tokenizer, width), "shard int, docs long, tokens long"
    )
    # One row per shard: the prefix sums are taken over the number of shards, never of documents.
    counts = store(written, "shards").orderBy("shard").toPandas()
    counts["first_doc"] = counts["docs"].cumsum() - counts["docs"]
    counts["base"] = counts["tokens"].cumsum() - counts["tokens"]
    counts["root"], counts["width"] = root, width
    manifest = spark.createDataFrame(counts, "shard int, docs long, tokens long, first_doc long, base long, root string, width string")
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def open_shard(root: str, shard: int, width: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, ends and ids of a shard, mapped from its files."""
    def mapped(kind: str, dtype) -> np.ndarray:
        path = os.path.join(root, f"{kind}-{shard:06d}")
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)

    return mapped("docs", DOC), mapped("ends", "<i8"), mapped("ids", width)


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for shard in frame.itertuples():
            keys, ends, ids = open_shard(shard.root, shard.shard, shard.width)
            for at in range(0, len(keys), ROWS_AT_ONCE):
                last = np.asarray(ends[at : at + ROWS_AT_ONCE])
                first = np.concatenate([[ends[at - 1] if at else 0], last[:-1]])
                own = keys[at : at + ROWS_AT_ONCE]
                yield pd.DataFrame({
                    "doc_id": pd.array(own["doc_id"], "Int64").copy() if own["known"].all() else pd.Series(own["doc_id"], dtype="Int64").where(own["known"]),
                    "start": shard.base + first, "n_tokens": last - first,
                    "ids_crc32": [crc(ids[a:b].astype("<u4")) for a, b in zip(first, last)],
                })


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    spread = manifest.repartition(max(1, manifest.count()), "shard")
    return spread.mapInPandas(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def open_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/manifest")
