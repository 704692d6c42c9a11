"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame functions only.

Every scan partition forms a run of digests. In each round the partitions whose numbers agree above
the next FAN_BITS bits exchange their runs, and equal digests merge: the run that receives them is
sorted again, a short digest is verified by the full SHA-256 of the normalised text, and the best row
survives with the group's size. A round moves at most one row per digest and run, so a text that
fills a third of the table arrives as a few rows. Texts themselves are never shuffled.

Defined cases: null text is empty; of rows equal in length and doc_id one stays (any: they agree in
what is compared); a null doc_id loses to every other; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, own_columns, own_prefix, store, whole_text

RUN_BITS, FAN_BITS = 8, 4
KEY = ["short", "sha"]


def digests(docs: DataFrame) -> DataFrame:
    """One narrow row per document: its place, length in code points, and digests of the text without white space."""
    return (
        docs.select("doc_id", whole_text().alias("text"))
        .select("doc_id", F.length("text").cast("long").alias("chars"), F.regexp_replace("text", WHITE, "").alias("bare"))
        .select(
            "doc_id", "chars", F.xxhash64("bare").alias("short"), F.unhex(F.sha2("bare", 256)).alias("sha"),
            F.monotonically_increasing_id().alias("place"), (F.spark_partition_id() % (1 << RUN_BITS)).alias("run"),
        )
    )


def merge_runs(rows: DataFrame) -> DataFrame:
    """(short, sha) -> best row and number of rows, merged in rounds of 2^FAN_BITS runs."""
    best = F.struct("chars", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("place").alias("place"))
    level = rows.select(*KEY, "run", best.alias("best"), F.lit(1).cast("long").alias("n"))
    for _ in range(RUN_BITS // FAN_BITS):
        level = (
            level.withColumn("run", F.shiftright("run", FAN_BITS))
            .groupBy(*KEY, "run")
            .agg(F.max("best").alias("best"), F.sum("n").alias("n"))
        )
    return level.select(
        *KEY, F.bitwise_not("best.id").alias("keep_id"), F.bitwise_not("best.place").alias("keep_place"),
        F.col("best.chars").alias("keep_chars"), F.col("n").alias("group_size"),
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    Texts are equal without their white space. Of equal ones the longest in code points stays, then the
    smallest doc_id. Only groups of two or more are joined to their rows.
    """
    rows = store(digests(docs), "digests")
    groups = merge_runs(rows).where("group_size > 1")
    return rows.join(groups, KEY, "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("keep_place") == F.col("place"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns, whatever their names.

    A document is found again by doc_id, length and text digest. Rows that repeat all three are ties, of which
    one stays; only then are the survivors of those groups collapsed.
    """
    p = own_prefix(docs)
    rows = store(digests(docs), "digests")
    groups = merge_runs(rows)
    stay = store(
        rows.join(groups.where("group_size > 1"), KEY, "left")
        .where(F.col("keep_place").isNull() | ((F.col("keep_chars") == F.col("chars")) & F.col("keep_id").eqNullSafe(F.col("doc_id"))))
        .groupBy(F.col("doc_id").alias(f"{p}id"), F.col("chars").alias(f"{p}chars"), F.col("sha").alias(f"{p}sha")).agg(F.count("*").alias(f"{p}n")),
        "stay",
    )
    bare = F.regexp_replace(whole_text(), WHITE, "")
    keyed = docs.withColumns({f"{p}sha_of": F.unhex(F.sha2(bare, 256)), f"{p}chars_of": F.length(whole_text()).cast("long")})
    same = F.col("doc_id").eqNullSafe(F.col(f"{p}id")) & (F.col(f"{p}chars_of") == F.col(f"{p}chars")) & (F.col(f"{p}sha_of") == F.col(f"{p}sha"))
    met = keyed.join(stay, same, "inner")
    if stay.where(F.col(f"{p}n") > 1).limit(1).count():
        single, tied = met.where(F.col(f"{p}n") == 1), met.where(F.col(f"{p}n") > 1).dropDuplicates([f"{p}id", f"{p}chars", f"{p}sha"])
        met = single.unionByName(tied)
    return met.select(*own_columns(docs))


ORACLE = r"""
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY sha ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY sha) AS group_size,
       row_number() OVER (PARTITION BY sha ORDER BY chars DESC, doc_id) = 1 AS kept,
       sha AS text_sha256
FROM bare
"""
