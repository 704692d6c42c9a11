"""Removal of repeated runs of lines, in DataFrame functions only.

A run is several lines in sequence, or one line of LONG_WORDS words or more. A line is removed if it stands in
a run that also occurs at an earlier place of the table (smallest doc_id, then text digest, then position; the
two may overlap). Each line of a run of several lines stands in a pair of neighbours of that run, so comparing
all pairs of neighbours and all long lines finds every repeated run, wherever it starts and ends. Of a line that
goes, an equal one stays at an earlier place.
Hashes only propose: pairs and long lines are compared by their SHA-256.

Defined cases: null text is empty and has one empty line; rows that agree in doc_id and text are one
document; null ids order first; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store, whole_text

LONG_WORDS = 50
ROW = ["doc_id", "digest"]


def split_lines(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(whole_text()).alias("digest"), F.split(whole_text(), "\n", -1).alias("lines"))


def spots(docs: DataFrame) -> DataFrame:
    """One row per pair of neighbours (n_lines 2) and per long line (n_lines 1): its place, hash and body."""
    nothing = F.array().cast("array<struct<first: int, n_lines: int, body: string>>")

    def spot(first, n_lines, body):
        return F.struct(first.cast("int").alias("first"), F.lit(n_lines).alias("n_lines"), body.alias("body"))

    pairs = F.transform(
        F.slice("lines", F.lit(2), F.greatest(F.size("lines") - 1, F.lit(0))),
        lambda line, i: spot(i, 2, F.concat(F.get("lines", i), F.lit("\n"), line)),
    )
    singles = F.filter(F.transform("lines", lambda line, i: spot(i, 1, line)), lambda s: F.size(F.split(s["body"], " ", -1)) >= LONG_WORDS)
    found = split_lines(docs).select(*ROW, F.explode(F.concat(nothing, pairs, singles)).alias("s"))
    return found.select(*ROW, "s.first", "s.n_lines", F.xxhash64("s.body").alias("hash"), "s.body")


def repeated_spots(docs: DataFrame) -> DataFrame:
    """doc_id, digest, first line and number of lines of every pair and long line that occurs at an earlier place."""
    found = spots(docs)
    hashes = store(found.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "repeated")
    # The bodies themselves are not shuffled: they would be twice the texts.
    digests = found.select("hash", *ROW, "first", "n_lines", F.unhex(F.sha2("body", 256)).alias("sha"))
    again = store(digests.join(hashes, "hash", "left_semi").drop("hash"), "again")
    place = F.struct(*ROW, "first")
    # A body of a pair holds a line break and a long line none, so equal bodies have equal numbers of lines.
    same = again.groupBy("sha").agg(F.count("*").alias("n"), F.min(place).alias("kept")).where("n > 1").select("sha", "kept")
    return again.join(same, "sha").where(~place.eqNullSafe(F.col("kept"))).select(*ROW, "first", "n_lines")


def dedupe_line_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, removed_lines and the text that stays, for every row."""
    spot = F.struct("first", "n_lines")
    gone = repeated_spots(docs).groupBy(*ROW).agg(F.collect_set(spot).alias("spots"))
    lines = F.flatten(F.transform("spots", lambda s: F.sequence(s["first"], s["first"] + s["n_lines"] - 1)))
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.array_distinct(lines).alias("gone"))
    met = split_lines(docs).join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    # Numbers of the lines that stay, then their texts: no search through the removed ones for each line.
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    return met.withColumn("stay", stay).select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("stay")).cast("long").alias("removed_lines"),
        F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n").alias("text"),
    )


ORACLE = f"""
WITH line AS (
  SELECT doc_id, coalesce(text, '') AS body, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM (SELECT DISTINCT doc_id, text FROM documents)
), paired AS (
  SELECT *, len(string_split(line, ' ')) >= {LONG_WORDS} AS long, lead(line) OVER (PARTITION BY doc_id, body ORDER BY i) AS following
  FROM line
), ranked AS (
  SELECT *, following IS NOT NULL AND row_number() OVER (
           PARTITION BY line, following ORDER BY doc_id NULLS FIRST, body, i) > 1 AS pair_gone,
         long AND row_number() OVER (PARTITION BY line ORDER BY doc_id NULLS FIRST, body, i) > 1 AS line_gone
  FROM paired
), marked AS (
  SELECT *, pair_gone OR line_gone OR coalesce(lag(pair_gone) OVER (PARTITION BY doc_id, body ORDER BY i), false) AS gone FROM ranked
), cleaned AS (
  SELECT doc_id, body, count(*) AS n_lines, count(*) FILTER (gone) AS removed_lines,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY doc_id, body
)
SELECT d.doc_id, c.n_lines, c.removed_lines, c.text
FROM documents d JOIN cleaned c ON c.doc_id IS NOT DISTINCT FROM d.doc_id AND c.body = coalesce(d.text, '')
"""
