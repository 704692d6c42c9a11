"""Removal of repeated line chunks, in DataFrame functions only.

A document is a sequence of lines. A chunk ends after a line where the rolling hash over the last
WINDOW line hashes is divisible by DIVISOR, so boundaries follow the content and meet again after an
insertion. A line of LONG_WORDS words or more is a chunk of its own. Chunks of several lines, and those
long lines, that occur more than once in the whole table are removed but for their first occurrence
(smallest doc_id, then text digest, then position). Chunks are equal when their SHA-256 is, so that digests and
not texts are shuffled. The texts themselves meet their removed chunks in one shuffle, the same at every size.

Defined cases: null text is empty and has one empty line; rows that agree in doc_id and text are one
document; null ids order first; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store, whole_text

WINDOW, DIVISOR, LONG_WORDS = 2, 3, 50
ROW = ["doc_id", "digest"]


def line_hash(line: Column) -> Column:
    """32 bits of a line's MD5 as a number."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def chunked(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, lines, and chunks as (first line, number of lines, words)."""
    lines = docs.select("doc_id", F.xxhash64(whole_text()).alias("digest"), F.split(whole_text(), "\n", -1).alias("lines"))
    hashed = lines.withColumns({
        "hashes": F.transform("lines", line_hash), "words": F.transform("lines", lambda x: F.size(F.split(x, " ", -1))),
    })

    def ends_after(i: Column) -> Column:
        rolling = F.get("hashes", i - 1)
        for back in range(1, WINDOW):
            rolling = rolling + F.coalesce(F.get("hashes", F.when(i - 1 - back >= 0, i - 1 - back)), F.lit(0)) * (2 * back + 1)
        long = lambda at: F.coalesce(F.get("words", at) >= LONG_WORDS, F.lit(False))
        return (rolling % DIVISOR == 0) | long(i - 1) | long(i) | (i == F.size("lines"))

    ends = F.filter(F.sequence(F.lit(1), F.size("lines")), ends_after)
    starts = F.concat(F.array(F.lit(0)), F.slice("ends", 1, F.size("ends") - 1))
    chunk = lambda a, b: F.struct(
        a.alias("first"), (b - a).alias("n_lines"),
        F.aggregate(F.slice("words", a + 1, b - a), F.lit(0), lambda x, y: x + y).alias("words"),
    )
    return hashed.withColumn("ends", ends).withColumn("chunks", F.zip_with(starts, "ends", chunk)).select(*ROW, "lines", "chunks")


def occurrences(cut: DataFrame) -> DataFrame:
    """One row per chunk that may be removed: place and SHA-256 of its text."""
    body = F.array_join(F.slice("lines", F.col("c.first") + 1, F.col("c.n_lines")), "\n")
    candidates = F.filter("chunks", lambda c: (c["n_lines"] > 1) | (c["words"] >= LONG_WORDS))
    found = cut.select(*ROW, "lines", F.explode(candidates).alias("c"))
    return found.select(*ROW, F.col("c.first").alias("first"), F.unhex(F.sha2(body, 256)).alias("sha"))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, digest, first line of every chunk to remove."""
    place = F.struct(*ROW, "first")
    found = store(occurrences(chunked(docs)), "chunks")
    same = found.groupBy("sha").agg(F.count("*").alias("n"), F.min(place).alias("kept")).where("n > 1").select("sha", "kept")
    again = found.select("sha", place.alias("place")).join(same, "sha")
    return again.where(~F.col("place").eqNullSafe(F.col("kept"))).select("place.*")


def dedupe_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_chunks, removed_chunks, removed_lines and the text that stays, for every row."""
    removed = repeated_chunks(docs).distinct().groupBy(*ROW).agg(F.collect_list("first").alias("gone"))
    gone = removed.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "gone").hint("merge")
    met = chunked(docs).join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    dropped = lambda c: F.coalesce(F.array_contains("gone", c["first"]), F.lit(False))
    stay = F.filter("chunks", lambda c: ~dropped(c))
    went = F.filter("chunks", dropped)
    lines = F.transform(stay, lambda c: F.array_join(F.slice("lines", c["first"] + 1, c["n_lines"]), "\n"))
    return met.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("chunks").cast("long").alias("n_chunks"),
        F.size(went).cast("long").alias("removed_chunks"),
        F.aggregate(went, F.lit(0), lambda x, c: x + c["n_lines"]).cast("long").alias("removed_lines"),
        F.array_join(lines, "\n").alias("text"),
    )


ORACLE = f"""
WITH line AS (
  SELECT doc_id, coalesce(text, '') AS body, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i,
         len(string_split(coalesce(text, ''), chr(10))) AS n
  FROM (SELECT DISTINCT doc_id, text FROM documents)
), hashed AS (
  SELECT *, len(string_split(line, ' ')) >= {LONG_WORDS} AS long, len(string_split(line, ' ')) AS words,
         CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h
  FROM line
), ended AS (
  SELECT *, (h + coalesce(lag(h) OVER w, 0) * 3) % {DIVISOR} = 0 OR long OR coalesce(lead(long) OVER w, false) OR i = n AS ends
  FROM hashed WINDOW w AS (PARTITION BY doc_id, body ORDER BY i)
), numbered AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id, body ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk
  FROM ended
), chunk AS (
  SELECT doc_id, body, chunk, count(*) AS n_lines, min(i) AS first, sum(words) AS words,
         string_agg(line, chr(10) ORDER BY i) AS part
  FROM numbered GROUP BY ALL
), ranked AS (
  SELECT *, (n_lines > 1 OR words >= {LONG_WORDS}) AND row_number() OVER (
           PARTITION BY part, n_lines > 1 OR words >= {LONG_WORDS} ORDER BY doc_id NULLS FIRST, body, first) > 1 AS gone
  FROM chunk
), cleaned AS (
  SELECT doc_id, body, CAST(sum(n_lines) AS BIGINT) AS n_lines, count(*) AS n_chunks, count(*) FILTER (gone) AS removed_chunks,
         CAST(coalesce(sum(n_lines) FILTER (gone), 0) AS BIGINT) AS removed_lines,
         coalesce(string_agg(part, chr(10) ORDER BY first) FILTER (NOT gone), '') AS text
  FROM ranked GROUP BY doc_id, body
)
SELECT d.doc_id, c.n_lines, c.n_chunks, c.removed_chunks, c.removed_lines, c.text
FROM documents d JOIN cleaned c ON c.doc_id IS NOT DISTINCT FROM d.doc_id AND c.body = coalesce(d.text, '')
"""
