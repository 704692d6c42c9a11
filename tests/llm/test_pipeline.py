"""The pipeline's stages on odd rows, clashing column names and empty tables, against what each should keep."""

import corpus_pipeline
import pytest
from conftest import SF_DIR
from opsward.llm import toxicity
from pyspark.sql import functions as F

CLASHING = "_found _toxicity _id _n _chars _sha _sha_of _chars_of _digest _digest_of __x count key digest component".split()
LONG = "words of a text that is long enough for shingles of five words each and then some more so one change leaves most equal " * 3


def table(spark, texts):
    """(doc_id, text) with a column of every name that stages use inside, each with its own value."""
    df = spark.createDataFrame(texts, "doc_id long, text string")
    return df.select("*", *[F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHING])


def keeps(spark, stage, texts, wanted):
    docs = table(spark, texts)
    got = dict(corpus_pipeline.STAGES)[stage](spark, docs, SF_DIR)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted((r.doc_id, r.text) for r in rows) == sorted(wanted)
    assert all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in CLASHING)
    assert dict(corpus_pipeline.STAGES)[stage](spark, docs.limit(0), SF_DIR).count() == 0


def test_exact_dedup(spark):
    texts = [(1, "a b"), (2, "a  b"), (3, "ab"), (4, ""), (5, None), (6, "c"), (6, "c"), (7, "d " * 20_000)]
    keeps(spark, "exact_dedup", texts, [(2, "a  b"), (4, ""), (6, "c"), (7, "d " * 20_000)])


def test_near_dedup(spark):
    texts = [(1, LONG), (2, LONG + "tail"), (3, "quite another text of some words"), (4, ""), (5, None), (8, "twice here it is"), (8, "twice here it is")]
    docs = [(i, t) for i, t in texts if t]
    keeps(spark, "near_dedup", docs, [(1, LONG), (3, "quite another text of some words"), (8, "twice here it is")])
    kept = corpus_pipeline.near_dedup(spark, table(spark, texts), SF_DIR).collect()
    assert {r.doc_id for r in kept} == {1, 3, 4, 5, 8}


def test_decontamination(spark):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").where("size(split(text, ' ')) > 15").first().text
    texts = [(1, "before " + item + " after"), (2, "nothing of that kind"), (3, ""), (4, "!!")]
    keeps(spark, "decontamination", texts, texts[1:])


def test_toxicity_drops_what_scores_toxic(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    docs = given.select("*", *[F.lit(c).alias(c) for c in CLASHING])
    wanted = {r.doc_id for r in toxicity.toxicity(given, labels).where("predicted = 0").collect()}
    got = corpus_pipeline.toxicity(spark, docs, SF_DIR)
    rows = got.collect()
    assert got.columns == docs.columns and {r.doc_id for r in rows} == wanted and all(r[c] == c for r in rows for c in CLASHING)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES][:-1])
def test_stages_keep_the_columns_of_documents(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert dict(corpus_pipeline.STAGES)[name](spark, docs.limit(0), SF_DIR).columns == docs.columns
