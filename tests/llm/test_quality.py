import numpy as np
from pyspark.sql import functions as F

from opsward.llm import quality

LOOKS = {"A": "some plain words here, and a few more of them.", "B": "LOUD 123 #### !!! | 77", "C": "ab ab ab ab\nab ab ab ab"}


def test_all_labelled_rows_are_fitted(spark):
    """Rows behind the first 12,000 of their class by hash say what a look is worth."""
    trained = ~quality.in_fold("doc_id", quality.FOLDS, quality.HELD_OUT)
    ids = [r.doc_id for r in spark.range(25_000).withColumnRenamed("id", "doc_id").where(trained).orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    looks = [("A", 1)] * 9_000 + [("C", 1)] * 3_000 + [("B", 1)] * 6_000 + [("B", 0)] * 100 + [("C", 0)] * 500
    rows = [(i, LOOKS[look], label) for i, (look, label) in zip(ids, looks, strict=False)]
    assert len(rows) == len(looks)
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.train(table.select("doc_id", "text"), table.select("doc_id", "quality"))
    raw = dict(zip(LOOKS, model.raw(np.array([quality.features(t) for t in LOOKS.values()], float))))
    assert raw["B"] > raw["C"] + 1


def test_every_row_is_in_a_pair(spark, monkeypatch):
    monkeypatch.setattr(quality, "GROUP_ROWS", 20)
    monkeypatch.setattr(quality, "PIECE_ROWS", 30)
    for good, poor in ((400, 50), (30, 300)):
        rows = [(bytes([1, i // 256, i % 256]), 1, 1 + i % 3) for i in range(good)] + [(bytes([0, i // 256, i % 256]), 0, 1) for i in range(poor)]
        pairs = quality.preference_pairs(spark.createDataFrame(rows, "bins binary, label int, n long")).toPandas()
        assert {bytes(x) for x in pairs["winner"]} == {r[0] for r in rows if r[1] == 1}
        assert {bytes(x) for x in pairs["loser"]} == {r[0] for r in rows if r[1] == 0}
        assert pairs["loser"].map(bytes).value_counts().min() >= quality.PAIRS_EACH


def test_score_at_is_the_exact_rank(spark):
    scores = [(-5.0, 3), (0.1, 1), (0.1 + 1e-15, 2), (7.5, 1)]
    table = spark.createDataFrame(scores, "raw double, n long")
    flat = sorted(x for x, n in scores for _ in range(n))
    for rank in range(len(flat)):
        assert quality.score_at(table, rank) == (flat[rank], flat[min(rank + 1, len(flat) - 1)])
    assert quality.score_at(spark.createDataFrame([(2.0, 4)], "raw double, n long"), 1) == (2.0, 2.0)
