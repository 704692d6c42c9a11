"""Small helpers of the trained operators: bounded labelled samples and a weighted logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store, whole_text

#: Labelled rows of each class that a classifier is fitted on at most; documented bound of the sample.
MOST_PER_CLASS = 12_000


def labelled(labels: DataFrame, label: str, train: Column) -> DataFrame:
    """doc_id and label of all training rows: 1 if any of a document's labels is; null labels are left out."""
    return labels.where(train & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, most: int = MOST_PER_CLASS) -> DataFrame:
    """Stored text, label and class weight of at most ``most`` training rows of each class, by hash of their id.

    The sample's ids are bounded (2 x most rows), so they may be broadcast; weights restore the classes' shares.
    A document with several labels counts as 1 if any is; null labels are left out.
    """
    known = labelled(labels, label, train)
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    picks = None
    for value in (0, 1):
        n = counts.get(value, 0)
        own = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        own = own.withColumn("weight", F.lit(n / max(1, min(n, most))))
        picks = own if picks is None else picks.unionByName(own)
    return store(docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(picks), "doc_id").select("text", "label", "weight"), "sample")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton's method for weighted logistic regression; the first column of x is the constant."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[0] = 1e-6
    weight = weight / max(weight.sum(), 1e-9) * max(len(y), 1)
    for _ in range(steps):
        p = sigmoid(x @ w)
        slope = x.T @ (weight * (y - p)) - shrink * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(shrink)
        step = np.linalg.solve(curve, slope)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w
