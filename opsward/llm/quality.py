"""Quality by Bradley-Terry ranking: document scores learned from preference pairs.

A text has a fixed set of form features (letters, cases, symbols, repetition, lines, ...). Each is cut at its
quantiles into bins, so a score is a sum of one learned value per feature and bin. Every good and every poor training
text is in a pair, a poor one in PAIRS_EACH or more, and logistic loss on the difference of their features makes the
good one win. The threshold is the exact score quantile at the share of poor texts; scores are mapped so that it lies at 0.7.

All labelled training rows are fitted, in Spark jobs: quantile sketches, pairs within groups of bounded size, a
distributed logistic fit, and counts for the threshold. Every text is scored whole. Defined cases: null and empty texts have zero features and get a score like any other; without both
classes in training the score is constant; repeated rows score alike.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import in_fold, store, whole_text
from .learning import labelled, sigmoid

THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
PAIRS_EACH, BINS = 8, 16
#: Ranks that bin edges may miss, as a share of the rows; ranges that the threshold's range is cut into at a time.
QUANTILE_ACCURACY, SPLITS = 10_000, 1000
#: Rows of the smaller class in a group of pairs and of the larger class in a piece of it, about.
GROUP_ROWS, PIECE_ROWS = 1000, 4000
NAMES = [
    "log_words", "word_length", "upper", "digit", "symbol", "bar", "exclaim", "comma", "stop", "blank", "line_words",
    "distinct", "top_word", "repeats", "upper_words", "symbol_words", "hapax", "packed", "other_letters", "short_lines",
]
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "symbol": b"#$%&*+<=>@[]^_{}~\\/", "bar": b"|", "exclaim": b"!?", "comma": b",;:", "stop": b".", "blank": b" \t\n"}
_CLASS = np.zeros((256, len(_CLASSES)), np.float32)
for _i, _chars in enumerate(_CLASSES.values()):
    _CLASS[list(_chars), _i] = 1
_SYMBOLS = re.compile(r"[#$%&*|~<>=!]{1,}$")


def features(text: str) -> list[float]:
    raw = text.encode()
    words = text.split()
    if not words:
        return [0.0] * len(NAMES)
    n, size = len(words), len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = (counts @ _CLASS / size).tolist()
    seen = Counter(words)
    lines = text.split("\n")
    return [
        np.log1p(n), size / n, *share, n / len(lines), len(seen) / n, max(seen.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n, sum(map(str.isupper, words)) / n,
        sum(1 for w in words if _SYMBOLS.search(w)) / n, sum(1 for c in seen.values() if c == 1) / n,
        len(zlib.compress(raw, 1)) / size, int(counts[128:].sum()) / size, sum(1 for x in lines if len(x) < 20) / len(lines),
    ]


class Ranking:
    """Bin edges of the features, learned values, and the map from score to [0, 1]."""

    def __init__(self, edges: np.ndarray, values: np.ndarray, threshold: float = 0.0, scale: float = 1.0):
        self.edges, self.values, self.threshold, self.scale = edges, values, threshold, scale

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], axis=1)

    def total(self, bins: np.ndarray) -> np.ndarray:
        return self.values[np.arange(len(self.edges)), bins].sum(axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.total(self.bins(x))

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(np.log(THRESHOLD / (1 - THRESHOLD)) + self.scale * (self.raw(x) - self.threshold))


@F.pandas_udf(ArrayType(DoubleType()))
def _measured(text: pd.Series) -> pd.Series:
    return text.map(features)


def measured(docs: DataFrame) -> DataFrame:
    """Stored: doc_id and features of every whole text, measured once for the fit and the scores; no text is shuffled."""
    return store(docs.select("doc_id", _measured(whole_text()).alias("x")), "features")


def cut_points(rows: DataFrame) -> np.ndarray:
    """Bin edges of every feature: quantiles over all rows, each within 1/QUANTILE_ACCURACY of its rank."""
    shares = [float(q) for q in np.linspace(0, 1, BINS + 1)[1:-1]]
    found = rows.agg(*(F.percentile_approx(F.get("x", F.lit(k)), shares, QUANTILE_ACCURACY).alias(name) for k, name in enumerate(NAMES))).first()
    return np.array([found[name] for name in NAMES], float)


def binned(rows: DataFrame, edges: np.ndarray) -> DataFrame:
    """Stored: bins, label and how many rows have them; equal rows are one from here on."""
    model = Ranking(edges, np.zeros((len(edges), BINS)))

    def bins(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = np.array(frame["x"].tolist(), float).reshape(-1, len(edges))
            yield pd.DataFrame({"bins": [b.astype(np.uint8).tobytes() for b in model.bins(x)], "label": frame["label"]})

    return store(rows.mapInPandas(bins, "bins binary, label int").groupBy("bins", "label").agg(F.count("*").alias("n")), "binned")


def preference_pairs(rows: DataFrame) -> DataFrame:
    """Stored: bins of a better and a poorer text and the weight of their pair.

    Different rows are dealt into groups by hash. Where one class is larger, its part of a group is cut further and the
    other class's part meets every piece, so no group grows with the table. In a group every good and
    every poor row is in a pair, a poor one in PAIRS_EACH at least; the pairs weigh as much as the larger class's rows.
    """
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    good, poor = counts[1], counts[0]
    fewer = 1 if good <= poor else 0
    groups = -(-min(good, poor) // GROUP_ROWS)
    pieces = -(-max(good, poor) // (groups * PIECE_ROWS))
    part = lambda seed, parts: F.pmod(F.xxhash64("bins", F.lit(seed)), F.lit(parts)).cast("int")
    met = F.when(F.col("label") == fewer, F.sequence(F.lit(0), F.lit(pieces - 1))).otherwise(F.array(part(2, pieces)))
    dealt = rows.select("bins", "label", "n", part(1, groups).alias("group"), F.explode(met).alias("piece"))

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("bins", ignore_index=True)
        winners, losers = np.flatnonzero(frame["label"] == 1), np.flatnonzero(frame["label"] == 0)
        if not len(winners) or not len(losers):
            return pd.DataFrame(columns=["winner", "loser", "flip", "weight"])
        rng = np.random.default_rng(7)
        many = max(PAIRS_EACH * len(losers), len(winners))
        spread = lambda x: np.concatenate([rng.permutation(x) for _ in range(-(-many // len(x)))])[:many]
        a, b = spread(winners), spread(losers)
        n = frame["n"].to_numpy(float)
        weight = n[a] * n[b]
        weight *= n[losers if fewer == 1 else winners].sum() / weight.sum()
        bins = frame["bins"].to_numpy()
        return pd.DataFrame({"winner": bins[a], "loser": bins[b], "flip": np.arange(many) % 2 == 1, "weight": weight})

    pairs = dealt.groupBy("group", "piece").applyInPandas(meet, "winner binary, loser binary, flip boolean, weight double")
    return store(pairs, "pairs")


@F.udf(VectorUDT())
def _difference(first: bytes, second: bytes) -> SparseVector:
    """One-hot bins of the first text minus those of the second."""
    values = {k * BINS + x: 1.0 for k, (x, y) in enumerate(zip(first, second)) if x != y}
    values |= {k * BINS + y: -1.0 for k, (x, y) in enumerate(zip(first, second)) if x != y}
    return Vectors.sparse(len(first) * BINS, values)


def bradley_terry(pairs: DataFrame, n_features: int, ridge: float = 1e-4, steps: int = 100) -> np.ndarray:
    """Values of all bins that order winners above losers: logistic loss over all pairs without a constant."""
    # Every second pair is seen from its loser: a column that is equal in all pairs would count as a constant.
    first, second = (F.when(F.col("flip"), F.col(x)).otherwise(F.col(y)) for x, y in (("loser", "winner"), ("winner", "loser")))
    won = pairs.select(_difference(first, second).alias("features"), F.when(F.col("flip"), 0.0).otherwise(1.0).alias("label"), "weight")
    fit = LogisticRegression(family="binomial", fitIntercept=False, standardization=False, regParam=ridge, maxIter=steps, weightCol="weight").fit(won)
    return fit.coefficients.toArray().reshape(n_features, BINS)


def score_at(scores: DataFrame, rank: int) -> tuple[float, float]:
    """The scores of the rank-th row (from 0) in ascending order and of the row after it (the same, if none).

    ``scores`` holds raw and n. Counts over SPLITS equal ranges narrow the range that holds the rank until one value is left.
    """
    low, high, n = scores.agg(F.min("raw"), F.max("raw"), F.sum("n")).first()
    after = None
    while low < high:
        place = F.least(F.floor((F.col("raw") - low) / (high - low) * SPLITS), F.lit(SPLITS - 1))
        inside = scores.where(F.col("raw").between(low, high)).groupBy(place.alias("place"))
        ranges = sorted(inside.agg(F.sum("n").alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high")).collect())
        at = 0
        while rank >= ranges[at].n:
            rank -= ranges[at].n
            at += 1
        after = ranges[at + 1].low if at + 1 < len(ranges) else after
        low, high, n = ranges[at].low, ranges[at].high, ranges[at].n
    return low, low if after is None or rank + 1 < n else after


def train(docs: DataFrame, labels: DataFrame) -> Ranking:
    return fitted(measured(docs), labels)


def fitted(found: DataFrame, labels: DataFrame) -> Ranking:
    """Ranking from the features of all labelled rows outside the held-out fold."""
    known = labelled(labels, "quality", ~in_fold("doc_id", FOLDS, HELD_OUT))
    rows = store(found.join(known, "doc_id").select("x", "label"), "labelled")
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    good, poor = counts.get(1, 0), counts.get(0, 0)
    if not good or not poor:
        threshold = -10.0 if good else 10.0 if poor else 0.0
        return Ranking(np.zeros((len(NAMES), BINS - 1)), np.zeros((len(NAMES), BINS)), threshold)
    model = Ranking(cut_points(rows), np.zeros((len(NAMES), BINS)))
    equal = binned(rows, model.edges)
    model.values = bradley_terry(preference_pairs(equal), len(NAMES))

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            bins = np.frombuffer(b"".join(frame["bins"]), np.uint8).reshape(-1, len(NAMES))
            yield pd.DataFrame({"raw": model.total(bins), "n": frame["n"]})

    below, above = score_at(store(equal.mapInPandas(scored, "raw double, n long"), "scores"), poor - 1)
    model.threshold = (below + above) / 2
    return model


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    found = measured(docs)
    model = docs.sparkSession.sparkContext.broadcast(fitted(found, labels))

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.value.score(np.array(x.tolist(), float).reshape(-1, len(NAMES))))

    scored = found.select("doc_id", score("x").alias("score"))
    return scored.select(
        "doc_id", in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
