"""Toxicity by a weighted lexicon, matched by an Aho-Corasick automaton over folded text.

Folding lower-cases and maps homoglyphs and digit substitutions to letters; words are runs of letters
between blanks. The lexicon holds whole words and word beginnings that are much more frequent in toxic
training texts, weighted by log odds; words that a beginning matches but that stand mainly in clean texts
become exception phrases and cancel the match. The matched weight normalised by length, the strongest
match and the number of matches go through a logistic link to the score.

Counting runs in Spark over a bounded labelled sample (``learning.MOST_PER_CLASS``). Every text is scored.
Defined cases: null and empty texts match nothing and get the score of a text without matches; with no
labelled row of one class the score is the share of the other; repeated rows score alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_fold, own_columns, own_prefix, store, whole_text
from .learning import labelled_sample, logistic, sigmoid

THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
BEGINNINGS = (4, 5, 6, 7)
#: A pattern must stand in this share of the toxic training texts, and in LEAST_TEXTS of them.
LEAST_SHARE, LEAST_TEXTS = 0.002, 4
#: Least log odds of a pattern, and of clean texts for an exception.
LEAST_ODDS = 2.5
EXCEPTION_ODDS = 0.5

#: Look-alike characters and the letters they stand for.
FOLD = str.maketrans(
    {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "€": "e"}
    | dict(zip("аеорсухіјѕкмтвнԁԛԝ", "aeopcyxijskmtbhdqw")) | dict(zip("αοενικρτυχ", "aoevikptux"))
    | dict(zip((chr(c) for c in range(0xFF41, 0xFF5B)), "abcdefghijklmnopqrstuvwxyz"))
    | {c: None for c in "​‌‍⁠﻿­"}
)
_LETTERS = re.compile(r"[^\W\d_]+")


def folded_words(text: str) -> list[str]:
    return _LETTERS.findall(text.lower().translate(FOLD))


def patterns_of(word: str) -> list[str]:
    """A whole word and its beginnings, as they stand in blank-separated text."""
    return [f" {word} ", *(f" {word[:n]}" for n in BEGINNINGS if len(word) > n)]


def _count_patterns(only: set | None):
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen = {0: Counter(), 1: Counter()}
            for text, label in zip(frame["text"], frame["label"]):
                own = {p for w in set(folded_words(text)) for p in patterns_of(w)}
                seen[label].update(own if only is None else own & only.value)
            yield pd.DataFrame(
                [(p, seen[0][p], seen[1][p]) for p in {*seen[0], *seen[1]}], columns=["pattern", "clean", "toxic"]
            )

    return count


class Lexicon:
    """Weighted patterns and exception words over an Aho-Corasick automaton, and the logistic link."""

    def __init__(self, weights: dict[str, float], exceptions: set[str] = frozenset(), link: list[float] = (0.0,)):
        self.weights, self.exceptions, self.link = weights, set(exceptions), list(link)
        self._automaton = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def matches(self, words: list[str]) -> Iterator[tuple[str, float]]:
        """The strongest pattern of each word that matches and is no exception."""
        if not self.weights or not words:
            return
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for pattern, weight in self.weights.items():
                self._automaton.add_word(pattern, (len(pattern), weight))
            self._automaton.make_automaton()
        text = f" {' '.join(words)} "
        best: dict[int, float] = {}
        for end, (size, weight) in self._automaton.iter(text):
            start = end - size + 2
            best[start] = max(weight, best.get(start, weight))
        for start, weight in best.items():
            word = text[start : text.index(" ", start)]
            if word not in self.exceptions:
                yield word, weight

    def features(self, text: str) -> tuple[float, float, float, float]:
        words = folded_words(text)
        found = [w for _, w in self.matches(words)]
        if not found:
            return 1.0, 0.0, 0.0, 0.0
        return 1.0, sum(found) / math.sqrt(len(words) + 1), max(found), math.log1p(len(found))

    def score(self, texts: pd.Series) -> np.ndarray:
        x = np.array([self.features(t) for t in texts], float).reshape(-1, 4)
        return sigmoid(x[:, : len(self.link)] @ np.array(self.link))


def train(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """Lexicon from the training fold of the labels."""
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, "toxic", ~in_fold("doc_id", FOLDS, HELD_OUT))
    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        return Lexicon({}, link=[4.0 if toxic else -4.0])
    schema = "pattern string, clean long, toxic long"
    total = [F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")]
    # A pattern stands in at least a fixed share of the toxic texts, so there are boundedly many.
    least = max(LEAST_TEXTS, LEAST_SHARE * toxic)
    often = sample.where("label = 1").mapInPandas(_count_patterns(None), schema).groupBy("pattern").agg(*total).where(F.col("toxic") >= least)
    candidates = spark.sparkContext.broadcast({r.pattern for r in often.select("pattern").collect()})
    counts = sample.mapInPandas(_count_patterns(candidates), schema).groupBy("pattern").agg(*total)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    weights = {r.pattern: r.odds for r in counts.select("pattern", odds.alias("odds")).where(F.col("odds") >= LEAST_ODDS).collect()}

    lexicon = spark.sparkContext.broadcast(Lexicon(weights))

    def hits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen = {0: Counter(), 1: Counter()}
            for text, label in zip(frame["text"], frame["label"]):
                seen[label].update({w for w, _ in lexicon.value.matches(folded_words(text))})
            yield pd.DataFrame([(w, seen[0][w], seen[1][w]) for w in {*seen[0], *seen[1]}], columns=["pattern", "clean", "toxic"])

    words = sample.mapInPandas(hits, schema).groupBy("pattern").agg(*total)
    # Exceptions come from clean texts of a bounded sample that match a bounded lexicon.
    cleared = words.where((F.col("clean") >= 2) & (odds <= -EXCEPTION_ODDS)).select("pattern").collect()
    learned = spark.sparkContext.broadcast(Lexicon(weights, {r.pattern for r in cleared}))

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = pd.DataFrame([learned.value.features(t) for t in frame["text"]], columns=["a", "b", "c", "d"])
            yield x.assign(label=frame["label"].to_numpy(), weight=frame["weight"].to_numpy())

    fit = store(sample.mapInPandas(features, "a double, b double, c double, d double, label int, weight double"), "features").toPandas()
    link = logistic(fit[["a", "b", "c", "d"]].to_numpy(), fit["label"].to_numpy(), fit["weight"].to_numpy())
    return Lexicon(weights, learned.value.exceptions, link.tolist())


def _scorer(docs: DataFrame, lexicon: Lexicon):
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(text))

    return score(whole_text())


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = docs.select("doc_id", "text").withColumn("score", _scorer(docs, train(docs, labels)))
    return scored.select(
        "doc_id", in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below the threshold, with all their columns, whatever their names.

    Null and empty texts are scored like others; rows that repeat stay or go together; an empty table gives an empty result.
    """
    name = f"{own_prefix(docs)}toxicity"
    scored = docs.withColumn(name, _scorer(docs, train(docs, labels)))
    return scored.where(F.col(name) < THRESHOLD).select(*own_columns(docs))
