"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1 in WIDTH dimensions, drawn from a seeded hash of its code
point; combining marks after a letter count as letters. The trigram abc is the product of
a's vector permuted twice, b's permuted once and c's: binding keeps order. A text's vector is the sum
(bundle) of its trigrams' vectors, a language's prototype that of all its training texts, and a text gets
the language whose prototype has the largest cosine with it.

Trigrams of the training fold are counted per language in each batch, bundled there, and the vectors are
added over the whole table. Defined cases: text that is null or without a letter is ``und`` with score 0; rows with null lang
are predicted but not learned from; ties go to the smaller name; without any learned language all are ``und``.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_fold, store

WIDTH, SEED = 1024, 11
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
#: A trigram is a number of three code points; 0 stands for what is no letter.
BITS, POINTS = 21, 0x110000
#: Letters whose vectors a worker remembers before it forgets all of them; above the number in CHUNK trigrams.
MOST_LETTERS, CHUNK = 16_384, 4096

_kinds: list[np.ndarray] = []


def kinds() -> np.ndarray:
    """For each code point: 1 for letters, 2 for combining marks, 0 for others."""
    if not _kinds:
        kind = {"L": 1, "M": 2}
        _kinds.append(np.fromiter((kind.get(unicodedata.category(chr(p))[0], 0) for p in range(POINTS)), np.uint8, POINTS))
    return _kinds[0]


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter trigrams of a text (a blank stands for what is no letter) and their counts."""
    points = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le"), np.uint32).astype(np.int64)
    kind = kinds()[points]
    marks = kind == 2
    if marks.any():
        # A mark is what the last character before it that is no mark is: part of a letter, or of something else.
        kind = kind[np.maximum.accumulate(np.where(marks, 0, np.arange(len(kind))))]
    codes = np.where(kind == 1, points, 0)
    stay = np.ones(len(codes), bool)
    stay[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    codes = codes[stay]
    grams = (codes[:-2] << 2 * BITS) | (codes[1:-1] << BITS) | codes[2:]
    return np.unique(grams[(codes[1:-1] != 0)], return_counts=True)


def letter_bits(point: int) -> np.ndarray:
    """The vector of a code point, 1 for -1 and 0 for +1."""
    drawn = hashlib.shake_128(f"{SEED}:{point}".encode()).digest(WIDTH // 8)
    return np.unpackbits(np.frombuffer(drawn, np.uint8))


class Space:
    """The vectors of letters, each permuted twice, once and not, in bits; binding is their exclusive or."""

    def __init__(self):
        self._slots = np.full(POINTS, -1, np.int32)
        self._bits = np.zeros((3, MOST_LETTERS, WIDTH // 8), np.uint8)
        self._filled = 0

    def _learn(self, points: np.ndarray) -> None:
        new = points[self._slots[points] < 0]
        if self._filled + len(new) > MOST_LETTERS:
            self._slots[:] = -1
            self._filled, new = 0, points
        for point in new.tolist():
            bits = letter_bits(point)
            for back in range(3):
                self._bits[back, self._filled] = np.packbits(np.roll(bits, 2 - back))
            self._slots[point] = self._filled
            self._filled += 1

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the trigrams' vectors, whole numbers."""
        total = np.zeros(WIDTH)
        kind = np.float32 if counts.sum() < 1 << 24 else np.float64
        for at in range(0, len(grams), CHUNK):
            g, n = grams[at : at + CHUNK], counts[at : at + CHUNK].astype(kind)
            points = np.stack([g >> 2 * BITS, (g >> BITS) & ((1 << BITS) - 1), g & ((1 << BITS) - 1)])
            self._learn(np.unique(points))
            first, middle, last = self._slots[points]
            bound = self._bits[0, first] ^ self._bits[1, middle] ^ self._bits[2, last]
            total += n.sum() - 2 * (n @ np.unpackbits(bound, axis=1))
        return total


_space: list[Space] = []


def space() -> Space:
    if not _space:
        _space.append(Space())
    return _space[0]


def _sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bundle of each language's texts of a batch."""
    for frame in frames:
        for lang, texts in frame.groupby("lang")["text"]:
            found = [trigrams(t) for t in texts]
            grams, place = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([c for _, c in found]), len(grams))
            yield pd.DataFrame({"lang": [lang], "vector": [space().bundle(grams, counts).astype(np.int64)]})


def profiles(docs: DataFrame, id_col: str = "doc_id") -> tuple[list[str], np.ndarray]:
    """Languages in order and their unit prototypes. One vector per language comes to the driver."""
    train = docs.where(~in_fold(id_col, FOLDS, HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    parts = train.select("lang", "text").mapInPandas(_sums, "lang string, vector array<long>")
    added = parts.select("lang", F.posexplode("vector").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    whole = added.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "x")))["x"].alias("vector"))
    rows = store(whole, "profiles").orderBy("lang").collect()
    vectors = np.array([r.vector for r in rows], np.float64).reshape(-1, WIDTH)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return [r.lang for r in rows], vectors / np.maximum(norms, 1e-9)


def predict_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles(docs))

    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def predict(text: pd.Series) -> pd.DataFrame:
        names, prototypes = shared.value
        rows = []
        for one in text:
            grams, counts = trigrams(one)
            if not len(grams) or not names:
                rows.append((UNKNOWN, 0.0))
                continue
            vector = space().bundle(grams, counts)
            cosines = prototypes @ vector / max(float(np.linalg.norm(vector)), 1e-9)
            best = int(cosines.argmax())
            rows.append((names[best], float(np.clip(cosines[best], 0, 1))))
        return pd.DataFrame(rows, columns=["lang_pred", "score"])

    found = docs.select("doc_id", predict(F.col("text")).alias("found"))
    return found.select("doc_id", in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"), "found.lang_pred", "found.score")
