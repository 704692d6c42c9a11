"""Periodic runs of words by maximal pairs.

A run is a stretch of words with smallest period q and a length of at least max(least, 2 q) that no neighbouring
word extends. It is a maximal pair: two equal stretches that differ in the word before and the word after, at a
distance of q, with a length of at least q. So every maximal pair at a distance of no more than its length is a
run, and nothing has to be extended.

Many documents share one suffix order, in which those of a document stand together. Only suffixes whose first
words (half of ``least``) repeat can pair; ranks of their beginnings double in length until all differ, and the
ranks of all lengths give the longest common prefix (LCP) of neighbours. The LCP-interval tree is built from the
bottom: intervals join in falling order of their LCP, the smaller into the larger. An interval keeps its suffixes
sorted, all together and by left word, so a suffix meets only those within the LCP's distance that another word
precedes. Intervals whose suffixes all follow one word, or lie further apart
than their LCP, hold no such pair and are left out.

A word is dropped if any run contains it after that run's first q words.

Defined cases: null text is empty, has no words and no runs; rows that repeat are each answered; an empty table
gives an empty result. Texts of any length are taken whole; memory grows with the longest one. Each document is
one row's work, so nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import mix

#: Words of several documents that are worked on together; a longer document stands alone.
BATCH_WORDS = 1 << 19
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
Run = tuple[int, int, int]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def numbered(documents: Sequence[list[bytes]], seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all words from 1, with a 0 before the first and after each document; documents of the places; places of the first words."""
    sizes = np.array([len(words) for words in documents], np.int64)
    firsts = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    numbers, known = np.zeros(1 + sizes.sum() + len(sizes) + seed, np.int64), _Numbers({b"": 0})
    for first, words in zip(firsts, documents, strict=True):
        numbers[first : first + len(words)] = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    owner = np.full(len(numbers), len(sizes), np.int64)
    owner[1 : 1 + sizes.sum() + len(sizes)] = np.repeat(np.arange(len(sizes)), sizes + 1)
    return numbers, owner, firsts


def packed(numbers: np.ndarray, seed: int) -> list[np.ndarray]:
    """Columns that order places by their next ``seed`` words, several words to a column."""
    bits = max(1, int(numbers.max()).bit_length())
    n, columns = len(numbers) - seed + 1, []
    for first in range(0, seed, 63 // bits):
        column = np.zeros(n, np.int64)
        for k in range(first, min(seed, first + 63 // bits)):
            column = column << bits | numbers[k : k + n]
        columns.append(column)
    return columns


def _groups(keys: np.ndarray) -> np.ndarray:
    """Place of the first of each stretch of equal keys, for every key."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)[np.cumsum(new) - 1]


def _in_company(group: np.ndarray) -> np.ndarray:
    alone = np.ones(len(group) + 1, bool)
    alone[1:-1] = group[1:] != group[:-1]
    return ~(alone[1:] & alone[:-1])


def repeated_beginnings(numbers: np.ndarray, columns: list[np.ndarray], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of words that with those after them stand elsewhere in their document too, sorted by these words, and their group."""
    keys = [*columns, owner[: len(columns[0])]]
    hashes = np.zeros(len(keys[0]), np.uint64)
    for key in keys:
        hashes = mix(hashes * _FACTOR + key.view(np.uint64))
    order = np.argsort(hashes)
    order = order[_in_company(_groups(hashes[order])) & (numbers[order] > 0)]
    order = order[np.lexsort([key[order] for key in keys])]
    differs = np.zeros(max(0, len(order) - 1), bool)
    for key in keys:
        differs |= key[order[1:]] != key[order[:-1]]
    group = _groups(np.concatenate([[0], np.cumsum(differs)])[: len(order)])
    some = _in_company(group)
    order = order[some]
    return order, _groups(group[some])


def neighbours(numbers: np.ndarray, owner: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes with a repeated beginning in suffix order, the LCP of each with the next one of its group, and the group."""
    columns = packed(numbers, seed)
    names, first = repeated_beginnings(numbers, columns, owner)
    at = np.full(len(numbers), -1, np.int64)
    at[names] = np.arange(len(names))
    group, length, levels = first.copy(), seed, []
    slots, rank = np.arange(len(names)), np.empty(len(names), np.int64)
    while len(slots):
        rank[at[names]] = group
        levels.append(rank.astype(np.int32 if len(names) < 1 << 31 else np.int64))
        follow = np.minimum(names[slots] + length, len(columns[0]) - 1)
        behind = np.where(at[follow] >= 0, rank[at[follow]], len(names) + follow)
        # What follows is ordered by its words; its rank orders what agrees in them.
        sort = np.lexsort((behind, *(column[follow] for column in reversed(columns)), group[slots]))
        names[slots] = names[slots][sort]
        new = np.ones(len(slots), bool)
        new[1:] = (group[slots][1:] != group[slots][:-1]) | (behind[sort][1:] != behind[sort][:-1])
        group[slots] = slots[np.flatnonzero(new)[np.cumsum(new) - 1]]
        slots = slots[_in_company(group[slots])]
        length *= 2
    left, right = names[:-1].copy(), names[1:].copy()
    for level in reversed(levels):
        length //= 2
        i, j = at[left], at[right]
        step = np.where((i >= 0) & (j >= 0) & (level[i] == level[j]), length, 0)
        left += step
        right += step
    for _ in range(seed - 1):
        step = numbers[left] == numbers[right]
        left += step
        right += step
    return names, left - names[:-1], first


class _Interval:
    """Suffixes of an LCP interval, sorted, all together and by the word before them."""

    __slots__ = ("all", "by_left")

    def __init__(self, place: int, left: int):
        self.all, self.by_left = [place], {left: [place]}

    def near(self, place: int, left: int, distance: int) -> Iterator[int]:
        """Suffixes within the distance of a place that follow another word; stretches that follow the same word are leapt over."""
        i, stop = bisect_left(self.all, place - distance), bisect_right(self.all, place + distance)
        same = self.by_left.get(left, ())
        while i < stop:
            k = bisect_left(same, self.all[i])
            if k == len(same) or same[k] != self.all[i]:
                yield self.all[i]
                i += 1
            else:
                most = min(stop - i, len(same) - k)
                i += bisect_left(range(1, most), True, key=lambda m: self.all[i + m] != same[k + m]) + 1

    def take(self, other: _Interval) -> None:
        for mine, new in [(self.all, other.all), *((self.by_left.setdefault(left, []), own) for left, own in other.by_left.items())]:
            if len(new) * 8 < len(mine):
                for place in new:
                    mine.insert(bisect_left(mine, place), place)
            else:
                mine += new
                mine.sort()


def pairs(places: list[int], lcps: list[int], lefts: list[int], least: int) -> Iterator[Run]:
    """(first place, length of the stretch that both cover, distance) of the maximal pairs of one tree that are runs."""
    top = list(range(len(places)))
    tree = [_Interval(p, left) for p, left in zip(places, lefts, strict=True)]
    left_of = dict(zip(places, lefts, strict=True))

    def root(i: int) -> int:
        while top[i] != i:
            top[i] = i = top[top[i]]
        return i

    for k in sorted(range(len(lcps)), key=lcps.__getitem__, reverse=True):
        large, small = root(k), root(k + 1)
        if len(tree[large].all) < len(tree[small].all):
            large, small = small, large
        for place in tree[small].all:
            for other in tree[large].near(place, left_of[place], lcps[k]):
                distance = abs(place - other)
                if distance + lcps[k] >= least:
                    yield min(place, other), distance + lcps[k], distance
        tree[large].take(tree[small])
        top[small], tree[small] = large, None


def find_runs(documents: Sequence[list[bytes]], least: int = 12) -> list[list[Run]]:
    """(start, length, period) of every run of each document, by start, then period."""
    seed = max(1, -(-least // 2))
    numbers, owner, firsts = numbered(documents, seed)
    order, lcp, group = neighbours(numbers, owner, seed)
    found: dict[tuple[int, int], int] = {}
    if len(order):
        starts = np.unique(group)
        stops = np.append(starts[1:], len(order))
        lefts = numbers[order - 1]
        sorted_places = order[np.lexsort((order, group))]
        gaps = np.append(np.diff(sorted_places), np.iinfo(np.int64).max)
        gaps[stops - 1] = np.iinfo(np.int64).max  # to the next group
        inner = np.append(lcp, 0)
        inner[stops - 1] = 0
        some = (np.minimum.reduceat(lefts, starts) != np.maximum.reduceat(lefts, starts)) & (
            np.minimum.reduceat(gaps, starts) <= np.maximum.reduceat(inner, starts)
        )
        for a, b in zip(starts[some].tolist(), stops[some].tolist(), strict=True):
            for place, length, period in pairs(order[a:b].tolist(), lcp[a : b - 1].tolist(), lefts[a:b].tolist(), least):
                # Multiples of the smallest period pair the same stretch.
                found[place, length] = min(period, found.get((place, length), period))
    runs: list[list[Run]] = [[] for _ in documents]
    if found:
        every = np.array([(place, length, period) for (place, length), period in found.items()], np.int64)
        every = every[np.lexsort((every[:, 2], every[:, 0]))]
        owners = owner[every[:, 0]]
        every[:, 0] -= firsts[owners]
        for i, run in zip(owners.tolist(), every.tolist(), strict=True):
            runs[i].append(tuple(run))
    return runs


def collapsed(words: list[bytes], runs: list[Run]) -> str:
    """The words that no run contains after its first period, joined by one blank."""
    if runs:
        edges = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edges[start + period] += 1
            edges[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
    return b" ".join(words).decode()


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """Words of one document in ten repeat with a period from some place on, both chosen by the id's crc32; a null id plants nothing."""
    if doc_id is None or not words:
        return words
    h = crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


_RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
_ANSWER = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(_RUN)), T.StructField("collapsed", T.StringType())])


def _answer(least: int, prepare: Callable[[object, list[bytes]], list[bytes]] | None) -> Callable[..., Column]:
    @F.pandas_udf(_ANSWER)
    def answer(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        out, held, n = [], [], 0

        def settle() -> None:
            out.extend((len(w), r, collapsed(w, r)) for w, r in zip(held, find_runs(held, least), strict=True))
            held.clear()

        for doc_id, text in zip(ids, texts, strict=True):
            words = (text or "").encode().split()  # of bytes: at blank and U+0009 to U+000D only
            held.append(prepare(doc_id, words) if prepare else words)
            n += len(words)
            if n >= BATCH_WORDS:
                settle()
                n = 0
        settle()
        runs = [[dict(zip(_RUN.names, run, strict=True)) for run in found] for _, found, _ in out]
        return pd.DataFrame({"n_words": [x[0] for x in out], "runs": runs, "collapsed": [x[2] for x in out]})

    return answer


def periodic_runs(
    docs: DataFrame, least: int = 12, prepare: Callable[[object, list[bytes]], list[bytes]] | None = None
) -> DataFrame:
    """doc_id, n_words, runs (start, length and period in words, by start) and the collapsed text, for every row.

    ``prepare(doc_id, words)`` may change the words before they are searched.
    """
    found = docs.select("doc_id", _answer(least, prepare)(F.col("doc_id").cast("string"), F.col("text").cast("string")).alias("found"))
    return found.select("doc_id", "found.*")


def digests(found: DataFrame) -> DataFrame:
    """One row per document: number of runs, the longest one (then the first, then that with the smallest period), and SHA-256 of both results."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    best = F.struct((-best["col2"]).alias("start"), best["length"].alias("length"), (-best["col3"]).alias("period"))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
