"""Interpolated modified Kneser-Ney bigram model, counted in Spark and scored from memory-mapped arrays.

Training has three rounds, each of which deals pre-aggregated sorted runs into shards:

1. words: 64-bit word hashes with counts; a shard holds a range of hashes, sorted, and a word's id is its
   place in that order over all shards;
2. bigrams: (context id, word id) keys with counts, sorted. A shard holds a range of contexts, with the
   number of followers seen once, twice and more often for each. A hot context (over 1/HOT of all tokens;
   at most HOT of them) is spread over all shards by a hash of the bigram instead, and its numbers are summed;
3. continuations: in how many contexts each word occurs, an array over the ids of a shard's range.

Workers map the shards of the shared folder into memory and look sorted queries up by binary search, so
neither tables nor texts pass through the driver; it sees one row per shard and hot context. All counts
cover the whole training fold; nothing is pruned.

Discounts come from the numbers of entries counted once to four times, for bigrams and for continuations;
the lowest order is interpolated with the uniform distribution over the vocabulary and one unknown word.
Defined cases: null text is empty and has the end token alone; without training rows every token has the
probability of the uniform distribution over the unknown word, 1; repeated rows count and score each.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_fold, mapped_path, shards, store, whole_text, work_folder
from .words import mix, word_hashes, words_of

FOLDS, HELD_OUT = 7, 2
HOT = 1000
#: Tokens a task gathers before it sorts and counts them.
RUN_TOKENS = 3_000_000
SHARD_INPUT = 16 << 20
END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))
CONTEXT = np.dtype([("id", "<u4"), ("once", "<u4"), ("twice", "<u4"), ("more", "<u4")])
_LOW = np.uint64(0xFFFFFFFF)


def token_hashes(text: str) -> np.ndarray:
    """Hashes of a text's words and the end token."""
    return np.append(word_hashes(words_of(text)), END)


def _save(root: str, name: str, array: np.ndarray) -> None:
    """Write an array under its name by one rename, so repeated attempts replace it by the same bytes."""
    path = os.path.join(root, name)
    part = f"{path}.{TaskContext.get().taskAttemptId()}"
    array.tofile(part)
    os.replace(part, path)


def _mapped(root: str, name: str, dtype) -> np.ndarray:
    path = os.path.join(root, name)
    if not os.path.exists(path) or not os.path.getsize(path):
        return np.empty(0, dtype)
    return np.memmap(path, dtype, "r")


def _count_runs(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(keys), return_counts=True) if keys else (np.empty(0, np.uint64), np.empty(0, np.int64))


def _merge(keys: pd.Series, counts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Sorted runs (keys as differences) into one: distinct keys and summed counts."""
    k = np.concatenate([np.cumsum(np.frombuffer(x, "<u8"), dtype=np.uint64) for x in keys])
    c = np.concatenate([np.frombuffer(x, "<u4") for x in counts])
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[first], np.add.reduceat(c.astype(np.int64), first)


def _deal(shard: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
    """Runs of sorted keys by shard, as differences."""
    order = np.argsort(shard, kind="stable")
    shard, keys, counts = shard[order], keys[order], counts[order].astype("<u4")
    starts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else []
    rows = []
    for a, b in zip(starts, [*starts[1:], len(shard)]):
        rows.append((int(shard[a]), np.diff(keys[a:b], prepend=np.uint64(0)).astype("<u8").tobytes(), counts[a:b].tobytes()))
    return pd.DataFrame(rows, columns=["shard", "keys", "counts"])


_RUN = "shard int, keys binary, counts binary"


@dataclass
class Model:
    """Places and numbers of a stored model; arrays are mapped when a worker first needs them."""

    root: str
    bits: int
    sizes: list[int]
    tokens: int
    texts: int = 0
    hot_part: int = HOT
    discounts: list[float] = field(default_factory=lambda: [0.0] * 4)
    low_discounts: list[float] = field(default_factory=lambda: [0.0] * 4)
    low_total: int = 0
    low_left: float = 0.0
    hot: dict[int, tuple[int, int, int]] = field(default_factory=dict)
    _open: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def __post_init__(self):
        self.bases = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.words = int(self.bases[-1])
        if self.words >= 1 << 32:
            raise ValueError("a model holds at most 2^32 words")
        self.bounds = np.arange((1 << self.bits) + 1) * self.words // (1 << self.bits)

    @property
    def begin(self) -> int:
        return self.words

    def array(self, kind: str, shard: int, dtype) -> np.ndarray:
        name = f"{kind}-{shard:05d}"
        if name not in self._open:
            self._open[name] = _mapped(self.root, name, dtype)
        return self._open[name]

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of sorted distinct word hashes."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        shard = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        cuts = np.searchsorted(shard, np.arange((1 << self.bits) + 1))
        for s in range(1 << self.bits):
            a, b = cuts[s], cuts[s + 1]
            known = self.array("words", s, "<u8")
            if a == b or not len(known):
                continue
            at = np.minimum(np.searchsorted(known, hashes[a:b]), len(known) - 1)
            there = known[at] == hashes[a:b]
            ids[a:b] = np.where(there, self.bases[s] + at, -1)
            counts[a:b] = np.where(there, self.array("counts", s, "<u4")[at], 0)
        return ids, counts

    def range_of(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, ids, "right") - 1

    def shard_of(self, keys: np.ndarray, hot: np.ndarray) -> np.ndarray:
        """Shard of bigram keys; hot: whether a key's context is."""
        context = (keys >> np.uint64(32)).astype(np.int64)
        spread = (mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)
        return np.where(hot, spread, self.range_of(np.minimum(context, max(self.words - 1, 0))))

    def is_hot(self, counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return (counts * self.hot_part > self.tokens) | (ids == self.begin)


def _encoded(model: Model, texts: pd.Series) -> tuple[np.ndarray, ...]:
    """Of all tokens of the texts: ids, counts, the contexts' ids and counts, and the number of tokens of each text."""
    each = [token_hashes(t) for t in texts]
    sizes = np.array([len(x) for x in each])
    distinct, place = np.unique(np.concatenate(each), return_inverse=True)
    known, counted = model.look_up(distinct)
    ids, counts = known[place], counted[place]
    first = np.cumsum(sizes) - sizes
    before, before_counts = np.roll(ids, 1), np.roll(counts, 1)
    before[first], before_counts[first] = model.begin, model.texts
    return ids, counts, before, before_counts, sizes


def _discounts(n: np.ndarray) -> list[float]:
    """Discount by count 0, 1, 2 and more, from the numbers of entries counted once to four times."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    out = [0.0]
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k / 2
        out.append(float(min(max(d, 0.05 * k), 0.95 * k)))
    return out


def _how_often(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [int((counts >= 3).sum()), int(counts.sum())]


def train(texts: DataFrame, folder: str | None = None, hot_part: int = HOT) -> Model:
    """Model of a column ``text``; its files go to a new folder below the shared one by default."""
    folder = folder or work_folder(texts.sparkSession, "kneser-ney")
    root = mapped_path(folder)
    os.makedirs(root, exist_ok=True)
    sc = texts.sparkSession.sparkContext
    bits = max(3, int(np.ceil(np.log2(shards(texts, SHARD_INPUT, 8)))))

    def count_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gathered, size = [], 0
        for frame in frames:
            for text in frame["text"]:
                gathered.append(token_hashes(text))
                size += len(gathered[-1])
                if size >= RUN_TOKENS:
                    keys, counts = _count_runs(gathered)
                    yield _deal((keys >> np.uint64(64 - bits)).astype(np.int64), keys, counts)
                    gathered, size = [], 0
        keys, counts = _count_runs(gathered)
        yield _deal((keys >> np.uint64(64 - bits)).astype(np.int64), keys, counts)

    def keep_words(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        keys, counts = _merge(frame["keys"], frame["counts"])
        _save(root, f"words-{shard:05d}", keys)
        _save(root, f"counts-{shard:05d}", np.minimum(counts, 0xFFFFFFFF).astype("<u4"))
        ends = counts[keys == END]
        return pd.DataFrame({"shard": [shard], "words": [len(keys)], "tokens": [int(counts.sum())], "texts": [int(ends.sum())]})

    words = texts.mapInPandas(count_words, _RUN).groupBy("shard").applyInPandas(keep_words, "shard int, words long, tokens long, texts long")
    seen = {r.shard: r for r in store(words, "words").collect()}  # one row per shard
    sizes = [seen[s].words if s in seen else 0 for s in range(1 << bits)]
    model = Model(root, bits, sizes, sum(r.tokens for r in seen.values()), sum(r.texts for r in seen.values()), hot_part)
    shared = sc.broadcast(model)

    def count_bigrams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, gathered, size = shared.value, [], 0

        def deal() -> pd.DataFrame:
            keys, counts = _count_runs([k for k, _ in gathered])
            hot_keys = np.unique(np.concatenate([h for _, h in gathered])) if gathered else np.empty(0, np.uint64)
            return _deal(own.shard_of(keys, np.isin(keys >> np.uint64(32), hot_keys)), keys, counts)

        for frame in frames:
            ids, _, before, before_counts, _ = _encoded(own, frame["text"])
            hot = np.unique(before[own.is_hot(before_counts, before)]).astype(np.uint64)
            gathered.append(((before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64), hot))
            size += len(ids)
            if size >= RUN_TOKENS:
                yield deal()
                gathered, size = [], 0
        yield deal()

    def keep_bigrams(frame: pd.DataFrame) -> pd.DataFrame:
        own, shard = shared.value, int(frame["shard"].iloc[0])
        keys, counts = _merge(frame["keys"], frame["counts"])
        _save(root, f"pairs-{shard:05d}", keys)
        _save(root, f"pair-counts-{shard:05d}", np.minimum(counts, 0xFFFFFFFF).astype("<u4"))
        context, word = (keys >> np.uint64(32)).astype(np.int64), (keys & _LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        table = np.empty(len(first), CONTEXT)
        table["id"] = context[first]
        for name, of in (("once", counts == 1), ("twice", counts == 2), ("more", counts >= 3)):
            table[name] = np.add.reduceat(of.astype(np.int64), first)
        # Contexts outside the shard's range are here because they are hot; so are hot ones inside it.
        total = np.zeros(len(first), np.int64)
        inside = table["id"] < own.words
        where = np.searchsorted(own.bases, table["id"][inside], "right") - 1
        total[inside] = [own.array("counts", s, "<u4")[i - own.bases[s]] for s, i in zip(where.tolist(), table["id"][inside].tolist())] if inside.any() else []
        hot = own.is_hot(total, table["id"].astype(np.int64))
        _save(root, f"contexts-{shard:05d}", table[~hot])
        rows = [("hot", 0, b"", b"", [int(x) for x in t.tolist()]) for t in table[hot]]
        rows.append(("often", 0, b"", b"", _how_often(counts)))
        distinct, contexts = np.unique(word, return_counts=True)
        dealt = _deal(own.range_of(distinct), distinct.astype(np.uint64), contexts)
        rows += [("continuation", s, k, c, []) for s, k, c in dealt.itertuples(index=False)]
        return pd.DataFrame(rows, columns=["kind", "shard", "keys", "counts", "numbers"])

    pairs = store(
        texts.mapInPandas(count_bigrams, _RUN).groupBy("shard").applyInPandas(keep_bigrams, "kind string, shard int, keys binary, counts binary, numbers array<long>"),
        "pairs",
    )

    def keep_continuations(frame: pd.DataFrame) -> pd.DataFrame:
        own, shard = shared.value, int(frame["shard"].iloc[0])
        keys, counts = _merge(frame["keys"], frame["counts"])
        low, high = own.bounds[shard], own.bounds[shard + 1]
        dense = np.zeros(high - low, "<u4")
        dense[keys.astype(np.int64) - low] = counts
        _save(root, f"continuations-{shard:05d}", dense)
        return pd.DataFrame({"numbers": [_how_often(counts)]})

    added = pairs.where("kind = 'continuation'").select("shard", "keys", "counts").groupBy("shard").applyInPandas(keep_continuations, "numbers array<long>")
    low = np.array([r.numbers for r in store(added, "continuations").collect()], np.int64).reshape(-1, 6).sum(axis=0)
    often = np.array([r.numbers for r in pairs.where("kind = 'often'").select("numbers").collect()], np.int64).reshape(-1, 6).sum(axis=0)
    part = lambda k: F.sum(F.get("numbers", F.lit(k))).alias(f"n{k}")
    for r in pairs.where("kind = 'hot'").groupBy(F.get("numbers", F.lit(0)).alias("id")).agg(part(1), part(2), part(3)).collect():
        model.hot[r.id] = (r.n1, r.n2, r.n3)
    model.discounts, model.low_discounts, model.low_total = _discounts(often), _discounts(low), int(low[5])
    d = model.low_discounts
    model.low_left = (d[1] * low[0] + d[2] * low[1] + d[3] * low[4]) / model.low_total if model.low_total else 1.0
    return model


def probabilities(model: Model, ids: np.ndarray, before: np.ndarray, before_counts: np.ndarray) -> np.ndarray:
    """p(token | context) for each pair; id -1 is the unknown word."""
    low = np.full(len(ids), model.low_left / (model.words + 1))
    if not model.words:
        return low
    seen = np.flatnonzero(ids >= 0)
    distinct, place = np.unique(ids[seen], return_inverse=True)
    contexts = np.zeros(len(distinct), np.int64)
    shard = model.range_of(distinct)
    for s in np.unique(shard).tolist():
        own = shard == s
        contexts[own] = model.array("continuations", s, "<u4")[distinct[own] - model.bounds[s]]
    discount = np.array(model.low_discounts)
    low[seen] += (np.maximum(contexts - discount[np.minimum(contexts, 3)], 0) / max(model.low_total, 1))[place]

    out = low.copy()
    there = np.flatnonzero((before >= 0) & (before_counts > 0))
    if not len(there):
        return out
    keys = (before[there].astype(np.uint64) << np.uint64(32)) | np.where(ids[there] >= 0, ids[there], 0).astype(np.uint64)
    hot = model.is_hot(before_counts[there], before[there])
    keys, first, place = np.unique(keys, return_index=True, return_inverse=True)
    hot, unknown = hot[first], None
    counts = np.zeros(len(keys), np.int64)
    left = np.zeros((len(keys), 3), np.int64)
    context = (keys >> np.uint64(32)).astype(np.int64)
    shard = model.shard_of(keys, hot)
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange((1 << model.bits) + 1))
    for s in range(1 << model.bits):
        own = order[cuts[s] : cuts[s + 1]]
        known = model.array("pairs", s, "<u8")
        if len(own) and len(known):
            at = np.minimum(np.searchsorted(known, keys[own]), len(known) - 1)
            counts[own] = np.where(known[at] == keys[own], model.array("pair-counts", s, "<u4")[at], 0)
        own = own[~hot[own]]
        table = model.array("contexts", s, CONTEXT)
        if len(own) and len(table):
            at = np.minimum(np.searchsorted(table["id"], context[own].astype(np.uint32)), len(table) - 1)
            row = np.asarray(table[at])
            left[own] = np.stack([row["once"], row["twice"], row["more"]], axis=1) * (row["id"] == context[own])[:, None]
    if hot.any():
        names, at = np.unique(context[hot], return_inverse=True)
        left[hot] = np.array([model.hot.get(int(n), (0, 0, 0)) for n in names], np.int64).reshape(-1, 3)[at]
    unknown = ids[there] < 0
    discount = np.array(model.discounts)
    counts = np.where(unknown, 0, counts[place])
    total = before_counts[there]
    direct = np.maximum(counts - discount[np.minimum(counts, 3)], 0) / total
    out[there] = direct + (left[place] @ discount[1:]) / total * low[there]
    return out


def score(docs: DataFrame, hot_part: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document; the rest trains."""
    texts = docs.select("doc_id", whole_text().alias("text"))
    model = train(texts.where(~in_fold("doc_id", FOLDS, HELD_OUT)).select("text"), hot_part=hot_part)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<n_tokens: long, n_known: long, base_score: double, score: double>")
    def measure(text: pd.Series) -> pd.DataFrame:
        own = shared.value
        if not len(text):
            return pd.DataFrame({"n_tokens": [], "n_known": [], "base_score": [], "score": []})
        ids, counts, before, before_counts, sizes = _encoded(own, text)
        first = np.cumsum(sizes) - sizes
        base = np.log10((counts + 1) / (own.tokens + own.words + 1))
        chance = np.log10(probabilities(own, ids, before, before_counts))
        return pd.DataFrame({
            "n_tokens": sizes, "n_known": np.add.reduceat((counts > 0).astype(np.int64), first),
            "base_score": np.add.reduceat(base, first), "score": np.add.reduceat(chance, first),
        })

    found = texts.select("doc_id", measure("text").alias("found"))
    return found.select(
        "doc_id", in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"), "found.n_tokens", "found.n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "found.base_score", "found.score",
    )
