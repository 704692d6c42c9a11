"""Benchmark decontamination with a generalised suffix automaton of normalised test items.

The items' words form one automaton per block; a block holds at most about BLOCK_WORDS words, so what is
collected and broadcast is bounded whatever the benchmark's size, and further blocks run over the
documents in the same pass. Document words stream through the automaton, which keeps the longest suffix
that occurs in an item. A match of WINDOW words or more, or of a whole shorter item, hits its words.

Defined cases: null text has no words; a null or wordless item matches nothing; an item with a null id
hits words but is not listed; repeated items and repeated ids are listed once; an empty benchmark leaves
every document clean; rows that repeat are judged each for itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, own_columns, own_prefix, whole_text

WINDOW = 10
BLOCK_WORDS = 200_000
#: Documents above this share of hit words go; below it the hit spans are cut out (``remove_spans``).
MOST_COVERAGE = 0.2
#: Fixed value: the contract's word class, over UTF-8 bytes.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_FOUND = "struct<n_words: long, spans: array<struct<first: int, stop: int>>, items: array<string>>"


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


class SuffixAutomaton:
    """All substrings of a set of word sequences, with the items of each window."""

    def __init__(self, items: Iterable[tuple[str | None, str]], window: int = WINDOW):
        self.window, self.ids = window, {}
        self.go, self.link, self.length = [{}], [-1], [0]
        sequences = []
        for name, text in items:
            words = [self.ids.setdefault(w, len(self.ids)) for w in words_of(text or "")]
            if words:
                sequences.append((name, words))
                last = 0
                for w in words:
                    last = self._extend(last, w)
        self.windows: dict[int, set] = {}
        self.wholes: dict[int, tuple[int, set]] = {}
        for name, words in sequences:
            state, n = 0, 0
            for w in words:
                state, n = self.step(state, n, w)
                if n >= window:
                    self.windows.setdefault(self._holding(state, window), set()).add(name)
            if len(words) < window:
                at = self._holding(state, len(words))
                self.wholes.setdefault(at, (len(words), set()))[1].add(name)
        # States whose match can count: long ones, and those with a whole short item among their suffixes.
        self.short = [None] * len(self.go)
        if self.wholes:
            for state in sorted(range(len(self.go)), key=self.length.__getitem__):
                above = self.short[self.link[state]] if state else None
                own = self.wholes.get(state)
                self.short[state] = [*(above or ()), own] if own else above
        self.window_state = [self._holding(s, window) if self.length[s] >= window else -1 for s in range(len(self.go))]

    def _holding(self, state: int, n: int) -> int:
        """The suffix state that holds the last n words of a state."""
        while state and self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def _new(self, go: dict, link: int, length: int) -> int:
        self.go.append(go)
        self.link.append(link)
        self.length.append(length)
        return len(self.go) - 1

    def _split(self, parent: int, word: int) -> int:
        """The state after parent by word, made to hold exactly parent's longest string and the word."""
        at = self.go[parent][word]
        if self.length[at] == self.length[parent] + 1:
            return at
        copy = self._new(dict(self.go[at]), self.link[at], self.length[parent] + 1)
        self.link[at] = copy
        while parent >= 0 and self.go[parent].get(word) == at:
            self.go[parent][word] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.go[last]:
            return self._split(last, word)
        new, parent = self._new({}, 0, self.length[last] + 1), last
        while parent >= 0 and word not in self.go[parent]:
            self.go[parent][word] = new
            parent = self.link[parent]
        if parent >= 0:
            self.link[new] = self._split(parent, word)
        return new

    def step(self, state: int, n: int, word: int) -> tuple[int, int]:
        go = self.go
        while True:
            after = go[state].get(word)
            if after is not None:
                return after, n + 1
            if not state:
                return 0, 0
            state = self.link[state]
            n = self.length[state]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit spans as (first, stop), merged, and the names of the items that hit."""
        spans, names = [], set()
        state = n = 0
        go, short, window = self.go, self.short, self.window
        for i, word in enumerate(map(self.ids.get, words)):
            if word is None:
                state = n = 0
                continue
            after = go[state].get(word)
            if after is None:
                state, n = self.step(state, n, word)
            else:
                state, n = after, n + 1
            hit = 0
            if n >= window:
                hit = n
                names |= self.windows.get(self.window_state[state], ())
            if short[state]:
                for size, own in short[state]:
                    if size <= n:
                        hit = max(hit, size)
                        names |= own
            if hit:
                first = i + 1 - hit
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append((first, i + 1))
        return spans, names


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, stop in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((first, stop))
    return out


def _blocks(items: DataFrame, block_words: int) -> tuple[DataFrame, int]:
    """Distinct items dealt into blocks by their text."""
    size = F.size(F.split(lower_ascii(whole_text()), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    own = items.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct().withColumn("size", size)
    total = own.agg(F.sum("size")).first()[0] or 0
    n = max(1, -(-total // block_words))
    return own.withColumn("block", F.pmod(F.xxhash64(whole_text()), F.lit(n))), n


def _scanner(automaton, first: bool):
    @F.pandas_udf(_FOUND)
    def scan(text: pd.Series, so_far: pd.DataFrame) -> pd.DataFrame:
        rows = []
        sam = automaton.value
        for i, one in enumerate(text):
            words = words_of(one)
            spans, names = sam.scan(words)
            names.discard(None)
            if not first:
                old = so_far.iloc[i]
                spans = merged([*spans, *((s["first"], s["stop"]) for s in old["spans"])])
                names |= set(old["items"])
            rows.append((len(words), [{"first": a, "stop": b} for a, b in spans], sorted(names)))
        return pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return scan


def with_matches(docs: DataFrame, items: DataFrame, name: str, block_words: int = BLOCK_WORDS, window: int = WINDOW) -> DataFrame:
    """docs with a struct column: number of words, hit word spans and the ids of the items that hit."""
    own, n = _blocks(items, block_words)
    found: Column = F.from_json(F.lit('{"n_words":0,"spans":[],"items":[]}'), _FOUND)
    out = docs.withColumn(name, found)
    for block in range(n):
        part = own.where(F.col("block") == block).select("item_id", "text").toLocalIterator()
        automaton = docs.sparkSession.sparkContext.broadcast(SuffixAutomaton(((r.item_id, r.text) for r in part), window))
        out = out.withColumn(name, _scanner(automaton, block == 0)(whole_text(), F.col(name)))
    return out


def _hit(found: str) -> Column:
    return F.aggregate(F.col(f"{found}.spans"), F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["first"])


def contamination(docs: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every document."""
    found = with_matches(docs.select("doc_id", "text"), items, "found", block_words)
    listed = F.array_sort(F.array_distinct("found.items"))
    return found.select(
        "doc_id", "found.n_words", _hit("found").alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (_hit("found") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any hit word, with all their columns, whatever their names.

    Null and empty texts have no words and stay; rows that repeat stay or go together; an empty table gives an empty result.
    """
    name = f"{own_prefix(docs)}found"
    return with_matches(docs, items, name).where(_hit(name) == 0).select(*own_columns(docs))


def remove_spans(docs: DataFrame, items: DataFrame, most_coverage: float = MOST_COVERAGE) -> DataFrame:
    """Documents without their hit spans; those with more than most_coverage of their words hit go altogether."""

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for one, own in zip(text, spans):
            raw, kept, at = one.encode(), [], 0
            places = [m.span() for m in _WORD.finditer(raw.lower())] if len(own) else []
            for span in own:
                kept.append(raw[at : places[span["first"]][0]])
                at = places[span["stop"] - 1][1]
            out.append(b"".join([*kept, raw[at:]]).decode())
        return pd.Series(out, dtype=object)

    name = f"{own_prefix(docs)}found"
    found = with_matches(docs, items, name)
    few = found.where(_hit(name) <= most_coverage * F.col(f"{name}.n_words"))
    text = F.when(F.size(f"{name}.spans") > 0, cut(whole_text(), F.col(f"{name}.spans"))).otherwise(F.col("text"))
    return few.withColumn("text", text).select(*own_columns(docs))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
items AS (SELECT item_id, w, least(len(w), {WINDOW}) AS size, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS s FROM items),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT r, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size),
hits AS (SELECT r, i, p.size, item_id FROM (SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS s FROM places) p JOIN windows USING (size, s)),
hit AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + size)) AS place FROM hits) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(named.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
