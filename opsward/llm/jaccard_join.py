"""Exact n-gram Jaccard join with token-combination prefixes, and the groups its links form.

A document's tokens are the hashes of its distinct word shingles. Texts with equal token sets form a class;
classes, not copies, are joined. Tokens have one global order, rare before frequent: a fixed-size count
sketch over all documents tells how frequent a token is (it steers speed, never the result).

Prefix. Let t be the similarity and n a set's size; a partner misses at most (1-t)n of its tokens. Rare
tokens are indexed singly: (1-t)n + 1 of them are enough. If a set has fewer (r), its prefix is extended
into the frequent tokens, which are indexed as combinations of two neighbours in the global order. A token
that the partner misses breaks two neighbour pairs and one that only the partner has breaks one; missed
and added tokens together cost at most 2(1-t)n pairs, so 2(1-t)n - 2r + 2 frequent tokens leave an intact
pair. That holds for similarities of at least 0.67; below it frequent tokens are indexed singly as well. Of two linked sets, the one whose prefix ends first therefore shares an entry with the other.

Verification. Entries with two or more classes propose pairs of compatible sizes. A pair whose parities of
token counts per hash bin (``shape``) already rule out the overlap is dropped: a bin of different parity holds a token of one
set only. The rest compare their sets. First each class meets one hub per entry, in HUB_ROUNDS rounds: the class that shares
most with the others, the middle of a large group, and then a changing one; classes that a link already joined need no
further pair. What is left in different components is then compared in full, so no link that matters for
the groups is lost and a large group of near copies doesn't cost all its pairs. Sizes and intersections
are exact, over 64-bit shingle hashes.

Defined cases: null text is empty; a text without words has no shingles, no links and is its own
component; one with fewer words than a shingle has its whole sequence as the only shingle; component ids
ignore null doc_ids while there is another; repeated rows are members like any other; an empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType
from pyspark.sql.window import Window

from ..session import scan_bytes
from .common import UNKNOWN_BYTES, own_columns, own_prefix, store, whole_text
from .words import SPREAD, hashed_words, mix

HUB_ROUNDS = 2
#: Size bound of a broadcast list of classes; longer lists are joined by a shuffle.
BROADCAST_ROWS = 400_000
#: A token counts as frequent when its sketch cell holds more than this many times the mean cell.
FREQUENT = 8
BLOCK = 1 << 16
#: Leading bits of a rare token's place in the global order that hold its count; higher counts tie and the token decides.
COUNT_BITS = 24
COUNT_CAP = (1 << COUNT_BITS) - 1
#: Parity bits of a small and of a large set; the longer ones fold into the shorter ones.
FEW_BITS, MANY_BITS, LARGE_SET = 512, 4096, 1000
#: A class's smallest entries travel with its open postings, so that a pair meets once instead of at every common entry.
SHORT_LIST = 8
#: Entries of more classes than this choose their first hub by what the classes share; in smaller ones every pair is cheap.
LARGE_ENTRY = 16
#: Below this similarity missed and added tokens may break every neighbour pair, so all tokens are indexed singly.
LEAST_PAIRED = 67


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles (ASCII letters lower-cased, words between white space)."""
    h = hashed_words(text)
    if not len(h):
        return h
    size = min(size, len(h))
    total, weight = np.full(len(h) - size + 1, size, np.uint64), 1
    for k in range(size):
        weight = weight * int(SPREAD) % (1 << 64)
        total += h[k : len(h) - size + 1 + k] * np.uint64(weight)
    total = np.sort(mix(total))
    return total[np.append(True, total[1:] != total[:-1])]


def set_key(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def has_partners(n: int, percent: int) -> bool:
    """Whether a set of this size can link with a different set."""
    return n * (100 - percent) >= percent


def entries(tokens: np.ndarray, percent: int, sketch: np.ndarray, frequent: float) -> np.ndarray:
    """Index entries of a token set: single rare tokens and neighbour pairs of frequent ones."""
    n = len(tokens)
    if not has_partners(n, percent):
        return np.empty(0, np.int64)
    count = sketch[(tokens & np.uint64(len(sketch) - 1)).astype(np.int64)]
    is_rare = count <= frequent
    rare = int(is_rare.sum())
    need = n - (percent * n + 99) // 100 + 1
    if rare >= need or percent < LEAST_PAIRED:
        # The order's leading bits are enough: tokens that tie with the last one are indexed too.
        place = (np.minimum(count, COUNT_CAP).astype(np.uint64) << np.uint64(64 - COUNT_BITS)) | (tokens >> np.uint64(COUNT_BITS))
        return mix(tokens[place <= np.partition(place, need - 1)[need - 1]]).view(np.int64)
    extent = max(2, 2 * (100 - percent) * n // 100 - 2 * rare + 2)
    common = tokens[~is_rare]
    common = common[np.argsort(count[~is_rare], kind="stable")[:extent]]
    pairs = mix(common[:-1] * SPREAD + common[1:])
    return np.concatenate([mix(tokens[is_rare]), pairs]).view(np.int64)


def shape(tokens: np.ndarray) -> bytes:
    """Parity of the number of tokens in each of FEW_BITS or, for large sets, MANY_BITS hash bins, eight bins a byte."""
    bins = FEW_BITS if len(tokens) <= LARGE_SET else MANY_BITS
    counts = np.bincount((tokens >> np.uint64(40)).astype(np.int64) % bins, minlength=bins)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _folded(packed: bytes) -> np.ndarray:
    """FEW_BITS parities as 64-bit integers."""
    return np.bitwise_xor.reduce(np.frombuffer(packed, "<i8").reshape(-1, FEW_BITS // 64), axis=0)


def may_link(n: int, a: bytes, m: int, b: bytes, percent: int) -> bool:
    """False only if the parities prove that two sets of n and m tokens overlap too little.

    A bin whose parities differ holds a token that only one set has.
    """
    x, y = (np.frombuffer(z, np.uint8) for z in (a, b)) if len(a) == len(b) else (_folded(z).view(np.uint8) for z in (a, b))
    apart = int(np.bitwise_count(x ^ y).sum())
    return (100 + percent) * apart <= (100 - percent) * (n + m)


def _sketch_size(docs: DataFrame) -> int:
    known = scan_bytes(docs)
    bits = 20 if known >= UNKNOWN_BYTES else int(np.ceil(np.log2(max(known, 1) / 128)))
    return 1 << min(max(bits, 16), 24)


def token_sketch(texts: DataFrame, size: int, cells: int) -> np.ndarray:
    """How many documents hold a token of each cell, over all documents; added up block by block."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(cells, np.uint32)
        for frame in frames:
            for text in frame["text"]:
                np.add.at(total, (shingles(text, size) & np.uint64(cells - 1)).astype(np.int64), 1)
        parts = [(b, total[b * BLOCK : (b + 1) * BLOCK]) for b in range(cells // BLOCK)]
        yield pd.DataFrame([(b, zlib.compress(p.tobytes(), 1)) for b, p in parts if p.any()], columns=["block", "counts"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(BLOCK, np.uint64)
        for x in frame["counts"]:
            total += np.frombuffer(zlib.decompress(x), np.uint32)
        total = np.minimum(total, 0xFFFFFFFF).astype(np.uint32)
        return pd.DataFrame({"block": [int(frame["block"].iloc[0])], "counts": [zlib.compress(total.tobytes(), 1)]})

    schema = "block int, counts binary"
    rows = store(texts.mapInPandas(count, schema).groupBy("block").applyInPandas(add, schema), "sketch").collect()
    sketch = np.zeros(cells, np.uint32)
    for r in rows:
        sketch[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(zlib.decompress(bytes(r.counts)), np.uint32)
    return sketch


def members_of(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Stored: doc_id, text digest, class key, set size and index entries of every document."""
    texts = docs.select("doc_id", whole_text().alias("text"))
    sketch = token_sketch(texts.select("text"), size, _sketch_size(docs))
    frequent = FREQUENT * max(1.0, float(sketch.mean()))
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    @F.pandas_udf("struct<key: binary, n: long, entries: array<long>, shape: binary>")
    def describe(text: pd.Series) -> pd.DataFrame:
        rows = []
        for one in text:
            tokens = shingles(one, size)
            index = entries(tokens, percent, shared.value, frequent)
            form = shape(tokens) if len(index) else b""
            rows.append((set_key(tokens), len(tokens), np.unique(index), form))
        return pd.DataFrame(rows, columns=["key", "n", "entries", "shape"])

    described = texts.select("doc_id", F.xxhash64("text").alias("digest"), describe("text").alias("set"))
    return store(described.select("doc_id", "digest", "set.*"), "members")


def _token_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Stored: key and token set of the wanted classes, read from one member document each.

    A member is found by id and text digest: rows without an id, or with a repeated one, don't meet each other's classes.
    """
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("digest", F.xxhash64("text"))
    same = texts["doc_id"].eqNullSafe(wanted["rep.doc_id"]) & (texts["digest"] == wanted["rep.digest"])
    met = texts.join(F.broadcast(wanted) if few else wanted, same)

    def tokens(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingles(t, size) for t in frame["text"]]
            rows = [(k, x.tobytes()) for k, x in zip(frame["key"], sets) if set_key(x) == bytes(k)]
            yield pd.DataFrame(rows, columns=["key", "tokens"])

    found = met.select("key", "text").mapInPandas(tokens, "key binary, tokens binary")
    return store(found.groupBy("key").agg(F.first("tokens").alias("tokens")), "token-sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    left = sets.select(F.col("key").alias("a"), F.col("tokens").alias("a_tokens"))
    right = sets.select(F.col("key").alias("b"), F.col("tokens").alias("b_tokens"))
    met = pairs.join(left, "a").join(right, "b")
    return store(met.where(linked("a_tokens", "b_tokens")).select("a", "b"), "links")


def components(links: DataFrame) -> DataFrame:
    """key -> smallest key of its component, by alternating large and small stars until nothing changes."""
    edges = store(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        before = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v")
        edges = store(small.unionByName(least.select("u", F.col("low").alias("v"))).distinct(), "edges")
        if edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() == before:
            return edges.select(F.col("u").alias("key"), F.col("v").alias("component"))


def _labelled(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return postings.withColumn("component", F.col("key"))
    met = postings.join(labels, "key", "left")
    return met.withColumn("component", F.coalesce("component", "key"))


def _supported(postings: DataFrame, support: DataFrame) -> DataFrame:
    """Postings with the support of the classes in large entries."""
    large = F.col("classes") > LARGE_ENTRY
    met = postings.where(large).join(support, "key").select("entry", "key", "n", "support")
    return met.unionByName(postings.where(~large).select("entry", "key", "n", F.lit(0).cast("long").alias("support")))


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that sizes and shapes leave possible, with the document that represents each class."""

    @F.pandas_udf("boolean")
    def possible(n: pd.Series, a: pd.Series, m: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([may_link(*x, percent) for x in zip(n, a, m, b)], dtype=bool)

    side = lambda x, n: classes.select(F.col("key").alias(x), F.col("rep").alias(f"rep_{x}"), F.col("n").alias(n), F.col("shape").alias(f"shape_{x}"))
    met = pairs.join(side("a", "n"), "a").join(side("b", "m"), "b")
    return store(met.where(possible("n", "shape_a", "m", "shape_b")).select("a", "b", "rep_a", "rep_b"), "possible")


@F.pandas_udf(ArrayType(LongType()))
def _few_bits(packed: pd.Series) -> pd.Series:
    """FEW_BITS parities of every set."""
    return packed.map(_folded)


def class_links(docs: DataFrame, members: DataFrame, size: int, percent: int) -> DataFrame:
    """key -> component of every class that links with another."""
    indexed = members.where(F.size("entries") > 0).groupBy("key").agg(
        F.min(F.struct("doc_id", "digest")).alias("rep"), F.first("n").alias("n"), F.first("entries").alias("entries"), F.first("shape").alias("shape")
    )
    indexed = store(indexed, "classes")
    classes = indexed.select("key", "rep", "n", "shape")
    exploded = indexed.select("key", "n", F.explode("entries").alias("entry"))
    shared = exploded.withColumn("classes", F.count("*").over(Window.partitionBy("entry"))).where("classes > 1")
    postings = store(shared.select("entry", "key", "n", "classes"), "postings")
    # The class that shares most is nearest to the middle of a large group, and most of the group links with it.
    support = store(postings.where(F.col("classes") > LARGE_ENTRY).groupBy("key").agg(F.sum("classes").alias("support")), "support")
    fits = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    ordered = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = labels = None
    for hub_round in range(HUB_ROUNDS + 1):
        own = _labelled(postings.drop("classes") if hub_round else _supported(postings, support), labels)
        if hub_round < HUB_ROUNDS:
            chosen = F.lit(0).cast("long") if hub_round else -F.coalesce("support", F.lit(0))
            rank = F.struct(chosen.alias("chosen"), F.xxhash64("key", F.lit(hub_round)).alias("rank"), F.col("key").alias("hub"), F.col("n").alias("m"), F.col("component").alias("hub_component"))
            met = own.withColumn("h", F.min(rank).over(Window.partitionBy("entry")))
            met = met.select(F.col("key").alias("a"), "n", "component", F.col("h.hub").alias("b"), F.col("h.m").alias("m"), F.col("h.hub_component").alias("other"))
        else:
            # Only entries that still hold several components are compared in full.
            open_ = own.groupBy("entry").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("entry")
            # A pair meets at its first common entry, and only if the parities leave it possible. Entries are sorted: if the
            # smallest ones have a common one, that is the first; pairs without one there meet at every common entry.
            listed = F.slice("entries", 1, SHORT_LIST).alias("listed")
            left = store(own.join(open_, "entry", "left_semi").join(indexed.select("key", _few_bits("shape").alias("bits"), listed), "key"), "open")
            right = left.select(
                "entry", F.col("key").alias("b"), F.col("n").alias("m"), F.col("component").alias("other"),
                F.col("bits").alias("other_bits"), F.col("listed").alias("other_listed"),
            )
            left = left.withColumnRenamed("key", "a")
            differ = (F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("other_bits")[i])) for i in range(FEW_BITS // 64))
            apart = reduce(add, differ).cast("long")
            first = F.array_min(F.array_intersect("listed", "other_listed"))
            met = left.join(
                right,
                (left["entry"] == right["entry"]) & (F.col("a") < F.col("b")) & (F.col("component") != F.col("other")) & fits
                & (apart * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent)) & F.coalesce(first == left["entry"], F.lit(True)),
            )
        pairs = met.where((F.col("component") != F.col("other")) & fits).select(*ordered).distinct()
        possible = _possible(pairs, classes, percent)
        ends = possible.select(F.col("a").alias("key"), F.col("rep_a").alias("rep")).unionByName(possible.select(F.col("b").alias("key"), F.col("rep_b").alias("rep")))
        sets = _token_sets(docs, store(ends.distinct(), "wanted"), size)
        found = _verified(possible.select("a", "b"), sets, percent)
        links = found if links is None else links.unionByName(found)
        labels = components(links)
    return labels


def near_groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text digest, number of shingles and component (smallest doc_id of the linked documents) of every row."""
    members = members_of(docs, size, percent)
    labels = class_links(docs, members, size, percent)
    reps = members.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"))
    joined = reps.join(labels, "key", "left").withColumn("component", F.coalesce("component", "key"))
    lowest = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = joined.join(lowest, "component").select("key", "component_id", "component")
    return members.drop("entries", "shape").join(of_class, "key", "left").select(
        "doc_id", "digest", F.col("n").alias("n_shingles"), "component",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group with all its columns, whatever their names: the smallest (doc_id, text digest).

    Texts without words all stay; of rows equal in doc_id and text that lead a group one stays; an empty table gives an
    empty result.
    """
    p = own_prefix(docs)
    rows = store(near_groups(docs, size, percent), "groups")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    first = rows.where("n_shingles > 0").groupBy("component").agg(F.min(place).alias("first"), F.count("*").alias("rows")).where("rows > 1")
    judged = store(rows.join(first, "component").select("doc_id", "digest", (F.col("first") == place).alias("stays")), "judged")
    gone = judged.where("NOT stays").select(F.col("doc_id").alias(f"{p}id"), F.col("digest").alias(f"{p}digest")).distinct()
    keyed = docs.withColumn(f"{p}digest_of", F.xxhash64(whole_text()))
    same = F.col("doc_id").eqNullSafe(F.col(f"{p}id")) & (F.col(f"{p}digest_of") == F.col(f"{p}digest"))
    left = keyed.join(gone, same, "left_anti")
    # Equal rows are told apart by nothing: of those that lead a group one stays.
    equal = judged.where("stays").groupBy(F.col("doc_id").alias(f"{p}id"), F.col("digest").alias(f"{p}digest")).count().where("count > 1")
    equal = store(equal, "equal")
    if equal.limit(1).count():
        single = left.join(equal, same, "left_anti")
        left = single.unionByName(left.join(equal, same, "left_semi").dropDuplicates(["doc_id", f"{p}digest_of"]))
    return left.select(*own_columns(docs))


def jaccard_components(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    return near_groups(docs, size, percent).select("doc_id", "n_shingles", "component_id")
