"""Jaccard groups against all pairs, on real tables and on planted copies."""

import random

import numpy as np
import pytest

from conftest import SF_DIR
from opsward.llm.jaccard_join import drop_near_duplicates, entries, jaccard_components, may_link, near_groups, shape, shingles
from opsward.llm.queries import QUERIES


def brute(rows, size, percent):
    """(doc_id, text) -> rows of (doc_id, n_shingles, component_id), comparing every pair."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in (text or "").translate(lower)).split(" ") if w]
        k = min(size, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            lowest[find(i)] = min(doc, lowest.get(find(i), doc))
    return sorted((((d, len(sets[i]), lowest.get(find(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows)), key=repr)


def planted(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([3, 9, 12, 25, 60, 150]))]
        for _ in range(rng.choice([1, 2, 12])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), " ".join(own)))
    return rows + [(None, None), (len(rows), ""), (len(rows) + 1, " \n"), (len(rows) + 2, "one"), (len(rows) + 3, "ONE"), rows[5], rows[5], (None, rows[7][1])]


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_planted_groups(spark, size, percent):
    rows = planted()
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, key string, n double").repartition(5)
    got = jaccard_components(docs, size, percent).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, size, percent)


def test_op4_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op4_jaccard_join"](spark, SF_DIR).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 3, 90)


@pytest.mark.parametrize("frequent", [0.0, 3.0, 1e9])
@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_sets_share_an_entry(percent, frequent):
    """The prefix argument, on random similar sets under every split into rare and frequent tokens."""
    rng = np.random.default_rng(4)
    sketch = rng.integers(0, 8, 1 << 6)
    for _ in range(400):
        n = int(rng.integers(1, 120))
        x = np.unique(rng.integers(0, 1 << 40, n).astype(np.uint64))
        stay = x[rng.random(len(x)) > rng.choice([0.02, 0.1, 0.2])]
        y = np.unique(np.concatenate([stay, rng.integers(0, 1 << 40, int(rng.integers(0, 1 + len(x) // 5))).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if len(y) and 100 * both >= percent * (len(x) + len(y) - both) and not np.array_equal(x, y):
            assert may_link(len(x), shape(x), len(y), shape(y), percent)
            assert np.intersect1d(entries(x, percent, sketch, frequent), entries(y, percent, sketch, frequent)).size


def test_one_of_each_group_stays(spark):
    rows = planted(8)
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, digest long").repartition(3)
    groups = near_groups(docs, 5, 80).collect()
    left = drop_near_duplicates(docs, 5, 80)
    assert left.columns == docs.columns
    assert left.count() == len({bytes(r.component) for r in groups if r.n_shingles}) + sum(not r.n_shingles for r in groups)
    assert drop_near_duplicates(docs.limit(0)).count() == 0


def test_shingles_of_short_and_odd_texts():
    assert len(shingles("", 3)) == 0 and len(shingles("\x0b \x0c", 3)) == 0
    assert np.array_equal(shingles("A b", 3), shingles("a\tB", 3)) and len(shingles("a b", 3)) == 1
    assert not np.array_equal(shingles("É b", 3), shingles("é b", 3))
    assert len(shingles("a b a b a b", 3)) == 2


def test_shapes_of_large_sets_bound_the_overlap():
    rng = np.random.default_rng(9)
    for n in (900, 1005, 70_000):
        x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        y = np.concatenate([x[: int(n * 0.95)], np.unique(rng.integers(0, 1 << 62, n // 50).astype(np.uint64))])
        assert may_link(len(x), shape(x), len(y), shape(y), 90)
        other = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        assert n > 50_000 or not may_link(len(x), shape(x), len(other), shape(other), 90)


def test_hashed_words_are_the_words_between_white_space():
    from opsward.llm.words import PIECE, hashed_words, words_of

    texts = ["", " \t\n", "a", "A b\x0bB", "É ß z a", "x" * (3 * PIECE) + " end", "one two " * PIECE, " " * (3 * PIECE) + "q"]
    seen: dict[bytes, int] = {}
    for text in texts:
        words, hashes = words_of(text), hashed_words(text).tolist()
        assert len(words) == len(hashes)
        assert all(seen.setdefault(w, h) == h for w, h in zip(words, hashes))
    assert len(set(seen.values())) == len(seen)


def test_long_words_of_a_regular_build_stay_different():
    from opsward.llm.words import hashed_words

    for n in (32, 64, 1024, 4096):
        word = "".join("ab"[i.bit_count() % 2] for i in range(n))
        other = word.translate(str.maketrans("ab", "ba"))
        a, b, c = hashed_words(f"x {word} {other} {word.upper()}").tolist()[1:]
        assert a != b and a == c


def test_rows_without_ids_meet_their_own_class_only(spark, tmp_path):
    """300 texts without an id: each wanted class reads one text, not all of them."""
    from opsward.llm.jaccard_join import _token_sets, set_key
    from pyspark.sql import functions as F

    rows = [(None, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    key = F.udf(lambda t: set_key(shingles(t, 3)), "binary")
    wanted = docs.select(key("text").alias("key"), F.struct("doc_id", F.xxhash64("text").alias("digest")).alias("rep"))
    assert _token_sets(docs, wanted, 3).count() == 300
    texts = [(None, t + tail) for _, t in rows[:30] for tail in ("", " z")]
    got = near_groups(spark.createDataFrame(texts, "doc_id long, text string"), 3, 90)
    assert got.select("component").distinct().count() == 30
