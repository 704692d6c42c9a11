"""Periodic runs against brute force over all periods, and the digests of the query."""

import random
from hashlib import sha256
from zlib import crc32

from opsward.llm import periodic_runs
from opsward.llm.periodic_runs import collapsed, find_runs, planted
from opsward.llm.queries import QUERIES


def brute_force(words, least=12):
    """Every period by itself: stretches in which words at that distance agree."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((start, length, q) for (start, length), q in found.items())


def test_equals_brute_force():
    r = random.Random(5)
    for _ in range(250):
        docs = []
        for _ in range(r.randint(0, 6)):
            words = [b"%d" % r.randrange(r.choice([1, 2, 3, 50])) for _ in range(r.randint(0, 100))]
            for _ in range(r.randint(0, 3)):
                if words:
                    a, p = r.randrange(len(words)), r.randint(1, 20)
                    words[a:a] = words[a : a + p] * r.randint(1, 5)
            docs.append(words)
        least = r.choice([12, 12, 2, 3, 7, 1])
        assert find_runs(docs, least) == [brute_force(w, least) for w in docs]


def test_long_texts_stay_whole():
    assert find_runs([[b"a"] * 50_000, [b"a", b"b"] * 20_000 + [b"c"]]) == [[(0, 50_000, 1)], [(0, 40_000, 2)]]
    short, fibonacci = [b"a"], [b"a", b"b"]
    while len(fibonacci) < 2000:
        short, fibonacci = fibonacci, fibonacci + short
    assert find_runs([fibonacci]) == [brute_force(fibonacci)]
    spread = [w for i in range(3000) for w in (b"x%d" % i, *(b"w%d" % k for k in range(8)))]
    assert find_runs([spread]) == [[]]


def test_words_that_many_runs_hold_go_once():
    words = [b"a"] * 14 + [b"b"] + [b"a"] * 14 + [b"b"]
    runs = find_runs([words])[0]
    assert runs == [(0, 14, 1), (0, 30, 15), (15, 14, 1)]
    assert collapsed(words, runs) == "a b"


def expected(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    h = crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:  # said anew
        original, g, n = (text or "").encode().split(), h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        assert words == [original[i] if i < a else original[a + (i - a) % p] for i in range(n)]
    runs = brute_force(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, exponent, sha256(listed.encode()).hexdigest(), sha256(kept).hexdigest())


def test_query_over_the_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op12_periodic_runs"](spark, "/root/testdata/sf0.001").collect())
    assert got == sorted(expected(*d) for d in docs)
    assert sum(r[1] for r in got) > 0


def test_odd_rows(spark):
    again = "go on " * 9
    rows = [(1, None, "x"), (2, "", "x"), (None, again, "x"), (3, again, None), (3, again, None), (4, "a b \x1c " * 9, "y"), (5, "  \t\n", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(2)
    found = periodic_runs.digests(periodic_runs.periodic_runs(docs, prepare=planted))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted((expected(i, t) for i, t, _ in rows), key=repr)
    assert periodic_runs.digests(periodic_runs.periodic_runs(docs.limit(0))).count() == 0
