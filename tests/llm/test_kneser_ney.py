"""The stored model against direct counting in dictionaries."""

import math
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from conftest import SF_DIR
from opsward.llm.kneser_ney import END, probabilities, score, train
from opsward.llm.queries import QUERIES
from opsward.llm.words import word_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    text = (text or "").translate(LOWER)
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [*(w for w in text.split(" ") if w), "</s>"]


def by_hand(rows):
    """The same model from dictionaries: rows of (doc_id, held_out, n_tokens, n_known, N, base, score)."""
    held = {d: d is not None and crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    count, pair = Counter(), Counter()
    for d, text in rows:
        if not held[d]:
            own = tokens(text)
            count.update(own)
            pair.update(zip(["<s>", *own], own))
    n, v = sum(count.values()), len(count)
    context = Counter()
    followers, left = defaultdict(Counter), Counter()
    for (a, b), c in pair.items():
        context[a] += c
        followers[a][min(c, 3)] += 1
        left[b] += 1

    def discounts(counts):
        often = [sum(1 for c in counts if c == k) for k in (1, 2, 3, 4)]
        y = often[0] / (often[0] + 2 * often[1]) if often[0] else 0.5
        out = [0.0]
        for k in (1, 2, 3):
            d = k - (k + 1) * y * often[k] / often[k - 1] if often[k - 1] else k / 2
            out.append(min(max(d, 0.05 * k), 0.95 * k))
        return out

    high, low = discounts(pair.values()), discounts(left.values())
    total = sum(left.values())
    rest = sum(low[min(c, 3)] for c in left.values()) / total if total else 1.0

    def p(a, b):
        one = max(left[b] - low[min(left[b], 3)], 0) / max(total, 1) + rest / (v + 1)
        if not context[a]:
            return one
        c = pair[a, b]
        return max(c - high[min(c, 3)], 0) / context[a] + sum(high[k] * m for k, m in followers[a].items()) / context[a] * one

    out = []
    for d, text in rows:
        own = tokens(text)
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)
        out.append((d, held[d], len(own), sum(count[w] > 0 for w in own), n, base, sum(math.log10(p(a, b)) for a, b in zip(["<s>", *own], own))))
    return out


def agree(got, wanted):
    assert len(got) == len(wanted)
    for a, b in zip(sorted(map(tuple, got), key=repr), sorted(wanted, key=repr)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-9)


ROWS = [(i, t) for i, t in enumerate(["a b a b c", "A b  c\td", "", None, "a a a a a a", "b c d\ne", "a b x", "é É e", "a b a b c"] * 4)] + [(None, "a q")]


@pytest.mark.parametrize("hot", [1, 20, 1000])
def test_model_equals_direct_counts(spark, hot):
    """Whether no, some or every context is spread over the shards as a hot one."""
    docs = spark.createDataFrame([(*r, 0) for r in ROWS], "doc_id long, text string, shard int").repartition(3)
    agree(score(docs, hot).collect(), by_hand(ROWS))


def test_op7_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op7_kneser_ney"](spark, SF_DIR).collect()
    agree(got, by_hand(rows))
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_probabilities_of_all_words_add_up_to_one(spark):
    docs = spark.createDataFrame([(t or "",) for _, t in ROWS], "text string")
    model = train(docs)
    words = np.unique(np.append(word_hashes([b"a", b"b", b"c", b"d", b"e", b"x", b"q", "é".encode(), "É".encode()]), END))
    ids, counts = model.look_up(words)
    assert (ids >= 0).all() and len(ids) == model.words
    every = np.append(ids, -1)
    for one, n in [*zip(ids, counts), (model.begin, model.texts), (-1, 0)]:
        p = probabilities(model, every, np.full(len(every), one), np.full(len(every), n))
        if one != ids[words == END][0]:  # nothing follows the end
            assert p.sum() == pytest.approx(1.0)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(3, "a b")], "doc_id long, text string")
    held = next(i for i in range(100) if crc32(str(i).encode()) % 7 == 2)
    got = score(docs.selectExpr(f"cast({held} as long) doc_id", "text")).first()
    assert (got.held_out, got.n_tokens, got.n_known, got.train_tokens, got.base_score, got.score) == (True, 3, 0, 0, 0.0, 0.0)
    assert score(docs.limit(0)).count() == 0
