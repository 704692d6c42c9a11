import random

from opsward.llm import jaccard_join


def test_large_groups_of_near_copies_meet_at_their_middle(spark, monkeypatch):
    """Copies that link with their common original, but not with each other, are not compared pair by pair."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = [base]
    for k in range(60):
        own = list(base)
        for i in rng.sample(range(150), 12):
            own[i] = f"x{k}x{i}"
        texts.append(own)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    met, possible = [], jaccard_join._possible

    def counted(pairs, *rest):
        met.append(pairs.count())
        return possible(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "_possible", counted)
    assert {r.component_id for r in jaccard_join.jaccard_components(docs, 1, 80).collect()} == {0}
    assert len(met) == jaccard_join.HUB_ROUNDS + 1 and met[-1] <= len(texts)
