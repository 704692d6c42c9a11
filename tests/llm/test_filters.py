"""Deduplication, decontamination and classifiers on odd rows, and SQL twins on whole tables."""

import pytest
from compare import connect, differences, duck_rows, spark_rows
from conftest import SF_DIR
from opsward.llm import decontamination, exact_dedup, language_id, line_chunks, quality, toxicity
from opsward.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, key string, label int"
ROWS = [
    (1, "a b\tc", "en", "x", 0), (2, "a b  c ", "en", None, 0), (3, None, None, "x", 1), (4, "", "de", "x", 0), (None, "abc", "en", "x", 1),
    (1, "a b\tc", "en", "x", 0), (6, "z " * 30_000, "en", "x", 0), (7, "Q one two three four five six seven eight nine TEN ten w", "en", "x", 0),
    (8, "only short item here", "fr", "x", 0), (9, "12 !!", None, "x", 0),
]


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, name):
    assert differences(spark_rows(QUERIES[name](spark, SF_DIR)), duck_rows(connect(SF_DIR), ORACLES[name])) is None


def test_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = exact_dedup.exact_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got if r.group_size == 4), key=repr) == [(1, 2, 4), (1, 2, 4), (2, 2, 4), (None, 2, 4)]
    assert sum(r.kept for r in got) == 6 and len(got) == len(ROWS)
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns and left.count() == 6
    twins = spark.createDataFrame([ROWS[0], ROWS[0]], SCHEMA)
    assert exact_dedup.drop_exact_duplicates(twins).count() == 1
    assert line_chunks.dedupe_lines(docs).count() == len(ROWS)


@pytest.mark.parametrize("block_words", [200_000, 4])
def test_windows_and_short_items(spark, block_words):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    items = spark.createDataFrame(
        [(10, "one two three four five six seven eight nine ten eleven"), (11, "Short, item!"), (12, None), (12, "..."), (None, "here"), (13, "short item")],
        "item_id long, text string",
    )
    got = {r.doc_id: r for r in decontamination.contamination(docs, items, block_words).collect() if r.doc_id in (7, 8, 9)}
    assert (got[7].n_words, got[7].n_hit, got[7].n_items) == (13, 10, 1)
    assert (got[8].n_hit, got[8].n_items) == (3, 2) and not got[9].contaminated
    assert decontamination.drop_contaminated(docs, items).count() == len(ROWS) - 2
    cut = {r.doc_id: r.text for r in decontamination.remove_spans(docs, items, 0.8).collect()}
    assert cut[8] == "only " and cut[7] == "Q  ten w"
    assert not decontamination.contamination(docs, items.limit(0)).where("contaminated").count()


def test_classifiers_take_odd_and_empty_tables(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(1, 9)] + [(1, None, None)], "doc_id long, quality int, toxic int")
    for run in (toxicity.toxicity, quality.quality):
        for own in (labels, labels.limit(0)):
            got = run(docs, own).collect()
            assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
        assert run(docs.limit(0), labels).count() == 0
    found = {r.doc_id: r.lang_pred for r in language_id.predict_languages(docs).collect()}
    assert found[3] == found[4] == found[9] == "und" and found[6] != "und"
    assert language_id.predict_languages(docs.limit(0)).count() == 0


def test_folding_meets_look_alikes():
    lexicon = toxicity.Lexicon({" stupid ": 5.0, " lowei": 4.0}, {"loweisure"}, [-1.0, 1.0, 1.0, 0.0])
    words = toxicity.folded_words("5tup1d, ѕtuріd! loweix loweisure")
    assert [w for w, _ in lexicon.matches(words)] == ["stupid", "stupid", "loweix"]
