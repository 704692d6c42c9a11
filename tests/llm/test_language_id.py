"""Languages of one script, told apart by their letters."""

import numpy as np
import pytest

from opsward.llm import language_id

#: Words of equal lengths in both languages of a pair, so that lengths tell nothing.
PAIRS = [
    ("ru", "время жизнь книга город земля слово народ школа", "bg", "време живот който много света сърце човек страх"),
    ("ar", "كتاب سلام طعام شارع صديق جميل", "fa", "خانه دوست گفتن چشمه روزی شهری"),
    ("hi", "कलम नगर महल शहर बहन सफर", "mr", "मदत वजन बदल परत जवळ सहज"),
    ("pl", "źół łąć żęś", "cs", "řůž těš čďň"),
]


@pytest.mark.parametrize("one, own, other, others", PAIRS)
def test_languages_of_one_script(spark, one, own, other, others):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        lang, words = [(one, own), (other, others)][i % 2]
        rows.append((i, " ".join(rng.choice(words.split(), 6)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    lang = {i: name for i, _, name in rows}
    found = language_id.predict_languages(docs).where("held_out").collect()
    assert len(found) > 50 and all(r.lang_pred == lang[r.doc_id] for r in found)


def test_each_letter_has_a_vector_of_its_own():
    letters = "abzßüûÿąłřабвяαβابپאकखगち日本"
    vectors = [language_id.space().bundle(*language_id.trigrams(c)) for c in letters]
    cosines = np.corrcoef(vectors) - np.eye(len(letters))
    assert np.abs(cosines[np.triu_indices(len(letters), 1)]).max() < 0.25


def test_marks_belong_to_the_letter_before():
    assert len(language_id.trigrams("कि")[0]) == 2 and not len(language_id.trigrams("❤️ 1̂")[0])


def test_vectors_do_not_depend_on_what_is_remembered(monkeypatch):
    texts = ["".join(map(chr, range(0x4E00 + i, 0x4E00 + i + 900))) for i in range(0, 9000, 700)]
    whole = [language_id.Space().bundle(*language_id.trigrams(t)) for t in texts]
    monkeypatch.setattr(language_id, "MOST_LETTERS", 1000)
    small = language_id.Space()
    assert all((small.bundle(*language_id.trigrams(t)) == w).all() for t, w in zip(texts, whole))
    grams, counts = language_id.trigrams("aba ab")
    wanted = np.zeros(language_id.WIDTH)
    for gram, n in zip(grams.tolist(), counts.tolist()):
        signs = [1 - 2.0 * language_id.letter_bits(gram >> 21 * k & 0x1FFFFF) for k in (2, 1, 0)]
        wanted += n * np.roll(signs[0], 2) * np.roll(signs[1], 1) * signs[2]
    assert (small.bundle(grams, counts) == wanted).all()
