"""Language identification of texts in scripts that no learned language uses."""

import numpy as np
import pytest

from tallyhouse.llm import language, stages

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LEARNED = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate([("hello world how are you", "en"), ("wie geht es dir heute", "de")] * 8)]
UNLEARNED = [(100, "привет мир как дела", None, "s", 1), (101, "привет мир как дела привет мир как дела hello", None, "s", 1),
             (102, "hello world how are you мир", None, "s", 1)]


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(spark.createDataFrame(LEARNED, SCHEMA))


def test_share_counts_all_letters(model):
    wholly, mostly, little = language.label(model, [r[1] for r in UNLEARNED])
    assert wholly[1:] == (0.0, [], [], [])
    assert mostly[0] == "en" and mostly[1] == pytest.approx(5 / 37) and mostly[2:] == ([40], [45], ["en"])
    assert little[0] == "en" and little[1] == pytest.approx(19 / 22) and little[2:] == ([0], [23], ["en"])
    # Letters of no language part the spans, and leave the path of the others as it is.
    text = "hello мир world"
    (_, score, begins, ends, langs), = language.label(model, [text])
    assert ([text[a:b] for a, b in zip(begins, ends, strict=True)], langs) == (["hello", "world"], ["en", "en"])
    assert score == pytest.approx(10 / 13)
    w = language.words_of([text])
    assert (model.word_scores(w)[~model.known(w)] == 0).all() and np.array_equal(model.known(w), [True, False, True])


def test_stage_rejects(spark):
    docs = spark.createDataFrame(LEARNED + UNLEARNED, SCHEMA)
    kept = {r["doc_id"]: r["lang"] for r in stages.keep_languages(spark, docs, "").collect()}
    assert set(kept) == {r[0] for r in LEARNED} | {102} and kept[102] == "en"
