"""Language identification: Viterbi against brute force, the shortcut against Viterbi, accuracy, odd texts."""

import itertools

import numpy as np
import pytest

from tallyhouse.llm import language
from tallyhouse.llm.tables import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def total(scores, path, penalty):
    return sum(scores[i, p] for i, p in enumerate(path)) - penalty * sum(a != b for a, b in itertools.pairwise(path))


def test_viterbi_is_best():
    rng = np.random.default_rng(1)
    for n in range(1, 7):
        for _ in range(20):
            scores = rng.normal(0, 3, (n, 3))
            best = max(total(scores, p, 2.5) for p in itertools.product(range(3), repeat=n))
            assert total(scores, language.viterbi(scores, 2.5), 2.5) == pytest.approx(best)


def test_shortcut_agrees():
    rng = np.random.default_rng(2)
    sure_ones = 0
    for _ in range(200):
        lengths = rng.integers(1, 30, 5)
        scores = rng.normal(0, 1, (lengths.sum(), 4)) + np.repeat(rng.normal(0, 2, (5, 4)), lengths, axis=0)
        starts = np.cumsum(lengths) - lengths
        best, sure = language.one_language(scores, starts, 6.0)
        for b, s, a, n in zip(best, sure, starts, lengths, strict=True):
            if s:
                sure_ones += 1
                part = scores[a:a + n]
                constant = np.full(n, b)
                assert total(part, constant, 6.0) == pytest.approx(total(part, language.viterbi(part, 6.0), 6.0))
    assert sure_ones > 100


@pytest.fixture(scope="module")
def model(spark):
    return language.learned(table(spark, "/root/testdata/sf0.01", "documents"))


def test_accuracy(spark, model):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = language.query(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count()
    held = got[got.held_out]
    assert len(held) > 150 and (held.lang == held.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_mixed_text_has_spans(spark, model):
    parts = {"en": "the and of that with this for are from ", "de": "die der und nicht einen keit heit schen "}
    text = parts["en"] * 6 + parts["de"] * 3
    (pred, score, begin, end, langs), = language.label(model, [text])
    assert (pred, langs) == ("en", ["en", "de"]) and 0.5 < score < 1
    assert text[begin[1]:].startswith("die") and end[1] == len(text.rstrip())


def test_odd_rows(spark, model):
    rows = [(1, None, "en", None, 0), (2, "", None, "s", 0), (3, " 12 ++ ²³ Ⅷ", "en", "s", 1), (None, "the that of", "en", "s", 1),
            (5, "the and this " * 20_000, "en", "s", 1), (6, "Привет мир", None, "s", 1), (7, "İstanbul ǅ", "en", "s", 1),
            (8, "the and", "en", "s", 1), (8, "the and", "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as span_lang", "1 as score")
    got = language.identify(docs, model).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 and by[i]["span_lang"] == [] for i in (1, 2, 3))
    assert by[5]["lang_pred"] == by[None]["lang_pred"] == by[8]["lang_pred"] == "en"
    assert by[7]["span_end"][-1] <= len("İstanbul ǅ")
    assert by[6]["lang_pred"] in model.languages
    assert language.query(docs.limit(0)).count() == 0
    nothing = language.fit(docs.filter("false"))
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}


def test_scripts_narrow(spark):
    rows = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate([("привет мир как дела", "ru"), ("hello world how are you", "en"),
                                                               ("שלום עולם מה שלומך", "he")] * 5)]
    model = language.fit(spark.createDataFrame(rows, SCHEMA))
    preds = [p for p, *_ in language.label(model, ["мирмир", "worldly", "עולם", "ελληνικά"])]
    assert preds[:3] == ["ru", "en", "he"]
    (pred, _, _, _, langs), = language.label(model, ["hello world how are you привет мир как дела"])
    assert langs == ["en", "ru"] and pred == "en"
