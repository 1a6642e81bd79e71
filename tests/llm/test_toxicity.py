"""Toxicity: held-out accuracy, the effect of the counterfactual penalty, odd rows."""

import numpy as np
import pytest

from tallyhouse.llm import toxicity
from tallyhouse.llm.letters import words_of
from tallyhouse.llm.tables import table

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = toxicity.query(spark, SF).join(table(spark, SF, "labels"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 700
    assert (held.toxic == held.predicted).mean() > 0.95
    assert held[held.toxic == 0].predicted.mean() < 0.02
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()


def biased(spark):
    """Labelled texts in which one group is named in toxic texts far more often than the other."""
    rng = np.random.default_rng(3)
    words = ["lorem", "ipsum", "dolor", "amet", "elit", "tempor"]
    rows = []
    for i in range(600):
        toxic = i % 3 == 0
        said = list(rng.choice(words, 8))
        if toxic and i % 2:
            said.insert(3, "vile")
        if toxic:
            said.insert(5, "women")
        elif i % 30 == 1:
            said.insert(5, "men")
        rows.append((i, " ".join(said), int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return frame.select("doc_id", "text"), frame.select("doc_id", "toxic")


def test_swaps_are_penalised(spark):
    docs, labels = biased(spark)
    neutral = ["the women met at noon", "the men met at noon", "the girls met at noon"]
    gaps = {}
    for pairing in (0.0, 50.0):
        scores = toxicity.fit(docs, labels, pairing=pairing).scores(neutral)
        gaps[pairing] = scores.max() - scores.min()
    assert gaps[0.0] > 0.3 and gaps[50.0] < 0.1
    fair = toxicity.fit(docs, labels, pairing=50.0).scores([*neutral, "the vile women met"])
    assert (fair[:3] < 0.5).all() and fair[3] > fair[:3].max()


def test_swapped():
    terms = (("women", "men"), ("café", "bar"))
    assert toxicity.swapped("Women, and MENTORS of men.", terms, 1) == "men, and mentors of women."
    assert toxicity.swapped("Kein Wort.", terms, 1) is None
    assert toxicity.swapped("CAFÉ", terms, 1) == "bar"


def test_features_do_not_depend_on_the_batch():
    texts = ["Stupid words, stupider!", "", "ein Größenwahn", "stupid"]
    def own(t):
        return set(toxicity.features(words_of([t]))[1].tolist())
    docs, cells = toxicity.features(words_of(texts))
    for i, t in enumerate(texts):
        assert set(cells[docs == i].tolist()) == own(t)
    assert own("stupid") & own("STUPIDER")


def test_odd_rows(spark):
    docs, labels = biased(spark)
    odd = spark.createDataFrame([(1, None, 1), (2, "", 2), (None, "vile", 3), (4, "vile " * 100_000, 4), (5, "x", 5), (5, "x", 5)],
                                "doc_id long, text string, score int")
    model = toxicity.fit(docs, labels)
    got = toxicity.classify(odd, model).collect()
    assert len(got) == 6 and {r["predicted"] for r in got} <= {0, 1}
    assert toxicity.classify(odd.limit(0), model).count() == 0
    blank = toxicity.fit(docs, labels.filter("false"))
    assert {r["score"] for r in toxicity.classify(odd, blank).collect()} == {0.5}
    one_class = toxicity.fit(docs, labels.filter("toxic = 0"))
    assert (one_class.scores(["x"]) < 0.5).all()
    doubled = labels.unionByName(labels.selectExpr("doc_id", "cast(null as int) as toxic")).unionByName(labels)
    assert toxicity.fit(docs, doubled).scores(["the vile women"])[0] == pytest.approx(model.scores(["the vile women"])[0])


def test_label_order_does_not_matter(spark):
    docs, labels = biased(spark)
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs.repartition(5), labels.repartition(3))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias
