"""The pipeline against a brute-force version of every stage, and on odd rows."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
import sentencepiece
from test_lines import brute as brute_lines
from test_mixing import level
from test_ngram_join import brute as brute_groups

from tallyhouse.llm import language, mixing, stages
from tallyhouse.llm.tables import table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def taken(spark, rows):
    """doc_id -> number of copies, from plain arithmetic and the operator's draws."""
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows}
    whole = defaultdict(int)
    for i, _, _, source, _ in rows:
        whole[source] += sizes[i]
    order = sorted((s for s in whole if s is not None), key=lambda s: s.encode()) + [None] * (None in whole)
    targets = dict(zip(order, level([whole[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))], 3), strict=True))
    ids = spark.createDataFrame([(i,) for i, *_ in rows], "doc_id long")
    draw = {r["doc_id"]: r["d"] for r in ids.withColumn("d", mixing.uniform_draw(ids["doc_id"], 0)).collect()}
    out = {}
    for i, _, _, source, _ in rows:
        rate = float(targets[source]) / whole[source] if whole[source] else 0.0
        out[i] = int(rate) + (draw[i] < rate - int(rate))
    return out


def test_brute_force(spark):
    docs = table(spark, SF, "documents").select(*COLUMNS)
    rows = [tuple(r) for r in docs.collect()]
    model = language.learned(docs)
    rows = [r for r, (pred, score, *_) in zip(rows, language.label(model, [r[1] or "" for r in rows]), strict=True)
            if pred != "und" and score >= 0.5]
    cut = brute_lines([(r[0], r[1]) for r in rows])
    rows = [(i, cut[i][2], *rest) for i, _, *rest in rows if cut[i][1] == 0 or (cut[i][2] or "").split()]
    groups = brute_groups([(r[0], r[1]) for r in rows])
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    copies = taken(spark, rows)
    lib = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.MODEL)
    want = Counter()
    for i, text, lang, source, _ in rows:
        want[i, lang, source, tuple(lib.encode(text))] += copies[i]
    got = Counter((r["doc_id"], r["lang"], r["source"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == +want
    assert sum(got.values()) > 100


def test_stage_columns(spark):
    docs = table(spark, SF, "documents")
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_join", "mixing", "sentencepiece"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).schema.simpleString() == docs.schema.simpleString()


LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
ODD = [(1, None, "en", "a", None), (2, "", "en", None, 0), (3, "12 34", None, "b", 5), (4, LONG, "en", "a", 9), (4, LONG, "en", "a", 9),
       (None, LONG + " pi", "en", "b", 9), (6, LONG.upper(), None, "a", 9), (7, "one two three", "en", "c", 13), (8, "x " * 60_000, "en", "a", 1)]


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() >= 0


def test_decisions(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    kept = stages.keep_languages(spark, docs, SF).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["4", "4", "6", "7", "8", "None"]
    assert all(r["lang"] == "en" for r in kept)
    one = stages.keep_one_of_each_group(spark, docs, SF).collect()
    # Rows 4, 6 and the one without an id are near copies of each other; the others are of their own.
    assert sorted(str(r["doc_id"]) for r in one) == ["1", "2", "3", "4", "7", "8"]
    cut = {r["doc_id"]: r["text"] for r in stages.drop_repeated_lines(spark, docs.filter("doc_id <> 4 or doc_id is null"), SF).collect()}
    assert None not in cut and cut[6] == LONG.upper() and cut[1] is None and cut[2] == ""
    nothing = spark.createDataFrame([(1, "words", None, "a", 5)], SCHEMA)
    assert stages.keep_languages(spark, nothing, SF).count() == 1
