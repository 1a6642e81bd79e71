"""Line dedup: large groups of near copies ask few questions, words are made once, signatures of two lengths agree."""

import numpy as np
import pytest
from test_lines import brute, frame_of, got, made

from tallyhouse.llm import lines


def near_copies(n, size, edits):
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in range(size)]
    rows = []
    for i in range(n):
        line = list(base)
        for k in range(int(rng.integers(0, edits + 1))):
            line[int(rng.integers(size))] = f"x{i}y{k}"
        rows.append((i, " ".join(line)))
    return rows


def test_most_of_a_group_ask_no_further(spark, monkeypatch):
    asked, pairs = [], lines._pairs

    def counted(entries, percent, *more, **named):
        asked.append(entries.filter("asked").count() if "asked" in entries.columns else entries.select("row").distinct().count())
        return pairs(entries, percent, *more, **named)

    monkeypatch.setattr(lines, "_pairs", counted)
    rows = near_copies(300, 40, 2)
    assert got(frame_of(spark, rows)) == brute(rows)
    assert sum(asked) < 20


def test_words_are_made_once(spark):
    docs = frame_of(spark, made(1)).selectExpr("doc_id", "xxhash64(text) as mark", "text")
    classes = lines.rarity_classes(docs)
    made_of = lines.distinct_lines(docs, *(classes if isinstance(classes, tuple) else (classes,)), 80)
    plan = made_of._jdf.queryExecution().executedPlan().toString()
    assert plan.count("sort_array") == 1


@pytest.mark.parametrize("wide", [10, 25])
def test_signatures_of_two_lengths(spark, monkeypatch, wide):
    monkeypatch.setattr(lines, "WIDE", wide, raising=False)
    rows = made(5) + [(100 + i, t) for i, t in near_copies(40, 30, 8)] + [(200 + i, t) for i, t in near_copies(20, 24, 3)]
    assert got(frame_of(spark, rows)) == brute(rows)
