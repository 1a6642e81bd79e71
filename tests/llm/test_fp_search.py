import heapq
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyhouse.llm import fp_search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def said(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    vectors = [(i, Counter(said(text))) for i, text in docs]
    n_docs, n_terms = sum(bool(v) for _, v in vectors), sum(v.total() for _, v in vectors)
    df = Counter(t for _, v in vectors for t in v)
    out = []
    for item, text in items:
        scored = []
        for i, v in vectors:
            m = 10 + 90 * v.total() * n_docs // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * v[t] // (1000 * v[t] + 8 * m))
                        for t in set(said(text)) if v[t])
            if score:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if no else i, -score) for rank, (score, no, i) in enumerate(heapq.nsmallest(k, scored), 1)]
    return sorted(out, key=str)


def got(spark, docs, items, k=10):
    d = spark.createDataFrame([(i, t, 7, "x") for i, t in docs], "doc_id long, text string, rank int, item string")
    q = spark.createDataFrame([(i, t, 1.0) for i, t in items], "item_id long, text string, score double")
    return sorted(map(tuple, fp_search.search(d, q, k).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    r = random.Random(seed)
    words = ["the", "of", "and", "Zebra", "émile", "ÉMILE", "x1", "a", "b", "c"] + [f"w{i}" for i in range(60)]

    def text(n):
        return r.choice([" ", "-", "\x00", "_"]).join(words[min(int(r.expovariate(0.15)), len(words) - 1)] for _ in range(n))

    docs = [(i, text(r.randrange(0, 40))) for i in range(300)] + [(5, text(9))]
    docs += docs[:20] + [(None, docs[3][1]), (None, None), (7, ""), (2**62, "Zebra " * 50_000)]
    items = [(i, text(r.randrange(1, 25))) for i in range(12)] + [(12, None), (13, "nothing here"), (None, "zebra w3"), (3, "THE ÉMILE")]
    assert got(spark, docs, items) == brute(docs, items)


def test_ties_go_to_smaller_ids(spark):
    docs = [(i, "one two") for i in range(40, 0, -1)] + [(None, "one two")] * 3
    items = [(1, "one")]
    assert got(spark, docs, items, 4) == brute(docs, items, 4)
    assert [r[2] for r in got(spark, docs, items, 42)][-1] is None or len(got(spark, docs, items, 42)) == 42


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == []
    assert got(spark, [(1, "a")], []) == []
    assert got(spark, [(1, None), (2, "--")], [(1, "a")]) == []


@pytest.mark.parametrize("width", [1, 7, 70])
def test_tree_leaves_out_nothing_and_prunes(width):
    rng = np.random.default_rng(width)
    tf = rng.integers(0, 4, (2000, width)) * (rng.random((2000, width)) < np.linspace(0.9, 0.02, width))
    tf = tf[tf.any(axis=1)]
    m, ids = rng.integers(10, 400, len(tf)), np.array(rng.permutation(len(tf)).tolist(), object)
    weights = np.sort(rng.integers(0, 9000, width))
    best = []
    visited = fp_search.Tree(tf, m, ids, weights).search(best, 10)
    scores = (weights * (10**9 * tf // (1000 * tf + 8 * m[:, None]))).sum(axis=1)
    assert sorted(best) == sorted(heapq.nlargest(10, [(int(s), -i) for s, i in zip(scores, ids) if s]))
    if width == 70:
        assert visited < len(tf)
    # What a lot before left behind is kept if it is better.
    more = [(10**15, -1)] * 10
    assert fp_search.Tree(tf, m, ids, weights).search(more, 10) == 0 and more == [(10**15, -1)] * 10


def test_terms_of_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(fp_search, "PIECE", 5)
    text = "Aé bcdefghijk,l-m nopqrstuvw  X"
    assert [w.decode() for p in fp_search.terms_of(text) for w in p] == said(text)
