"""N-gram join: components equal to brute force, with the leader rounds and without them, and odd tables."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyhouse.llm import ngram_join
from tallyhouse.llm.components import components
from tallyhouse.llm.shingles import shingle_sets
from tallyhouse.llm.tables import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """doc_id -> (shingles, component), ids being unique."""
    sets = {i: shingles(t) for i, t in rows}
    inverse, shared, parent = defaultdict(list), Counter(), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            inverse[x].append(i)
    for found in inverse.values():
        for a in range(len(found)):
            for b in range(a):
                shared[found[b], found[a]] += 1

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def got(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.query(frame).collect()}


def near_copies(rng):
    """Chains of near copies around 0.8, many copies of one text, a common passage, short texts."""
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, i = [], 0
    for _ in range(12):
        base = list(rng.choice(vocabulary, int(rng.integers(5, 140))))
        for _ in range(int(rng.integers(1, 9))):
            text = list(base)
            for _ in range(int(rng.integers(0, 4))):
                text[int(rng.integers(len(text)))] = str(rng.choice(vocabulary))
            rows.append((i, " ".join(text).upper() if i % 3 else " \t".join(text)))
            base = text if rng.random() < 0.6 else base
            i += 1
    passage = " ".join(rng.choice(vocabulary, 60))
    for _ in range(60):
        rows.append((i, passage + " " + " ".join(rng.choice(vocabulary, int(rng.integers(0, 60))))))
        i += 1
    rows += [(i + k, t) for k, t in enumerate(["a b c d", "a b c d", "a b c", "a b c d e", "A B c d e f", "", " \n", "x", "X",
                                               "one two three four five six seven eight nine ten eleven"])]
    return rows


@pytest.mark.parametrize("few,leaders", [(16, (4, 32, 256)), (2, (1, 2)), (0, (1, 1))])
@pytest.mark.parametrize("frequent", [64, -10**9])
def test_brute_force(spark, monkeypatch, few, leaders, frequent):
    # With few leaders most pairs go through the last round; with no rare class through pairs of tokens.
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "LEADERS", leaders)
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    rows = near_copies(np.random.default_rng(few + (frequent > 0)))
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    assert got(frame) == brute(rows)


def test_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert got(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd_rows(spark):
    long = "word " * 3 + " ".join(str(i) for i in range(100_000))
    rows = [(5, long), (2, long + " more"), (7, None), (8, ""), (None, long), (9, "x y"), (9, "x y"), (10, "q r s t u v"), (10, "other words"),
            (3, "İ é ı x y z")]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).selectExpr("*", "1 as row", "2 as n", "'k' as key")
    found = ngram_join.groups(frame).collect()
    assert len(found) == len(rows)
    by = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["first"]) for r in found)
    n = len(shingles(long))
    assert by == sorted([("5", n, "2", False), ("2", n + 1, "2", True), ("None", n, "2", False), ("7", 0, "7", True), ("8", 0, "8", True),
                         ("9", 1, "9", True), ("9", 1, "9", False), ("10", 2, "10", True), ("10", 1, "10", True), ("3", 2, "3", True)])
    assert ngram_join.query(frame.limit(0)).count() == 0


def test_shingle_sets():
    texts = ["", "a", "A b", "a b c d e f", "x\x0by\x1cz w", "p q r s t u"]
    for text, found in zip(texts, shingle_sets(texts, 5), strict=True):
        assert len(found) == len(shingles(text))
    one, two = shingle_sets(["a b c d e", "A  b\nc d E"], 5)
    assert (one == two).all()


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(5000, 5000 + i) for i in range(1, 100)] + [(7, 7), (None, 3)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["node"]: r["root"] for r in found} == {i: root(i) for i in list(parent)}
    assert len(found) == len(parent)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
