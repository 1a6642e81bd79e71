"""Merkle fingerprints: brute force for the tree, the next document, and what an edit changes."""

import hashlib

import pytest
from oracle_compare import compare, connect
from pyspark.sql import functions as F

from tallyhouse.llm import merkle
from tallyhouse.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def tree(text):
    said = [[f"{sha(s)}:{len(s)}" for s in p.split(". ")] for p in text.split("\n")]
    paragraphs = [sha("paragraph:" + ",".join(p)) for p in said]
    cut, sections = "", []
    for h in paragraphs:
        cut += h
        if h[0] == "0":
            sections.append(cut)
            cut = ""
        else:
            cut += ","
    if cut:
        sections.append(cut)
    return sha("document:" + ",".join(sha("section:" + c) for c in sections)), paragraphs, {s for p in said for s in p}


def near(a, b):
    if a[0] == b[0]:
        return 1.0
    def weigh(leaves):
        return sum(int(x.split(":")[1]) for x in leaves)
    return weigh(a[2] & b[2]) / weigh(a[2] | b[2]) if weigh(a[2] | b[2]) else 0.0


def brute(rows):
    """Rows (doc_id, text) of different ids, in order."""
    out = {}
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b = tree(text), tree(edited)
        out[i] = (len(text), sha(edited), a[0], b[0], near(a, b), near(a, tree(after)))
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 1000])
def test_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(merkle, "RANGE_ROWS", size)
    texts = ["One. Two.\nThree. Four\n\nFive", "", None, "é🙂. x", ". . .", "\n\n", "same. text", "same. text", "a" * 50_000, "b. " * 9000,
             "\n".join(f"line {i}. end" for i in range(300))]
    rows = [(i, t) for i, t in zip([-10**18, -5, 0, 1, 2, 7, 8, 9, 500, 10**12, 10**18], texts, strict=True)]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in reversed(rows)], SCHEMA)
    got = {r["doc_id"]: r for r in merkle.query(frame).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for i, expected in want.items():
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == expected[:4]
        assert (r["near_edited"], r["near_next"]) == pytest.approx(expected[4:])


def test_odd_tables(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert merkle.query(frame).count() == 0
    one = spark.createDataFrame([(4, "a. b", "en", "s", 1)], SCHEMA).selectExpr("*", "1 as a_s", "'x' as _bin", "2 as next_text")
    r = merkle.query(one).first()
    assert r["near_next"] == 1.0 and r["edited_sha256"] == sha("a." + "a.")
    rows = [(1, "x", "en", "s", 1), (1, "x", "en", "s", 1), (1, "y", "en", "s", 1), (None, "z", "en", "s", 1), (None, "z", "en", "s", 1), (None, None, "en", "s", 1)]
    found = merkle.beside_next(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 6
    # Every text follows as often as it occurs.
    assert sorted(r["next_text"] for r in found) == sorted(r[1] or "" for r in rows)


def test_edit_is_located(spark):
    lines = [f"paragraph {i}. It has two sentences" for i in range(200)]
    edited = [*lines[:120], "paragraph 120. It was changed", *lines[121:]]
    frame = spark.createDataFrame([("\n".join(lines), "\n".join(edited))], "x string, y string")
    r = merkle.with_tree(merkle.with_tree(frame, "x", "a"), "y", "b").select(
        "a", "b", merkle.changed_paragraphs(F.col("a"), F.col("b")).alias("changed"), merkle.likeness(F.col("a"), F.col("b")).alias("near")).first()
    assert r["changed"] == [120] and 0.98 < r["near"] < 1
    same = set(r["a"]["sections"]) & set(r["b"]["sections"])
    assert len(r["a"]["sections"]) > 5 and len(same) >= len(r["a"]["sections"]) - 2


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_oracle(spark, sf):
    sf = f"/root/testdata/sf{sf}"
    assert compare(spark, sf, connect(sf), QUERIES["op6_fingerprints"], ORACLES["op6_fingerprints"]) is None
