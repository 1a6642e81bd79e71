"""Exact search: equal to brute force with ties, copies, odd vectors and several query blocks."""

import numpy as np
import pytest
from oracle_compare import compare, connect
from pyspark.sql import functions as F

from tallyhouse.llm import topk
from tallyhouse.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, asked, k):
    held = []
    for n, (i, v, *_) in enumerate(rows):
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            held.append((n, i, np.floor(256 * np.asarray(v, np.float32).astype(float)).astype(np.int64)))
    out = []
    for n, i, q in held:
        if not asked(i):
            continue
        scored = sorted((-int(q @ v), float("inf") if j is None else j) for m, j, v in held if m != n and len(v) == len(q))
        out += [(i, r + 1, None if j == float("inf") else j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out, key=str)


def got(frame, asked, **kw):
    return sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.search(frame, asked, **kw).collect()), key=str)


@pytest.mark.parametrize("nodes", [1, 2, 3])
def test_brute_force(spark, nodes, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(nodes)
    rows = [(i, (rng.integers(-3, 4, 5) / 4).tolist(), 0) for i in range(120)]
    rows += [(200 + i, [0.5, 0.5, 0.5, 0.5, 0.5], 0) for i in range(40)]
    rows += [(300, None, 0), (310, [], 0), (320, [float("nan")] * 5, 0), (330, [1.0, None, 1.0, 1.0, 1.0], 0), (350, [float("inf")] * 5, 0),
             (360, [1.0, 2.0], 0), (370, [-1.0, -2.0], 0), (None, [0.25] * 5, 0), (380, [9.0, 9.0, 9.0], 0)]
    rows += [rows[10], rows[10]]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as row", "'y' as id", "1 as size")
    assert got(frame, F.col("vec_id") % 10 == 0, k=4, nodes=nodes) == brute(rows, lambda i: i is not None and i % 10 == 0, 4)


def test_large_components_and_few_rows(spark):
    rows = [(0, [1e6, 2e6], 0), (50, [-1e6, 3e6], 0), (100, [5e6, 5e6], 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert got(frame, F.col("vec_id") % 50 == 0) == brute(rows, lambda i: True, 5)
    assert topk.search(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.search(frame.filter("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_oracle(spark, sf):
    sf = f"/root/testdata/sf{sf}"
    assert compare(spark, sf, connect(sf), QUERIES["op2_topk_search"], ORACLES["op2_topk_search"]) is None
