"""Mixing: the water level against plain arithmetic, whole copies, draws, odd tables."""

import re
from fractions import Fraction

import pytest
from oracle_compare import compare, connect

from tallyhouse.llm import mixing
from tallyhouse.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def level(sizes, weights, rate):
    whole, stopped = sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in stopped]
        left = whole - sum(rate * sizes[i] for i in stopped)
        among = sum(weights[i] for i in free)
        targets = [Fraction(rate * sizes[i]) if i in stopped else Fraction(weights[i] * left, among)
                   for i in range(len(sizes))]
        over = [i for i in free if targets[i] >= rate * sizes[i]]
        if not over or len(over) == len(free) == 0:
            return targets
        stopped |= set(over)
        if len(stopped) == len(sizes):
            return [Fraction(rate * s) for s in sizes]


def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_targets(spark):
    sources = {"a": 3, "b": 50, "c": 700, "Z": 11, "é": 1, None: 20, "\U0001f600": 9, "d": 0}
    rows, i = [], 0
    for s, n in sources.items():
        for k in range(max(n, 1)):
            rows.append((i, "w" if n else "", "en", s, k))
            i += 1
    order = sorted((s for s in sources if s is not None), key=lambda s: s.encode()) + [None]
    weights = [(5, 2, 1)[k % 3] for k in range(len(order))]
    expected = dict(zip(order, level([sources[s] for s in order], weights, 3), strict=True))
    for r in mixing.plan_copies(docs(spark, rows)).collect():
        want = float(expected[r["source"]])
        assert r["target"] == pytest.approx(want, rel=1e-12)
        assert r["source_size"] == sources[r["source"]]
        rate = want / r["source_size"] if r["source_size"] else 0
        assert int(rate) <= r["copies"] <= min(3, int(rate) + 1)


def test_sum_is_near(spark):
    rows = [(i, "a b c " * (1 + i % 7), "en", f"s{i % 5}", 0) for i in range(20000)]
    got = mixing.query(docs(spark, rows)).toPandas()
    by = got.merge(docs(spark, rows).select("doc_id", "source").toPandas(), on="doc_id").groupby("source")
    for _, g in by:
        assert abs(g.taken.sum() / g.target.iloc[0] - 1) < 0.03
        assert (g.taken <= 3 * g["size"]).all()


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "", 0), (3, "x\x0by z", "en", "s", 3), (None, "q", "en", "s", 1),
            (3, "x\x0by z", "en", "s", 3), (4, "long " * 200_000, "en", "s", 1)]
    got = mixing.query(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = {r["doc_id"]: r["size"] for r in got}
    assert sizes == {1: 0, 2: 0, 3: 2, None: 1, 4: 200_000}
    assert len({(r["size"], r["taken"]) for r in got if r["doc_id"] == 3}) == 1
    again = mixing.query(docs(spark, rows).repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_empty_and_all_blank(spark):
    assert mixing.query(docs(spark, [])).count() == 0
    got = mixing.query(docs(spark, [(1, " ", "en", "a", 1), (2, None, "en", "b", 1)])).collect()
    assert {(r["size"], r["target"], r["taken"]) for r in got} == {(0, 0.0, 0)}


def test_clashing_columns_and_emit(spark):
    extra = docs(spark, [(i, "one two", "en", "s", 7) for i in range(5)]).selectExpr("*", "'x' as size", "'y' as copy")
    planned = mixing.plan_copies(extra)
    assert planned.schema["size"].dataType.simpleString() == "bigint"
    made = mixing.emit(planned)
    assert made.count() == sum(r["copies"] for r in planned.collect())
    assert re.fullmatch("int", made.schema["copy"].dataType.simpleString())


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_oracle(spark, sf):
    sf = f"/root/testdata/sf{sf}"
    assert compare(spark, sf, connect(sf), QUERIES["op4_mixing"], ORACLES["op4_mixing"]) is None
