"""N-gram join: leaders under keys of few rows come from one exchange, and components grow from those so far."""

import numpy as np

from tallyhouse.llm import ngram_join


def test_leaders_among_few(spark):
    rng = np.random.default_rng(3)
    rows = [(int(key), int(row), 20, int(rng.integers(3)), 5, int(row) % 7) for key in range(60) for row in rng.choice(40, int(rng.integers(1, 9)), False)]
    rooted = spark.createDataFrame(rows, "key long, row long, n long, at int, met long, root long")
    roots = rooted.selectExpr("row as node", "root").distinct()
    found = ngram_join._met_among_few(rooted, 0, 2, 80)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(key#") == 1
    want = ngram_join._met(rooted.drop("root"), roots, 0, 2, 80)
    assert want.count() > 20 and sorted(found.collect()) == sorted(want.collect())


def test_components_grow_from_stars(spark, monkeypatch):
    given = []
    whole = ngram_join.components
    monkeypatch.setattr(ngram_join, "components", lambda links: given.append(links.count()) or whole(links))
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base[:-1], f"x{i}"])) for i in range(12)] + [(20, "some words of its own that stand here")]
    found = ngram_join.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {**dict.fromkeys(range(12), 0), 20: 20}
    # Never more than one link for each document in a component, and the new ones.
    roots = ngram_join._merged(spark.createDataFrame([(1, 0), (2, 0), (0, 0)], "node long, root long"),
                               spark.createDataFrame([(2, 3)], "u long, v long"))
    assert {r["node"]: r["root"] for r in roots.collect()} == dict.fromkeys(range(4), 0) and given[-1] == 4
