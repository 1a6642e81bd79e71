"""Merkle fingerprints: ranges stay small for outlying, missing and equal ids, and every row meets the next."""

import pytest
from pyspark.sql import functions as F
from test_merkle import SCHEMA

from tallyhouse.llm import merkle

IDS = {
    "outlier": lambda i: 10**15 if i == 999 else i,
    "both_ends": lambda i: (-(2**63), 2**63 - 1)[i % 2] if i > 997 else i,
    "null": lambda i: None,
    "equal": lambda i: 7,
    "two_clusters": lambda i: i + 10**17 * (i % 2),
}


@pytest.mark.parametrize("ids", IDS)
def test_next_and_spread(spark, monkeypatch, ids):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 50)
    rows = [(IDS[ids](i), f"text {i}", "en", "s", 1) for i in range(1000)]
    found = merkle.beside_next(spark.createDataFrame(rows, SCHEMA))
    hashes = dict(spark.createDataFrame([(r[1],) for r in rows], "t string").select("t", F.xxhash64("t")).collect())
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1]]))
    after = {r[1]: order[(k + 1) % len(order)][1] for k, r in enumerate(order)}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = found.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {r["text"]: r["next_text"] for r in got} == after and len(got) == 1000
    # Twenty ranges over eight tasks: none holds the table.
    assert max(sum(r["task"] == t for r in got) for t in range(8)) < 500
