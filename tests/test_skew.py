"""Sliced joins against plain joins, with hot keys forced and found."""

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.latest import latest_by_key
from tallyhouse.operators.skew import COLD, HotKeys, bounded_broadcast, hot_keys, join_dimension, spread_join


@pytest.fixture(scope="module")
def sides(spark):
    left = [(k, f"l{i}") for i, k in enumerate(["a"] * 40 + ["b"] * 3 + ["c", "d", "e"] + [None] * 25)]
    right = [(k, f"r{i}") for i, k in enumerate(["a"] * 5 + ["c"] * 60 + ["d"] + ["z"] * 4 + [None] * 9)]
    return (spark.createDataFrame(left, "k string, x string").repartition(4),
            spark.createDataFrame(right, "k string, y string").repartition(4))


def rows(df):
    return sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("left_hot,right_hot", [
    (COLD, COLD),
    (HotKeys(("a",)), COLD),
    (HotKeys(("a",), null=True), HotKeys(("c",))),
    (HotKeys(("a", "c")), HotKeys(("a", "c"))),
    (HotKeys(("b", "nowhere")), HotKeys(("b", "e", "z", "nowhere"))),  # hot on the left, absent on the right
    (HotKeys((), null=True), COLD),
])
def test_spread_join_equals_plain_join(sides, how, left_hot, right_hot):
    left, right = sides
    assert rows(spread_join(left, right, "k", how, left_hot, right_hot, slices=4)) == rows(left.join(right, "k", how))


def test_hot_keys_are_found(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 9 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k")).repartition(5)
    found = hot_keys(df, "k", min_rows=100)
    assert found.keys == ("hot",) and not found.null  # NULL holds less than a few tasks' rows
    assert found.parts[0] >= 8 * 3000 // 9000
    assert hot_keys(df, "k") == COLD  # too few rows to matter
    assert hot_keys(df.limit(0), "k", min_rows=1) == COLD
    assert hot_keys(df.withColumn("k", F.lit(None).cast("string")), "k", min_rows=1).null
    big = spark.range(100_000).selectExpr("case when id % 4 = 0 then 'x' else cast(id as string) end as k")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        # A quarter of the rows is the share of 50 of 200 tasks, whatever the number of rows.
        assert hot_keys(big, "k", min_rows=1).parts == (64,) == hot_keys(big.limit(10_000), "k", min_rows=1).parts
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_fan_out_of_one_small_file_takes_many_tasks(spark, tmp_path, how):
    """Both sides are small enough to be broadcast, and each comes in one file; what comes out of the join does not."""
    for name, n in (("x", 2000), ("y", 200)):
        spark.range(n).selectExpr("cast(id % 20 as string) as k", f"id as {name}").coalesce(1).write.parquet(f"{tmp_path}/{name}")
    left, right = spark.read.parquet(f"{tmp_path}/x"), spark.read.parquet(f"{tmp_path}/y")
    out = spread_join(left, right, "k", how, HotKeys(("1", "3"), True, (8, 4), 4), HotKeys(("1",), False, (2,)))
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 2000 * 10 and max(per_task) <= 2000 * 10 / 4


def test_one_join_reads_each_side_once(sides, capsys):
    left, right = sides
    spread_join(left, right, "k", "inner", HotKeys(("a",)), HotKeys(("c",))).explain()
    assert capsys.readouterr().out.count("Scan ExistingRDD") == 2


def test_hot_rows_spread_over_partitions(spark):
    left = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("x"))
    right = spark.createDataFrame([("hot", 1)], "k string, y int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spread_join(left, right, "k", "left", HotKeys(("hot",)))
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(s["count"] for s in sizes) == 4000
    assert max(s["count"] for s in sizes) <= 1000


def test_bounded_broadcast(spark):
    df = spark.range(100)
    assert bounded_broadcast(df, row_bytes=8, limit_bytes=8 * 99) is None
    assert bounded_broadcast(df, row_bytes=8, limit_bytes=8 * 100).count() == 100
    assert bounded_broadcast(df.limit(0), 8, 80, superset=df).count() == 0


def test_dimension_beyond_the_bound_takes_the_sliced_join(sides, monkeypatch):
    left, _ = sides
    dimension = left.sparkSession.createDataFrame([("a", 1), ("c", 2), ("z", 3)], "k string, y int")
    monkeypatch.setattr("tallyhouse.operators.skew.hot_keys", lambda df, key: HotKeys(("a",), null=True))
    expected = rows(left.join(dimension, "k", "left"))
    assert rows(join_dimension(left, dimension, "k", row_bytes=100)) == expected
    assert rows(join_dimension(left, dimension, "k", row_bytes=1 << 25)) == expected
    assert rows(join_dimension(left, dimension, "k", row_bytes=1 << 25, raw_facts=left, raw_dimension=dimension)) == expected


def test_latest_forwards_one_row_per_key_and_task(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 10).cast("string").alias("k"), "id")
    newest = latest_by_key(df, "k", [F.col("id").desc()], hashed=True)
    newest.explain()
    plan = capsys.readouterr().out
    assert sorted(r.id for r in newest.collect()) == list(range(990, 1000))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1
