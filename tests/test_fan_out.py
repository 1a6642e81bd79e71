"""Joins of which far more rows come out than go in: what tasks hold, and the space that the rows take."""

import pytest
from catalog.queries import QUERIES
from pyspark.sql import functions as F

import catalog.queries_more  # noqa: F401 - registers its queries
from tallyhouse.operators import skew
from tallyhouse.operators.skew import COLD, HotKeys, spread_join


@pytest.fixture(scope="module")
def sides(spark):
    left = [(k, f"l{i}") for i, k in enumerate(["a"] * 30 + ["b"] * 3 + ["c", "e"] + [None] * 9)]
    right = [(k, f"r{i}") for i, k in enumerate(["a"] * 25 + ["c"] * 40 + ["b"] + ["z"] * 14 + [None] * 9)]
    return (spark.createDataFrame(left, "k string, x string").repartition(4),
            spark.createDataFrame(right, "k string, y string").repartition(4))


@pytest.fixture
def sorted_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows(df):
    return df.columns, sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("left_hot,right_hot", [
    (COLD, COLD), (HotKeys(("a",), True), HotKeys(("c",))), (HotKeys(("a", "b"), False, (2, 4)), HotKeys(("e", "z"), True, (8, 2), 2)),
])
def test_blocks_change_no_row(sides, monkeypatch, how, left_hot, right_hot):
    monkeypatch.setattr(skew, "BLOCK_ROWS", 4)
    for a, b in (sides, sides[::-1]):
        assert rows(spread_join(a, b, "k", how, left_hot, right_hot, 4, fan_out=True)) == rows(a.join(b, "k", how))


def test_names_of_both_sides(sides, monkeypatch):
    monkeypatch.setattr(skew, "BLOCK_ROWS", 4)
    a, b = sides[0], sides[1].withColumnRenamed("y", "X")
    out = spread_join(a, b, "k", "inner", HotKeys(("a",)), COLD, 4, fan_out=True)
    assert rows(out) == rows(a.join(b, "k"))


def test_a_key_has_a_slice_for_each_block(sides, monkeypatch):
    monkeypatch.setattr(skew, "BLOCK_ROWS", 4)
    found = skew._in_blocks(sides[1], "k", HotKeys(("a", "q"), False, (2, 64)), 4)
    assert dict(zip(found.keys, found.parts)) == {"a": 8, "c": 16, "q": 64, "z": 4}


def test_many_customers_of_few_suppliers_take_little_space(spark, sorted_joins, tmp_path):
    """The customers of a nation are too many to come out beside each supplier in turn, 15 bits each."""
    spark.range(20_000).selectExpr("id as c_custkey", "5 as c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(50).selectExpr("id as s_suppkey", "5 as s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    out = QUERIES["j12_hot_keys_inner_join"](spark, str(tmp_path))
    out.write.parquet(f"{tmp_path}/out")
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert stored.count() == stored.distinct().count() == 1_000_000
    assert sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet")) < 500_000


@pytest.mark.parametrize("name", ["j11_hot_keys_left_join", "j12_hot_keys_inner_join"])
def test_pairs_of_one_key_come_from_many_tasks(spark, sorted_joins, tmp_path, name):
    for table, n in (("customer", 9000), ("supplier", 5000)):
        spark.range(n).selectExpr(f"id as {table[0]}_{'cust' if n == 9000 else 'supp'}key", f"5 as {table[0]}_nationkey").write.parquet(f"{tmp_path}/{table}.parquet")
    out = QUERIES[name](spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in out) == 45_000_000 and max(r["count"] for r in out) <= 45_000_000 / 2
