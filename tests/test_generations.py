"""Marts that are replaced as a whole."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyhouse.plans.warehouse import MARTS, Warehouse
from tallyhouse.sources.generations import Generations, NotPublished, new_generation

T1, T2, T3 = (datetime(2026, 5, d, 6) for d in (1, 2, 3))
SF = "/root/testdata/sf0.001"


@pytest.fixture
def store(spark, tmp_path):
    return Generations(spark, str(tmp_path / "marts"))


def numbers(spark, n):
    return spark.range(n, numPartitions=4).withColumnRenamed("id", "n")


def publish(store, at, **tables):
    g = new_generation(at)
    for name, df in tables.items():
        store.write(df, name, g)
    store.publish(g, tables, at)
    return g


def test_readers_follow_the_pointer(spark, store):
    with pytest.raises(NotPublished):
        store.read("a")
    publish(store, T1, a=numbers(spark, 3), b=numbers(spark, 1))
    opened = store.read("a")
    second = publish(store, T2, a=numbers(spark, 7))
    assert store.read("a").count() == 7 and store.read("b").count() == 1
    assert opened.count() == 3  # who has opened a table keeps it
    assert {(r.table_name, r.number) for r in store.current().collect()} == {("a", 2), ("b", 1)}
    old = store.superseded().collect()
    assert [(r.table_name, r.path) for r in old] == [("a", store.path(old[0].generation, "a"))] and old[0].generation != second
    assert spark.read.parquet(old[0].path).count() == 3


def test_a_build_that_dies_while_it_writes_changes_nothing(spark, store):
    publish(store, T1, a=numbers(spark, 3))
    broken = numbers(spark, 1000).withColumn("n", F.when(F.col("n") < 900, F.col("n")).otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(PySparkException):
        publish(store, T2, a=broken)
    assert store.read("a").count() == 3
    store.write(numbers(spark, 9), "a", new_generation(T2))  # written whole, but dead before the pointer
    assert store.read("a").count() == 3 and store.superseded().count() == 0
    publish(store, T3, a=numbers(spark, 5))
    assert store.read("a").count() == 5


def test_tables_of_one_build_change_together(spark, store, tmp_path):
    publish(store, T1, a=numbers(spark, 1), b=numbers(spark, 1))
    publish(store, T2, a=numbers(spark, 2), b=numbers(spark, 2))
    assert {r.generation for r in store.current().collect()} == {store.current().first().generation}
    files = [f for f in (tmp_path / "marts" / "pointers").rglob("*.parquet")]
    assert len(files) == 2  # one file, written by one task, for each build


def test_builds_published_at_once(spark, store):
    """Both saw the same pointers before; one of them counts for all its tables."""
    g1, g2 = new_generation(T1), new_generation(T2)
    for g, n in ((g1, 1), (g2, 2)):
        store.write(numbers(spark, n), "a", g)
        store.write(numbers(spark, n), "b", g)
    pointers = store._pointers()
    store._pointers = lambda: pointers.limit(0)
    store.publish(g2, ["a", "b"], T2)
    store.publish(g1, ["a", "b"], T1)
    del store._pointers
    assert store.read("a").count() == store.read("b").count() == 2


def test_a_generation_is_written_once(spark, store):
    g = new_generation(T1)
    store.write(numbers(spark, 1), "a", g)
    with pytest.raises(PySparkException):
        store.write(numbers(spark, 2), "a", g)


def test_sorted_ranges(spark, store):
    df = store.write(numbers(spark, 1000).orderBy(F.col("n").desc()), "a", new_generation(T1), sort_by="n")
    spans = df.groupBy(F.input_file_name()).agg(F.min("n").alias("a"), F.max("n").alias("b")).orderBy("a").collect()
    assert all(x.b < y.a for x, y in zip(spans, spans[1:])) and df.count() == 1000


def test_warehouse_builds_are_published_as_one(spark, store):
    house = Warehouse.from_tables(spark, SF, store)
    want = {name: getattr(Warehouse.from_tables(spark, SF), name).count() for name in MARTS}
    house.fact_daily_sales
    with pytest.raises(NotPublished):
        store.read("fact_daily_sales")
    house.publish(T1)
    assert {name: store.read(name).count() for name in MARTS} == want
    assert sorted(store.create_views()) == sorted(MARTS)
    assert spark.sql("select count(*) as n from fact_orders").first().n == want["fact_orders"]
    with pytest.raises(ValueError):
        Warehouse.from_tables(spark, SF).publish(T1)


def test_staging_as_views(spark):
    house = Warehouse.from_tables(spark, SF)
    assert "stg_orders" in house.create_views()
    assert spark.sql("select count(*) as n from stg_orders").first().n == house.staged("orders").count()
    # A view is no table: it is computed from the raw rows when asked.
    assert "Scan parquet" in spark.sql("select * from stg_payments")._jdf.queryExecution().toString()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_staging_joins_without_a_shuffle(spark, store):
    """Tables that meet on the order lie in buckets of it."""
    house = Warehouse.from_tables(spark, SF, store)
    for name in ("orders", "payments", "shipments", "order_items"):
        house.staged(name)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # these tables are small enough to be sent about
    try:
        from tallyhouse.plans import marts

        joined = marts.fact_orders(*(house.staged(n) for n in ("orders", "payments", "shipments", "order_items")))
        text = plan(joined)
        assert text.count("SortMergeJoin") == 3 and "Exchange" not in text
        lazy = Warehouse.from_tables(spark, SF).fact_orders
        assert "Exchange" in plan(lazy)
        assert sorted(map(str, joined.collect())) == sorted(map(str, lazy.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_order_is_not_put_into_one_bucket(spark, store):
    from tallyhouse.operators.skew import HotKeys

    house = Warehouse.from_tables(spark, SF, store)
    house.__dict__["hot_payments"] = HotKeys(("ORD000000001",))
    assert house._bucket("payments") is None and house._bucket("shipments") == "order_id" and house._bucket("customers") is None
    assert house.fact_orders.count() == Warehouse.from_tables(spark, SF).fact_orders.count()
