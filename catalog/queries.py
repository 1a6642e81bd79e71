"""One runnable query per operator, over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import exact_average
from tallyhouse.operators.latest import latest_by_key
from tallyhouse.operators.skew import HotKeys, hot_keys, join_dimension, spread_join
from tallyhouse.plans import marts
from tallyhouse.plans.staging import with_key
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.session import prepare, scratch_path
from tallyhouse.sources.feed import read_table
from tallyhouse.sources.generations import Generations

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text: the same in every engine."""
    shown = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def query(name: str):
    """Register ``f(warehouse)`` under ``name``."""

    def register(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: present(build(Warehouse.from_tables(prepare(spark), sf_dir)))
        return build

    return register


def stored_query(name: str):
    """Register ``f(warehouse)`` under ``name``, with a store for its tables."""

    def register(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            store = Generations(prepare(spark), scratch_path(spark, "store"))
            return present(build(Warehouse.from_tables(spark, sf_dir, store)))

        QUERIES[name] = run
        return build

    return register


def table_query(name: str):
    """Register ``f(spark, table reader)`` under ``name``."""

    def register(build: Callable[[SparkSession, Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(build(prepare(spark), lambda table: read_table(spark, sf_dir, table)))

        QUERIES[name] = run
        return build

    return register


# Staging

for number, entity in enumerate(("customers", "products", "orders", "order_items", "shipments", "payments"), 1):
    query(f"s{number}_stg_{entity}")(lambda w, entity=entity: w.staged(entity))


@query("s7_null_key_filter")
def _(w: Warehouse) -> DataFrame:
    raw = w.raw["order_items"]
    some_missing = raw.withColumn("order_item_id", F.when(F.col("quantity") != "1", F.col("order_item_id")))
    kept = with_key(some_missing, "order_items")
    return kept.groupBy(F.col("_ingestion_run_id").alias("load_year")).agg(F.count("*").alias("kept_rows"))


# Marts

for number, mart in enumerate(("fact_orders", "fact_order_items", "fact_daily_sales", "fact_customer_revenue",
                               "fact_shipping_performance", "dim_customers", "dim_products"), 1):
    query(f"m{number}_{mart}")(lambda w, mart=mart: getattr(w, mart))


@stored_query("m8_fact_orders_stored")
def _(w: Warehouse) -> DataFrame:
    """The same mart from stored staging, whose buckets meet without a shuffle."""
    return w.fact_orders


# Joins


@query("j1_orders_payments")
def _(w: Warehouse) -> DataFrame:
    rows = spread_join(w.staged("orders").select("order_id", "order_status"), w.staged("payments"), "order_id",
                       right_hot=w.hot_payments)
    return rows.select("order_id", "order_status", "payment_id", "payment_method", "payment_amount")


@query("j2_orders_shipments")
def _(w: Warehouse) -> DataFrame:
    rows = spread_join(w.staged("orders").select("order_id", "order_status"), w.staged("shipments"), "order_id",
                       right_hot=w.hot_shipments)
    return rows.select("order_id", "order_status", "shipment_id", "carrier", "shipping_cost")


@query("j3_orders_item_counts")
def _(w: Warehouse) -> DataFrame:
    rows = w.staged("orders").join(marts.items_per_order(w.staged("order_items")), "order_id", "left")
    return rows.select("order_id", F.coalesce("total_items", F.lit(0)).alias("total_items"), "items_total")


@query("j4_items_products")
def _(w: Warehouse) -> DataFrame:
    items = w.staged("order_items").select("order_item_id", "product_id")
    products = w.staged("products").select("product_id", "product_name", "category", "cost_price")
    rows = join_dimension(items, products, "product_id", 4 * (20 + 255 + 100) + 64,
                          w.as_read("order_items"), w.as_read("products"))
    return rows.select("order_item_id", "product_name", "category", "cost_price")


@query("j5_shipments_orders")
def _(w: Warehouse) -> DataFrame:
    orders = w.staged("orders").select("order_id", "order_date", "order_status")
    rows = spread_join(w.staged("shipments").select("shipment_id", "order_id"), orders, "order_id",
                       left_hot=w.hot_shipments)
    return rows.select("shipment_id", "order_id", "order_date", "order_status")


@query("j6_customers_order_stats")
def _(w: Warehouse) -> DataFrame:
    stats = marts.completed_order_stats(w.staged("orders"))
    return w.staged("customers").join(stats, "customer_id", "left").select("customer_id", "total_orders", "total_revenue")


@query("j7_fact_orders_customers")
def _(w: Warehouse) -> DataFrame:
    customers = w.dim_customers.select("customer_id", "customer_segment", "country")
    rows = spread_join(w.fact_orders.select("order_id", "customer_id"), customers, "customer_id",
                       left_hot=hot_keys(w.as_read("orders"), "customer_id"))
    return rows.select("order_id", "customer_segment", "country")


@query("j9_item_revenue_by_product")
def _(w: Warehouse) -> DataFrame:
    per_product = w.staged("order_items").groupBy("product_id").agg(
        F.count("*").alias("item_lines"), F.sum("line_total").alias("revenue"))
    return per_product.join(w.staged("products").select("product_id", "category"), "product_id") \
        .select("category", "product_id", "item_lines", "revenue")


@query("j10_orders_item_lines")
def _(w: Warehouse) -> DataFrame:
    """One order, many lines: the fan-out case."""
    items = w.staged("order_items").select("order_id", "order_item_id", "line_total")
    rows = spread_join(w.staged("orders").select("order_id", "order_status"), items, "order_id",
                       right_hot=HotKeys(hot_keys(w.as_read("order_items"), "order_id").keys))
    return rows.select("order_id", "order_status", "order_item_id", "line_total")


# Aggregates


@query("a1_count_grouped")
def _(w: Warehouse) -> DataFrame:
    return w.staged("orders").groupBy("order_status", "currency").agg(F.count("*").alias("orders"))


@query("a2_count_filtered")
def _(w: Warehouse) -> DataFrame:
    status = F.col("order_status")
    return w.staged("orders").groupBy("currency").agg(
        F.count_if(status == "completed").alias("completed"), F.count_if(status == "pending").alias("pending"))


@query("a3_sum")
def _(w: Warehouse) -> DataFrame:
    return w.staged("order_items").groupBy("order_id").agg(F.sum("line_total").alias("items_total"))


@query("a4_sum_filtered")
def _(w: Warehouse) -> DataFrame:
    completed = F.when(F.col("order_status") == "completed", F.col("total_amount"))
    return w.staged("orders").groupBy("customer_id").agg(F.sum(completed).alias("revenue"))


@query("a5_exact_average")
def _(w: Warehouse) -> DataFrame:
    completed = F.when(F.col("order_status") == "completed", F.col("total_amount"))
    return w.staged("orders").groupBy("customer_id").agg(exact_average(completed).alias("average"))


@query("a6_min_max_date")
def _(w: Warehouse) -> DataFrame:
    return w.staged("orders").groupBy("customer_id").agg(
        F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"))


@query("a7_global")
def _(w: Warehouse) -> DataFrame:
    return w.staged("orders").agg(
        F.count("*").alias("all_rows"), F.count_if(F.col("total_amount") < 1000).alias("small_rows"),
        F.max("_loaded_at").alias("newest"))


@query("a8_repeated_keys")
def _(w: Warehouse) -> DataFrame:
    return w.raw["order_items"].groupBy("order_item_id").agg(F.count("*").alias("copies")).filter("copies > 1")


@query("a9_completed_order_stats")
def _(w: Warehouse) -> DataFrame:
    return marts.completed_order_stats(w.staged("orders"))


# Window, sort, top-k


@table_query("w1_latest_by_key")
def _(spark: SparkSession, table: Callable[[str], DataFrame]) -> DataFrame:
    newest = [F.col("ts").desc_nulls_first(), F.col("event_id").desc()]
    return latest_by_key(table("events").select("user_id", "event_id", "event_type", "value", "ts"), "user_id", newest) \
        .drop("ts")


@query("t1_ordered_days")
def _(w: Warehouse) -> DataFrame:
    return w.fact_daily_sales.select("order_date", "total_orders", "total_revenue")


@query("t2_top_products")
def _(w: Warehouse) -> DataFrame:
    revenue = w.staged("order_items").groupBy("product_id").agg(F.sum("line_total").alias("revenue"))
    return revenue.orderBy(F.col("revenue").desc(), "product_id").limit(10)
