"""Dashboard numbers over the marts, the ledgers and the quality results.

Where a report says revenue without more, it means completed orders.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_average, mean_days

# Revenue


def total_revenue(daily: DataFrame) -> DataFrame:
    return daily.agg(F.sum("total_revenue").alias("total_revenue"))


def total_orders(orders: DataFrame) -> DataFrame:
    return orders.agg(F.count("*").alias("total_orders"))


def average_order_value(orders: DataFrame) -> DataFrame:
    paid = F.when(F.col("is_completed"), F.col("total_amount"))
    return orders.agg(exact_average(paid).alias("average_order_value"))


def revenue_by_day(daily: DataFrame) -> DataFrame:
    return daily.select("order_date", "total_revenue").orderBy("order_date")


def orders_by_day(daily: DataFrame) -> DataFrame:
    return daily.select("order_date", "total_orders").orderBy("order_date")


def product_revenue(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Completed revenue per product.

    Items are summed per order and product first, so a large order is one row
    per product when it meets the completed orders. Orders are a filter here,
    so an order with several payment rows counts its items once.
    """
    per_order = items.groupBy("order_id", "product_id").agg(F.sum("line_total").alias("revenue"))
    completed = orders.filter("is_completed").select("order_id").distinct()
    return (
        per_order.join(completed, "order_id", "left_semi")
        .groupBy("product_id")
        .agg(F.sum("revenue").alias("revenue"))
    )


def revenue_by_category(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    per_product = product_revenue(items, orders)
    return (
        per_product.join(products.select("product_id", "category"), "product_id", "left")
        .groupBy("category")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "category")
    )


def top_products(items: DataFrame, orders: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    best = product_revenue(items, orders).orderBy(F.col("revenue").desc(), "product_id").limit(n)
    named = best.join(products.select("product_id", "product_name", "category"), "product_id", "left")
    return named.select("product_id", "product_name", "category", "revenue").orderBy(F.col("revenue").desc(), "product_id")


# Customers


def total_customers(customers: DataFrame) -> DataFrame:
    return customers.agg(F.count("*").alias("total_customers"))


def customers_by_segment(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_segment").agg(F.count("*").alias("customers"))


def top_customers(revenue: DataFrame, n: int = 10) -> DataFrame:
    return (
        revenue.select("customer_id", "full_name", "total_orders", "total_revenue")
        .orderBy(F.col("total_revenue").desc_nulls_last(), "customer_id")
        .limit(n)
    )


def revenue_by_country(revenue: DataFrame) -> DataFrame:
    return revenue.groupBy("country").agg(F.sum("total_revenue").alias("total_revenue"))


def new_customers_by_month(customers: DataFrame) -> DataFrame:
    month = F.date_trunc("month", "customer_created_at").cast("date")
    return customers.groupBy(month.alias("month")).agg(F.count("*").alias("new_customers")).orderBy("month")


# Shipping


def average_delivery_days(shipping: DataFrame) -> DataFrame:
    return shipping.agg(mean_days(F.col("delivery_days")).alias("average_days"))


def late_shipments(shipping: DataFrame) -> DataFrame:
    return shipping.agg(F.count_if("is_late").alias("late_shipments"))


def delivery_days_by_carrier(shipping: DataFrame) -> DataFrame:
    return shipping.groupBy("carrier").agg(mean_days(F.col("delivery_days")).alias("average_days"))


def late_by_carrier(shipping: DataFrame) -> DataFrame:
    return shipping.groupBy("carrier").agg(F.count_if("is_late").alias("late_shipments"))


def shipment_statuses(shipping: DataFrame) -> DataFrame:
    return shipping.groupBy("shipment_status").agg(F.count("*").alias("shipments"))


def shipping_cost_by_day(shipping: DataFrame) -> DataFrame:
    return shipping.groupBy("order_date").agg(F.sum("shipping_cost").alias("shipping_cost")).orderBy("order_date")


# Ingest health


def files_loaded_on(files: DataFrame, day: date) -> DataFrame:
    loaded = (F.col("status") == "loaded") & (F.col("loaded_at").cast("date") == F.lit(day))
    return files.agg(F.count_if(loaded).alias("files_loaded"))


def failed_files(files: DataFrame) -> DataFrame:
    return files.agg(F.count_if(F.col("status") == "failed").alias("failed_files"))


def rows_by_source(runs: DataFrame) -> DataFrame:
    return runs.groupBy("source_name").agg(F.sum("rows_loaded").alias("rows_loaded"))


def checks_by_status(results: DataFrame) -> DataFrame:
    return results.groupBy("check_status").agg(F.count("*").alias("checks"))


def run_listing(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.col("started_at").desc(), F.col("ingestion_run_id").desc())
