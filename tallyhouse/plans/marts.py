"""Facts and dimensions, each a function of staged tables.

Joins are written so that no side is forced into one task: aggregates run
before the join where they can, and the joins that may meet a hot key go
through ``spread_join``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_average
from ..operators.skew import COLD, HotKeys, join_dimension, spread_join
from ..specs import HIGH_VALUE_REVENUE, LATE_AFTER_DAYS, source


def items_per_order(items: DataFrame) -> DataFrame:
    """Number of item lines and their total per order."""
    return items.groupBy("order_id").agg(
        F.count("*").alias("total_items"), F.sum("line_total").alias("items_total")
    )


def fact_orders(
    orders: DataFrame,
    payments: DataFrame,
    shipments: DataFrame,
    items: DataFrame,
    hot_payments: HotKeys = COLD,
    hot_shipments: HotKeys = COLD,
) -> DataFrame:
    """One row per order, payment and shipment combination.

    An order with two payments and two shipments gives four rows. The three
    joins share ``order_id``, so each side is exchanged once. Orders and the
    per-order item counts are unique by key; payments and shipments are the
    sides that can pile up on one order.
    """
    pay = payments.select("order_id", "payment_id", "payment_method", "payment_status", "payment_amount")
    ship = shipments.select("order_id", "shipment_id", "carrier", "shipping_method", "shipping_cost", "shipment_status")
    rows = orders.join(items_per_order(items), "order_id", "left")
    rows = spread_join(rows, pay, "order_id", right_hot=hot_payments)
    rows = spread_join(rows, ship, "order_id", left_hot=HotKeys(hot_payments.keys), right_hot=hot_shipments)
    status = F.col("order_status")
    return rows.select(
        "order_id", "customer_id", "order_date", "order_status", "currency", "total_amount", "created_at",
        "payment_method", "payment_status",
        F.coalesce("payment_amount", F.lit(0)).alias("payment_amount"),
        "carrier", "shipping_method",
        F.coalesce("shipping_cost", F.lit(0)).alias("shipping_cost"),
        "shipment_status",
        F.coalesce("total_items", F.lit(0)).alias("total_items"),
        (status == "completed").alias("is_completed"),
        (status == "cancelled").alias("is_cancelled"),
        (status == "refunded").alias("is_refunded"),
    )


def fact_order_items(
    items: DataFrame, products: DataFrame, raw_items: DataFrame | None = None, raw_products: DataFrame | None = None
) -> DataFrame:
    """Item lines with cost and profit estimated from the product's cost price."""
    prices = products.select("product_id", "cost_price")
    # A product id of at most 20 characters and a decimal.
    rows = join_dimension(items, prices, "product_id", 4 * 20 + 64, raw_items, raw_products)
    cost = F.col("cost_price") * F.col("quantity")
    return rows.select(
        "order_item_id", "order_id", "product_id", "quantity",
        "unit_price", "discount_amount", "tax_amount", "line_total",
        F.round(cost, 2).alias("estimated_cost"),
        F.round(F.col("line_total") - cost, 2).alias("estimated_profit"),
    )


def fact_daily_sales(orders: DataFrame) -> DataFrame:
    """Order counts and money per day, from ``fact_orders``."""
    paid = F.when(F.col("is_completed"), F.col("total_amount"))
    return (
        orders.groupBy("order_date")
        .agg(
            F.count("*").alias("total_orders"),
            F.count_if("is_completed").alias("completed_orders"),
            F.count_if("is_cancelled").alias("cancelled_orders"),
            F.count_if("is_refunded").alias("refunded_orders"),
            F.sum(paid).alias("total_revenue"),
            F.sum("total_items").alias("total_items_sold"),
            exact_average(paid).alias("average_order_value"),
            F.sum("shipping_cost").alias("total_shipping_cost"),
        )
        .orderBy("order_date")
    )


def fact_customer_revenue(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Order statistics per customer, with the attributes of ``dim_customers``.

    ``dim_customers`` has one row per customer, so grouping first and joining
    one row per customer afterwards gives the same rows as joining every order.
    """
    paid = F.when(F.col("is_completed"), F.col("total_amount"))
    stats = orders.groupBy("customer_id").agg(
        F.count("*").alias("total_orders"),
        F.count_if("is_completed").alias("completed_orders"),
        F.sum(paid).alias("total_revenue"),
        exact_average(paid).alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    who = customers.select("customer_id", "full_name", "email", "country", "city", "customer_segment")
    return stats.join(who, "customer_id", "left").select(*who.columns, *stats.columns[1:])


def fact_shipping_performance(
    shipments: DataFrame, orders: DataFrame, hot_shipments: HotKeys = COLD
) -> DataFrame:
    """Shipments with their order date and a late flag.

    Late means strictly more days than the method allows; unknown methods and
    missing days are not late.
    """
    dates = orders.select("order_id", "order_date")
    rows = spread_join(shipments, dates, "order_id", left_hot=hot_shipments)
    late = F.lit(False)
    for method, days in LATE_AFTER_DAYS.items():
        late = late | ((F.col("shipping_method") == method) & (F.col("delivery_days") > days))
    return rows.select(
        "shipment_id", "order_id", "order_date", "carrier", "shipping_method", "shipping_cost",
        "shipped_at", "delivered_at", "shipment_status", "delivery_days",
        F.coalesce(late, F.lit(False)).alias("is_late"),
    )


def completed_order_stats(orders: DataFrame) -> DataFrame:
    return (
        orders.filter(F.col("order_status") == "completed")
        .groupBy("customer_id")
        .agg(
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.count("*").alias("total_orders"),
            F.sum("total_amount").alias("total_revenue"),
        )
    )


def dim_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with their completed-order history and a segment."""
    rows = customers.join(completed_order_stats(orders), "customer_id", "left")
    count, revenue = F.col("total_orders"), F.col("total_revenue")
    segment = (
        F.when(count.isNull(), "inactive")
        .when(count == 1, "new")
        .when(revenue >= HIGH_VALUE_REVENUE, "high_value")
        .otherwise("returning")
    )
    return rows.select(
        "customer_id", "full_name", "email", "country", "city",
        F.col("created_at").alias("customer_created_at"),
        "first_order_date", "last_order_date",
        F.coalesce(count, F.lit(0)).alias("total_orders"),
        F.coalesce(revenue, F.lit(0)).alias("total_revenue"),
        segment.alias("customer_segment"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    spec = source("products")
    return products.select(*spec.columns, "gross_margin_pct")
