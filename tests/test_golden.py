"""Small deliveries of our own, ingested and modelled, against numbers worked out by hand.

Order O1 is paid in two parts, so it is two rows of ``fact_orders``; O2 is delivered again with a new state.
"""

from datetime import datetime
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.quality import run_rules
from tallyhouse.plans import checks, marts
from tallyhouse.plans.ingest import run_batch
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources.lake import Lake
from tallyhouse.specs import SOURCES

FILES = {
    "customers/customers.csv": ["C1,ann,lee,A@x.org,fr,lyon,2025-12-01", "C2,bob,ray,b@x.org,de,ulm,2025-12-02",
                                "C3,cy,fox,c@x.org,es,vigo,2025-12-03"],
    "products/products.csv": ["P1,Cup,kitchen,cups,acme,4,10,true", "P2,Mat,kitchen,mats,acme,7.5,10,no"],
    "orders/orders_2026-01-01.csv": ["O1,C1,2026-01-01,completed,usd,100,2026-01-01T08:00:00,2026-01-01T08:00:00",
                                     "O2,C1,2026-01-01,pending,usd,50,2026-01-01T09:00:00,2026-01-01T09:00:00",
                                     "O3,C2,2026-01-02,completed,usd,2500,2026-01-02T09:00:00,2026-01-02T09:00:00"],
    "orders/orders_2026-01-02.csv": ["O2,C1,2026-01-01,Completed ,usd,60,2026-01-01T09:00:00,2026-01-02T09:00:00",
                                     "O4,C2,2026-01-02,cancelled,usd,10,2026-01-02T10:00:00,2026-01-02T10:00:00"],
    "payments/payments.csv": ["Y1,O1,card,paid,60,2026-01-01", "Y2,O1,cash,paid,40,2026-01-01", "Y3,O3,card,paid,2500,2026-01-02"],
    "shipments/shipments.csv": ["S1,O1,dhl,standard,5,2026-01-01T00:00:00,2026-01-09T00:00:00,delivered",
                                "S2,O3,ups,express,7,2026-01-02T00:00:00,2026-01-04T00:00:00,delivered"],
}
ITEMS = [("I1", "O1", "P1", 2, 10.0, 0.0, 0.0, 20.0), ("I2", "O1", "P2", 1, 10.0, 0.0, 0.0, 10.0), ("I3", "O3", "P1", 5, 10.0, 0.0, 0.0, 50.0)]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("golden")
    for name, rows in FILES.items():
        path = root / "landing" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join([",".join(SOURCES[path.parent.name].columns), *rows]) + "\n")
    (root / "landing" / "order_items").mkdir()
    pd.DataFrame(ITEMS, columns=list(SOURCES["order_items"].columns)).to_parquet(root / "landing" / "order_items" / "items.parquet")
    lake = Lake(spark, str(root / "lake"))
    first = run_batch(lake, str(root / "landing"), datetime(2026, 1, 3, 6))
    second = run_batch(lake, str(root / "landing"), datetime(2026, 1, 4, 6))
    return lake, Warehouse(lake.raw_tables()), first, second


def test_batches(loaded):
    _, _, first, second = loaded
    assert (first.discovered, first.loaded, first.failed) == (7, 7, 0)
    assert (second.discovered, second.loaded, second.failed) == (0, 0, 0)


@pytest.mark.parametrize("name,raw,staged", [("orders", 5, 4), ("order_items", 3, 3), ("customers", 3, 3), ("products", 2, 2),
                                             ("shipments", 2, 2), ("payments", 3, 3)])
def test_row_counts(loaded, name, raw, staged):
    lake, w, *_ = loaded
    assert lake.raw(name).count() == raw
    assert w.staged(name).count() == staged


def test_fact_orders(loaded):
    rows = loaded[1].fact_orders.collect()
    got = sorted((r.order_id, str(r.payment_amount), r.carrier, str(r.shipping_cost), r.total_items, r.is_completed) for r in rows)
    assert got == [("O1", "40.00", "Dhl", "5.00", 2, True), ("O1", "60.00", "Dhl", "5.00", 2, True),
                   ("O2", "0.00", None, "0.00", 0, True), ("O3", "2500.00", "Ups", "7.00", 1, True), ("O4", "0.00", None, "0.00", 0, False)]


def test_daily_sales(loaded):
    got = sorted((str(d.order_date), d.total_orders, d.completed_orders, d.cancelled_orders, d.refunded_orders, str(d.total_revenue),
                  d.total_items_sold, str(d.average_order_value), str(d.total_shipping_cost)) for d in loaded[1].fact_daily_sales.collect())
    assert got == [("2026-01-01", 3, 3, 0, 0, "260.00", 4, "86.67", "10.00"), ("2026-01-02", 2, 1, 1, 0, "2500.00", 1, "2500.00", "7.00")]


def test_customers(loaded):
    rows = {r.customer_id: r for r in loaded[1].dim_customers.collect()}
    assert {i: r.customer_segment for i, r in rows.items()} == {"C1": "returning", "C2": "new", "C3": "inactive"}
    assert (rows["C1"].total_orders, rows["C1"].total_revenue, rows["C1"].full_name) == (2, Decimal("160.00"), "Ann Lee")
    revenue = {r.customer_id: (r.total_orders, r.completed_orders, str(r.total_revenue)) for r in loaded[1].fact_customer_revenue.collect()}
    assert revenue == {"C1": (3, 3, "260.00"), "C2": (2, 1, "2500.00")}


def test_shipping(loaded):
    perf = loaded[1].fact_shipping_performance
    assert {(r.carrier, r.delivery_days, r.is_late) for r in perf.collect()} == {("Dhl", 8.0, True), ("Ups", 2.0, False)}


def test_margins_and_profit(loaded):
    margins = {r.product_id: r.gross_margin_pct for r in marts.dim_products(loaded[1].staged("products")).collect()}
    assert margins == {"P1": Decimal("60.00"), "P2": Decimal("25.00")}
    profit = {r.order_item_id: r.estimated_profit for r in loaded[1].fact_order_items.collect()}
    assert profit == {"I1": Decimal("12.00"), "I2": Decimal("2.50"), "I3": Decimal("30.00")}


def test_rules_find_the_order_paid_twice(loaded):
    rows = {r.check_name: r for r in run_rules(loaded[1], checks.RUNTIME_RULES, datetime(2026, 1, 5)).collect()}
    twice = rows["fact_orders_order_id_unique"]
    assert (twice.check_status, twice.details) == ("failed", "Duplicate order_ids: 1")
    assert rows["stg_shipments_delivered_after_shipped"].details == "Shipments where delivered_at < shipped_at: 0"
    assert [n for n, r in rows.items() if r.check_status == "failed"] == ["fact_orders_order_id_unique"]


def test_ledgers(loaded):
    lake = loaded[0]
    assert lake.source_files().filter("status = 'loaded' and loaded_at >= discovered_at").count() == 7
    runs = lake.ingestion_runs().agg(F.count("*"), F.sum("rows_loaded"), F.count_if(F.col("finished_at") > F.col("started_at"))).first()
    assert tuple(runs) == (7, 18, 7)
