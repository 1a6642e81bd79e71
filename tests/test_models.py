"""Staging and mart rules on small hand-made rows."""

from datetime import datetime
from decimal import Decimal

import pytest

from tallyhouse import specs
from tallyhouse.operators.skew import HotKeys
from tallyhouse.plans import marts
from tallyhouse.plans.staging import split_rejects, stage, stage_all

T0 = datetime(2026, 5, 1)


def raw(spark, name, *rows, loaded=T0, run=1, file="f.csv"):
    """Raw rows from dicts; lineage may be overridden per row."""
    schema = specs.raw_schema(name)
    base = {"_source_file_name": file, "_source_file_path": file, "_loaded_at": loaded, "_ingestion_run_id": run}
    return spark.createDataFrame([tuple({**base, **r}.get(c) for c in schema.names) for r in rows], schema)


def order(i, status="completed", amount="100", customer="C1", day="2026-05-01", **more):
    return {"order_id": i, "customer_id": customer, "order_date": day, "order_status": status, "currency": "usd",
            "total_amount": amount, "created_at": "2026-05-01T10:00:00", "updated_at": "2026-05-01T10:00:00", **more}


def shipment(i, order_id, **more):
    return {"shipment_id": i, "order_id": order_id, "carrier": "dHL", "shipping_method": "Standard", "shipping_cost": "5",
            "shipped_at": "2026-05-01T00:00:00", "delivered_at": None, "shipment_status": "delivered", **more}


def payment(i, order_id, amount="100", **more):
    return {"payment_id": i, "order_id": order_id, "payment_method": "PayPal ", "payment_status": "paid",
            "payment_amount": amount, "paid_at": "2026-05-01T00:00:00", **more}


def item(i, order_id, product="P1", qty="2", total="20", **more):
    return {"order_item_id": i, "order_id": order_id, "product_id": product, "quantity": qty, "unit_price": "10",
            "discount_amount": "0", "tax_amount": "0", "line_total": total, **more}


def product(i, cost="4", sale="10", **more):
    return {"product_id": i, "product_name": " Thing ", "category": "non-fiction", "subcategory": "a", "brand": "o'brien",
            "cost_price": cost, "sale_price": sale, "is_active": "True", **more}


def customer(i, **more):
    return {"customer_id": i, "first_name": " ann ", "last_name": "LEE", "email": " A@B.C ", "country": "fr", "city": "x",
            "created_at": "2026-01-01", **more}


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_text_and_types(spark):
    r = one(stage(raw(spark, "orders", order("O1", status="  COMPLETED ", amount="1.005")), "orders"))
    assert (r.order_status, r.currency, r.total_amount) == ("completed", "USD", Decimal("1.01"))
    assert "_ingestion_run_id" not in r.asDict() and r._source_file_name == "f.csv"


def test_newest_row_wins_and_null_key_goes(spark):
    rows = raw(spark, "orders", order("O1", amount="1"), order("O1", amount="2", _loaded_at=datetime(2026, 5, 2)),
               order(None, amount="3"))
    assert one(stage(rows, "orders")).total_amount == 2


def test_missing_load_time_counts_as_newest(spark):
    rows = raw(spark, "orders", order("O1", amount="1", _loaded_at=datetime(2030, 1, 1)), order("O1", amount="2", _loaded_at=None))
    assert one(stage(rows, "orders")).total_amount == 2


def test_ties_go_to_run_then_file_then_content(spark):
    rows = raw(spark, "orders", order("O1", amount="9"), order("O1", amount="1", _ingestion_run_id=2),
               order("O2", amount="9"), order("O2", amount="1", _source_file_name="g.csv"),
               order("O3", amount="9"), order("O3", amount="10"))
    got = {r.order_id: r.total_amount for r in stage(rows, "orders").collect()}
    assert got == {"O1": 1, "O2": 1, "O3": 10}


@pytest.mark.parametrize("text", [None, "", "   ", "None", " null ", "NaT"])
def test_not_delivered(spark, text):
    r = one(stage(raw(spark, "shipments", shipment("S1", "O1", delivered_at=text)), "shipments"))
    assert r.delivered_at is None and r.delivery_days is None and r.carrier == "Dhl"


def test_products(spark):
    rows = raw(spark, "products", product("P1"), product("P2", sale="0"), product("P3", is_active=None),
               product("P4", is_active=" yes "), product("P5", is_active="no"))
    got = {r.product_id: r for r in stage(rows, "products").collect()}
    assert got["P1"].gross_margin_pct == 60 and got["P2"].gross_margin_pct is None
    assert [got[p].is_active for p in ("P1", "P3", "P4", "P5")] == [True, False, True, False]
    assert (got["P1"].category, got["P1"].brand, got["P1"].product_name) == ("Non-Fiction", "O'Brien", "Thing")


def test_full_name_needs_both_parts(spark):
    rows = raw(spark, "customers", customer("C1"), customer("C2", last_name=None))
    got = {r.customer_id: (r.full_name, r.email) for r in stage(rows, "customers").collect()}
    assert got == {"C1": ("Ann Lee", "a@b.c"), "C2": (None, "a@b.c")}


def test_bad_cast_fails_or_is_set_aside(spark):
    rows = raw(spark, "order_items", item("I1", "O1"), item("I2", "O1", qty="3.0"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(rows, "order_items").collect()
    good, bad = split_rejects(rows, "order_items")
    assert one(stage(good, "order_items")).order_item_id == "I1"
    assert one(bad)._bad_columns == ["quantity"]
    shipped = raw(spark, "shipments", shipment("S1", "O1", delivered_at="None"))
    assert split_rejects(shipped, "shipments")[1].count() == 0


@pytest.fixture(scope="module")
def staged(spark):
    return stage_all({
        "orders": raw(spark, "orders", order("O1"), order("O2", status="pending", customer="C2"),
                      order("O3", status=None, customer=None), order("O4", amount="2500", customer="C3"),
                      order("O5", amount="1000", customer="C4"), order("O6", amount="1000", customer="C4"),
                      order("O7", amount="1", customer="C5"), order("O8", amount="1", customer="C5")),
        "payments": raw(spark, "payments", payment("P1", "O1", "60"), payment("P2", "O1", "40")),
        "shipments": raw(
            spark, "shipments", shipment("S1", "O1"), shipment("S2", "O1"),
            shipment("S3", "O4", shipping_method="overnight", delivered_at="2026-05-02T00:00:00"),
            shipment("S4", "O4", shipping_method="overnight", delivered_at="2026-05-02T00:00:01"),
            shipment("S5", "O5", shipping_method="EXPRESS", delivered_at="2026-05-04T00:00:00"),
            shipment("S6", "O5", shipping_method="express", delivered_at="2026-05-04T00:00:01"),
            shipment("S7", "nowhere", delivered_at="2026-05-08T00:00:00"),
            shipment("S8", None, delivered_at="2026-05-08T00:00:01"),
            shipment("S9", "O6", shipping_method="drone", delivered_at="2027-05-08T00:00:01")),
        "order_items": raw(spark, "order_items", item("I1", "O1"), item("I2", "O1", product="gone"), item("I3", "O4", total="33.33")),
        "products": raw(spark, "products", product("P1", cost="3.335")),
        "customers": raw(spark, "customers", *[customer(f"C{i}") for i in range(1, 7)]),
    })


HOT = HotKeys(("O1", "O4", "O5"))


@pytest.mark.parametrize("hot_payments,hot_shipments", [(HotKeys(), HotKeys()), (HOT, HOT), (HotKeys(("O1",)), HotKeys())])
def test_fact_orders_fan_out(staged, hot_payments, hot_shipments):
    facts = marts.fact_orders(staged["orders"], staged["payments"], staged["shipments"], staged["order_items"],
                              hot_payments, hot_shipments)
    rows = facts.collect()
    by_order = {o: [r for r in rows if r.order_id == o] for o in ("O1", "O2", "O3", "O4", "O5", "O6")}
    assert {o: len(r) for o, r in by_order.items()} == {"O1": 4, "O2": 1, "O3": 1, "O4": 2, "O5": 2, "O6": 1}
    assert sorted(r.payment_amount for r in by_order["O1"]) == [40, 40, 60, 60]
    lonely = by_order["O2"][0]
    assert (lonely.payment_amount, lonely.shipping_cost, lonely.total_items, lonely.carrier) == (0, 0, 0, None)
    assert by_order["O1"][0].total_items == 2
    assert by_order["O3"][0].is_completed is None


def test_daily_sales_counts_fanned_rows(staged):
    facts = marts.fact_orders(*(staged[n] for n in ("orders", "payments", "shipments", "order_items")))
    day = one(marts.fact_daily_sales(facts))
    assert (day.total_orders, day.completed_orders, day.cancelled_orders) == (13, 11, 0)
    assert day.total_revenue == 4 * 100 + 2 * 2500 + 2 * 1000 + 1000 + 2


def test_item_profit(staged):
    rows = {r.order_item_id: r for r in marts.fact_order_items(staged["order_items"], staged["products"]).collect()}
    assert (rows["I1"].estimated_cost, rows["I1"].estimated_profit) == (Decimal("6.68"), Decimal("13.32"))
    assert rows["I2"].estimated_cost is None and rows["I2"].estimated_profit is None


@pytest.mark.parametrize("hot", [HotKeys(), HotKeys(("O4", "nowhere"), null=True)])
def test_late_is_strictly_more(staged, hot):
    rows = marts.fact_shipping_performance(staged["shipments"], staged["orders"], hot).collect()
    assert {r.shipment_id: r.is_late for r in rows} == {
        "S1": False, "S2": False, "S3": False, "S4": True, "S5": False, "S6": True, "S7": False, "S8": True, "S9": False}
    assert {r.shipment_id for r in rows if r.order_date is None} == {"S7", "S8"}


def test_segments(staged):
    dim = {r.customer_id: r for r in marts.dim_customers(staged["customers"], staged["orders"]).collect()}
    assert {c: r.customer_segment for c, r in dim.items()} == {
        "C1": "new", "C2": "inactive", "C3": "new", "C4": "high_value", "C5": "returning", "C6": "inactive"}
    assert (dim["C6"].total_orders, dim["C6"].total_revenue) == (0, 0)


def test_customer_revenue(staged):
    facts = marts.fact_orders(*(staged[n] for n in ("orders", "payments", "shipments", "order_items")))
    dim = marts.dim_customers(staged["customers"], staged["orders"])
    rows = {r.customer_id: r for r in marts.fact_customer_revenue(facts, dim).collect()}
    assert set(rows) == {"C1", "C2", "C3", "C4", "C5", None}  # C6 has no order
    assert (rows["C2"].total_revenue, rows["C2"].avg_order_value, rows["C2"].customer_segment) == (None, None, "inactive")
    assert rows[None].full_name is None and rows[None].total_orders == 1
    assert rows["C1"].total_orders == 4  # two payments times two shipments
