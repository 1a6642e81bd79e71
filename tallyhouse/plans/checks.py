"""The quality rules of the warehouse, and the plan that runs and records them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame

from ..operators.quality import (
    Rule, accepted_values, has_rows, judged_counts, not_before, not_future, not_negative, not_null, run_rules, unique,
)
from ..operators.states import counts_by_day, freshness_from_states, rules_from_states
from ..sources.lake import Lake
from ..specs import (
    BATCH_STATUSES, CHECK_STATUSES, FILE_STATUSES, ORDER_STATUSES, PAYMENT_STATUSES, RUN_STATUSES,
    SHIPMENT_STATUSES, SOURCES,
)

RAW_HAS_ROWS = [has_rows(f"raw.{s}") for s in SOURCES]
RAW_KEYS = [not_null(f"raw.{s.name}", s.key) for s in SOURCES.values()]
# The names and texts under which these results are known.
ORDER_UNIQUE = [replace(unique("marts.fact_orders", "order_id"), name="fact_orders_order_id_unique",
                        label="Duplicate order_ids: ")]
AMOUNTS = [
    not_negative("marts.fact_orders", "total_amount"),
    not_negative("marts.fact_orders", "payment_amount"),
    not_negative("marts.fact_orders", "shipping_cost"),
    not_negative("marts.fact_order_items", "line_total"),
]
DATES = [
    replace(not_before("staging.stg_shipments", "delivered_at", "shipped_at"), name="stg_shipments_delivered_after_shipped",
            label="Shipments where delivered_at < shipped_at: "),
    replace(not_future("staging.stg_orders", "order_date"), name="stg_orders_order_date_not_future",
            label="Future order dates: "),
]
RUNTIME_RULES: list[Rule] = [*RAW_HAS_ROWS, *RAW_KEYS, *ORDER_UNIQUE, *AMOUNTS, *DATES]

# Model, its key (unique and present), further columns that must be present.
_MODEL_KEYS = (
    ("staging.stg_orders", "order_id", ("customer_id", "total_amount")),
    ("staging.stg_order_items", "order_item_id", ("order_id", "product_id", "quantity")),
    ("staging.stg_customers", "customer_id", ("email",)),
    ("staging.stg_products", "product_id", ()),
    ("staging.stg_shipments", "shipment_id", ("order_id",)),
    ("staging.stg_payments", "payment_id", ("order_id",)),
    ("marts.fact_orders", "order_id", ("customer_id", "total_amount")),
    ("marts.fact_order_items", "order_item_id", ("order_id", "product_id")),
    ("marts.fact_daily_sales", "order_date", ()),
    ("marts.fact_customer_revenue", "customer_id", ()),
    ("marts.fact_shipping_performance", "shipment_id", ()),
    ("marts.dim_customers", "customer_id", ()),
    ("marts.dim_products", "product_id", ()),
)

MODEL_UNIQUE = [unique(model, key) for model, key, _ in _MODEL_KEYS]
MODEL_NOT_NULL = [not_null(model, c) for model, key, more in _MODEL_KEYS for c in (key, *more)]
MODEL_ACCEPTED = [
    accepted_values("staging.stg_orders", "order_status", ORDER_STATUSES),
    accepted_values("staging.stg_shipments", "shipment_status", SHIPMENT_STATUSES),
    accepted_values("staging.stg_payments", "payment_status", PAYMENT_STATUSES),
    accepted_values("marts.fact_orders", "order_status", ORDER_STATUSES),
]
MODEL_RULES: list[Rule] = [*MODEL_UNIQUE, *MODEL_NOT_NULL, *MODEL_ACCEPTED]

LEDGER_RULES = [
    accepted_values("metadata.source_files", "status", FILE_STATUSES),
    accepted_values("metadata.ingestion_runs", "status", RUN_STATUSES),
    accepted_values("metadata.pipeline_runs", "status", BATCH_STATUSES),
    accepted_values("quality.data_quality_results", "check_status", CHECK_STATUSES),
    accepted_values("quality.row_count_checks", "check_status", CHECK_STATUSES),
]


def run_checks(lake: Lake, tables: Mapping[str, DataFrame], expected_min: DataFrame, as_of: datetime) -> None:
    """Run all checks and append what they found to the quality tables of the lake.

    Raw tables are judged by the states stored with their batches, without reading them. ``tables`` has the
    staged and built tables by layer and name; ``expected_min`` the least rows a day (table_name, expected_min_rows).
    """
    states = lake.table_states()
    ledgers = {"metadata.source_files": lake.source_files(), "metadata.ingestion_runs": lake.ingestion_runs(),
               "metadata.pipeline_runs": lake.pipeline_runs()}
    rows = [rules_from_states(states, [*RAW_HAS_ROWS, *RAW_KEYS], as_of),
            run_rules(tables, [*ORDER_UNIQUE, *AMOUNTS, *DATES], as_of),
            run_rules(ledgers, [r for r in LEDGER_RULES if r.table in ledgers], as_of)]
    for found in rows:
        lake.record_quality("results", found)
    lake.record_quality("freshness", freshness_from_states(states, [f"raw.{s}" for s in SOURCES], as_of))
    lake.record_quality("row_counts", judged_counts(counts_by_day(states), expected_min, as_of))
