"""Source registry: the one description of every entity.

Ingest, header validation, staging, quality rules and the tests all read it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    length: int  # longest text the raw layer accepts
    clean: str  # how staging turns the text into a value, see plans/staging.py
    required: bool = True


@dataclass(frozen=True)
class Source:
    name: str
    extension: str
    key: str
    fields: tuple[Field, ...]

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    @property
    def file_type(self) -> str:
        return self.extension.lstrip(".")

    @property
    def max_row_bytes(self) -> int:
        """Upper bound of one text row (4 bytes per character at most)."""
        return sum(4 * f.length + 16 for f in self.fields)


# Entity columns with their raw text length and staging rule.
_SOURCES = (
    Source("orders", ".csv", "order_id", (
        Field("order_id", 20, "asis"),
        Field("customer_id", 20, "asis"),
        Field("order_date", 20, "date"),
        Field("order_status", 50, "lower"),
        Field("currency", 10, "upper"),
        Field("total_amount", 50, "money"),
        Field("created_at", 50, "timestamp"),
        Field("updated_at", 50, "timestamp"),
    )),
    Source("order_items", ".parquet", "order_item_id", (
        Field("order_item_id", 20, "asis"),
        Field("order_id", 20, "asis"),
        Field("product_id", 20, "asis"),
        Field("quantity", 20, "integer"),
        Field("unit_price", 50, "money"),
        Field("discount_amount", 50, "money"),
        Field("tax_amount", 50, "money"),
        Field("line_total", 50, "money"),
    )),
    Source("customers", ".csv", "customer_id", (
        Field("customer_id", 20, "asis"),
        Field("first_name", 100, "title"),
        Field("last_name", 100, "title"),
        Field("email", 255, "lower"),
        Field("country", 100, "title"),
        Field("city", 100, "title"),
        Field("created_at", 50, "timestamp"),
    )),
    Source("products", ".csv", "product_id", (
        Field("product_id", 20, "asis"),
        Field("product_name", 255, "trim"),
        Field("category", 100, "title"),
        Field("subcategory", 100, "title"),
        Field("brand", 100, "title"),
        Field("cost_price", 50, "money"),
        Field("sale_price", 50, "money"),
        Field("is_active", 10, "flag"),
    )),
    Source("shipments", ".csv", "shipment_id", (
        Field("shipment_id", 20, "asis"),
        Field("order_id", 20, "asis"),
        Field("carrier", 100, "title"),
        Field("shipping_method", 50, "lower"),
        Field("shipping_cost", 50, "money"),
        Field("shipped_at", 50, "timestamp"),
        Field("delivered_at", 50, "optional_timestamp", required=False),
        Field("shipment_status", 50, "lower"),
    )),
    Source("payments", ".csv", "payment_id", (
        Field("payment_id", 20, "asis"),
        Field("order_id", 20, "asis"),
        Field("payment_method", 50, "lower"),
        Field("payment_status", 50, "lower"),
        Field("payment_amount", 50, "money"),
        Field("paid_at", 50, "timestamp"),
    )),
)

SOURCES: dict[str, Source] = {s.name: s for s in _SOURCES}

LINEAGE = T.StructType([
    T.StructField("_source_file_name", T.StringType()),
    T.StructField("_source_file_path", T.StringType()),
    T.StructField("_loaded_at", T.TimestampNTZType()),
    T.StructField("_ingestion_run_id", T.LongType()),
])

SUPPORTED_EXTENSIONS = (".csv", ".parquet")

# CSV cell texts that mean NULL.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Texts that stand for "not delivered yet" after trimming.
NOT_DELIVERED = ("", "None", "null", "NaT")

TRUE_WORDS = ("true", "1", "yes")

# Days a shipment may take before it counts as late.
LATE_AFTER_DAYS = {"overnight": 1, "express": 3, "standard": 7}

HIGH_VALUE_REVENUE = 2000

ORDER_STATUSES = ("completed", "cancelled", "refunded", "pending")
SHIPMENT_STATUSES = ("delivered", "in_transit", "pending", "failed")
PAYMENT_STATUSES = ("paid", "refunded", "pending")

# Allowed states of the metadata and quality tables.
FILE_STATUSES = ("discovered", "validated", "loaded", "failed", "skipped")
RUN_STATUSES = ("running", "success", "failed")
BATCH_STATUSES = ("running", "success", "failed", "partial")
CHECK_STATUSES = ("passed", "failed", "warning")

FRESH_HOURS = 48


def raw_schema(name: str) -> T.StructType:
    """All-text columns followed by the lineage columns."""
    fields = [T.StructField(c, T.StringType()) for c in SOURCES[name].columns]
    return T.StructType(fields + LINEAGE.fields)


def lookup(column: Column, per_source: Callable[[Source], object]) -> Column:
    """A property of the source a column names; NULL for an unknown one."""
    pairs = [F.lit(v) for s in _SOURCES for v in (s.name, per_source(s))]
    return F.try_element_at(F.create_map(*pairs), column)


def source(name: str) -> Source:
    if name not in SOURCES:
        raise ValueError(f"Unknown source name '{name}'. Known: {list(SOURCES)}")
    return SOURCES[name]
