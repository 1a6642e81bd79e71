"""All layers over one set of raw tables, built on first use.

The methods are the dependency graph: asking for a mart builds the staged
tables and the hot-key sets it needs, and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import HotKeys, hot_keys
from ..sources.feed import RawTables
from ..sources.generations import Generations, new_generation
from ..specs import SOURCES
from . import marts
from .staging import stage

# The tables that a build publishes, and the column that their files are in ranges of.
MARTS = {
    "fact_orders": None,
    "fact_order_items": None,
    "fact_daily_sales": "order_date",
    "fact_customer_revenue": None,
    "fact_shipping_performance": None,
    "dim_customers": None,
    "dim_products": None,
}

# Entities that are joined on the order.
_BY_ORDER = ("orders", "payments", "shipments", "order_items")


class Warehouse:
    """With a ``store``, a warehouse is one build: tables are written once, into a generation of their own, and read back.

    That is the way to build all marts: staging feeds several of them, and each
    mart several reports and rules. Others see the marts once ``publish`` has
    been called. Without a store, everything stays a lazy view, and a single
    result computes only the columns and joins it needs. With ``only``, the
    tables named are written and what leads to them stays lazy: the way to build
    one mart, which uses every other table once.
    """

    def __init__(self, raw: Mapping[str, DataFrame], store: Generations | None = None, generation: str | None = None,
                 only: Collection[str] | None = None):
        self.raw = raw
        self.store = store
        self.only = only
        self.generation = generation or new_generation(datetime.now())
        self._tables: dict[str, DataFrame] = {}

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, store: Generations | None = None) -> Warehouse:
        return cls(RawTables(spark, sf_dir), store)

    def _stored(self, name: str) -> bool:
        return self.store is not None and (self.only is None or name in self.only)

    def _once(self, name: str, build: Callable[[], DataFrame], bucket_by: str | None = None) -> DataFrame:
        if name not in self._tables:
            table = build()
            self._tables[name] = self.store.write(
                table, name, self.generation, MARTS.get(name), bucket_by) if self._stored(name) else table
        return self._tables[name]

    def publish(self, at: datetime) -> None:
        """Build all marts and send readers to them, all at once. Staging is not published: it is a set of views."""
        if not self.store or self.only is not None:
            raise ValueError("a warehouse without a store, or with one for some tables only, can't publish all marts")
        for name in MARTS:
            getattr(self, name)
        self.store.publish(self.generation, MARTS, at)

    def create_views(self) -> list[str]:
        """Staging as views over the raw rows, ``stg_orders`` and so on; their names."""
        names = [f"stg_{name}" for name in SOURCES]
        for name in names:
            stage(self.raw[name.removeprefix("stg_")], name.removeprefix("stg_")).createOrReplaceTempView(name)
        return names

    def staged(self, name: str) -> DataFrame:
        return self._once(f"stg_{name}", lambda: stage(self.raw[name], name, self.as_read(name)), self._bucket(name))

    def _bucket(self, name: str) -> str | None:
        """Stored tables that meet on the order are in buckets of it, unless an order fills more than a task with its rows."""
        if not self._stored(f"stg_{name}") or name not in _BY_ORDER:
            return None
        hot = {"payments": "hot_payments", "shipments": "hot_shipments", "order_items": "hot_items"}.get(name)
        return None if hot and getattr(self, hot) else "order_id"

    def __getitem__(self, name: str) -> DataFrame:
        """A table by layer and name: raw.orders, staging.stg_orders, marts.fact_orders."""
        layer, _, table = name.partition(".")
        if layer == "raw":
            return self.raw[table]
        if layer == "staging":
            return self.staged(table.removeprefix("stg_"))
        if layer == "marts":
            return getattr(self, table)
        raise KeyError(name)

    def as_read(self, name: str) -> DataFrame:
        """Raw rows in the partitions they are stored in, to count or look up keys."""
        return getattr(self.raw, "as_read", self.raw.__getitem__)(name)

    def _hot(self, name: str) -> HotKeys:
        # Looked up in the raw rows: that reads one column and needs no
        # deduplication, and the joins treat the answer as a hint only.
        return hot_keys(self.as_read(name), "order_id")

    @cached_property
    def hot_payments(self) -> HotKeys:
        return self._hot("payments")

    @cached_property
    def hot_shipments(self) -> HotKeys:
        return self._hot("shipments")

    @cached_property
    def hot_items(self) -> HotKeys:
        return self._hot("order_items")

    @property
    def fact_orders(self) -> DataFrame:
        return self._once("fact_orders", lambda: marts.fact_orders(
            self.staged("orders"), self.staged("payments"), self.staged("shipments"), self.staged("order_items"),
            self.hot_payments, self.hot_shipments))

    @property
    def sold_items(self) -> DataFrame:
        """``order_id, product_id, line_total`` of every item line: from the mart where it is stored, else from staging."""
        items = self.fact_order_items if self._stored("fact_order_items") else self.staged("order_items")
        return items.select("order_id", "product_id", "line_total")

    @property
    def order_states(self) -> DataFrame:
        """``order_id, is_completed``: from the mart where it is stored, else from staging, without what the mart joins."""
        if self._stored("fact_orders"):
            return self.fact_orders.select("order_id", "is_completed")
        return self.staged("orders").select("order_id", (F.col("order_status") == "completed").alias("is_completed"))

    @property
    def fact_order_items(self) -> DataFrame:
        return self._once("fact_order_items", lambda: marts.fact_order_items(
            self.staged("order_items"), self.staged("products"), self.as_read("order_items"), self.as_read("products")))

    @property
    def fact_daily_sales(self) -> DataFrame:
        return self._once("fact_daily_sales", lambda: marts.fact_daily_sales(self.fact_orders))

    @property
    def fact_customer_revenue(self) -> DataFrame:
        return self._once("fact_customer_revenue", lambda: marts.fact_customer_revenue(
            self.fact_orders, self.dim_customers))

    @property
    def fact_shipping_performance(self) -> DataFrame:
        return self._once("fact_shipping_performance", lambda: marts.fact_shipping_performance(
            self.staged("shipments"), self.staged("orders"), self.hot_shipments))

    @property
    def dim_customers(self) -> DataFrame:
        return self._once("dim_customers", lambda: marts.dim_customers(self.staged("customers"), self.staged("orders")))

    @property
    def dim_products(self) -> DataFrame:
        return self._once("dim_products", lambda: marts.dim_products(self.staged("products")))
