"""Raw retail entities derived from the star-schema test tables.

Every column is a SQL expression that Spark and other ANSI engines read alike,
so a check against another engine starts from the same raw rows. Values carry
the noise staging has to clean: stray blanks, mixed case, repeated keys,
several spellings of "missing".
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..specs import SOURCES, raw_schema


def _id(prefix: str, column: str) -> str:
    return f"'{prefix}'||lpad(cast({column} as string),9,'0')"


def _day(column: str) -> str:
    return f"cast(cast({column} as date) as string)"


def _money(expression: str) -> str:
    return f"cast({expression} as string)"


def _lineage(entity: str, loaded_at: str, extension: str = "csv") -> dict[str, str]:
    name = f"'{entity}_'||{_day(loaded_at)}||'.{extension}'"
    return {
        "_source_file_name": name,
        "_source_file_path": f"'landing/{entity}/'||{name}",
        "_loaded_at": loaded_at,
        "_ingestion_run_id": f"cast(extract(year from {loaded_at}) as bigint)",
    }


# entity -> (base table, row filter, column expressions)
FEED: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "orders": ("orders", None, {
        "order_id": _id("ORD", "o_orderkey"),
        "customer_id": _id("CUST", "o_custkey"),
        "order_date": _day("o_orderdate"),
        "order_status": "case when o_orderstatus='F' then ' Completed' when o_orderstatus='O' then 'PENDING '"
                        " when o_orderkey%2=0 then 'cancelled' else 'Refunded' end",
        "currency": "case when o_orderpriority='1-URGENT' then ' eur' when o_orderpriority='2-HIGH' then 'gbp '"
                    " else 'usd' end",
        "total_amount": _money("o_totalprice"),
        "created_at": "cast(o_orderdate as string)",
        "updated_at": "cast(o_orderdate + interval '36' hour as string)",
        **_lineage("orders", "o_orderdate"),
    }),
    "order_items": ("lineitem", None, {
        "order_item_id": "'ITEM'||lpad(cast(l_orderkey as string),9,'0')||'-'||cast(l_linenumber as string)",
        "order_id": _id("ORD", "l_orderkey"),
        "product_id": _id("PROD", "l_partkey"),
        "quantity": "cast(cast(l_quantity as int) as string)",
        "unit_price": "cast(cast(floor(l_extendedprice / l_quantity) as bigint) as string)",
        "discount_amount": _money("l_discount"),
        "tax_amount": _money("l_tax"),
        "line_total": _money("l_extendedprice"),
        **_lineage("order_items", "l_shipdate", "parquet"),
    }),
    "customers": ("customer", None, {
        "customer_id": _id("CUST", "c_custkey"),
        "first_name": "' '||lower(c_mktsegment)||' '",
        "last_name": "'o''brien-'||upper(c_mktsegment)",
        "email": "' '||replace(c_name,'#','.')||'@Example.COM '",
        "country": "'NATION '||cast(c_nationkey as string)||'-land'",
        "city": "case when c_nationkey=7 then null else 'port '||lower(c_mktsegment) end",
        "created_at": "cast(cast('1995-01-10 08:30:00' as timestamp) + c_nationkey * interval '37' day as string)",
        **_lineage("customers", "cast('1995-01-10 00:00:00' as timestamp)"),
    }),
    "products": ("part", None, {
        "product_id": _id("PROD", "p_partkey"),
        "product_name": "'  '||p_name||' '",
        "category": "lower(p_type)",
        "subcategory": "lower(p_type)||'/size-'||cast(p_size%5 as string)",
        "brand": "upper(p_brand)",
        "cost_price": "cast(p_size as string)",
        "sale_price": "case when p_size=7 then '0' else " + _money("p_retailprice") + " end",
        "is_active": "case when p_size=9 then null when p_size%3=0 then 'True' when p_size%3=1 then ' YES '"
                     " else 'False' end",
        **_lineage("products", "cast('1995-01-10 00:00:00' as timestamp)"),
    }),
    # Every line is shipped on its own, so an order has several shipments.
    "shipments": ("lineitem", None, {
        "shipment_id": "'SHIP'||lpad(cast(l_orderkey as string),9,'0')||'-'||cast(l_linenumber as string)",
        "order_id": _id("ORD", "l_orderkey"),
        "carrier": "case l_suppkey%5 when 0 then 'DHL' when 1 then 'FedEx' when 2 then 'UPS' when 3 then 'USPS'"
                   " else 'local courier' end",
        "shipping_method": "case l_partkey%3 when 0 then 'Standard' when 1 then 'express ' else 'OVERNIGHT' end",
        "shipping_cost": _money("l_discount*100+l_linenumber"),
        "shipped_at": "cast(l_shipdate as string)",
        "delivered_at": "case when l_linestatus='O' then case l_returnflag when 'N' then '' when 'A' then 'None' end"
                        " else cast(l_shipdate + cast(l_quantity as int)*5 * interval '1' hour as string) end",
        "shipment_status": "case when l_linestatus='F' then ' Delivered' when l_returnflag='R' then 'FAILED'"
                           " when l_returnflag='A' then 'In_Transit ' else 'pending' end",
        **_lineage("shipments", "l_shipdate"),
    }),
    # Some orders are paid in two parts, some not at all.
    "payments": ("orders", None, {
        "payment_id": "'PAY'||lpad(cast(o_orderkey as string),9,'0')",
        "order_id": _id("ORD", "o_orderkey - case when o_orderkey%5=4 then 1 else 0 end"),
        "payment_method": "case when o_orderkey%4=0 then 'Credit_Card' when o_orderkey%4=1 then 'paypal '"
                          " when o_orderkey%4=2 then 'GIFT_CARD' else 'bank_transfer' end",
        "payment_status": "case o_orderstatus when 'F' then 'PAID' when 'O' then 'Pending' else ' refunded' end",
        "payment_amount": _money("o_totalprice"),
        "paid_at": "cast(o_orderdate + interval '2' hour as string)",
        **_lineage("payments", "o_orderdate"),
    }),
}


# Base tables that grow with the business, and the columns to deal their rows out by; the others stay small enough for one task.
_LARGE = {"lineitem": ("l_orderkey", "l_linenumber"), "orders": ("o_orderkey",)}


def feed_sql(entity: str) -> str:
    """The entity as one SELECT over the test tables."""
    table, where, columns = FEED[entity]
    body = ", ".join(f"{expression} as {name}" for name, expression in columns.items())
    return f"select {body} from {table}" + (f" where {where}" if where else "")


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def from_feed(rows: DataFrame, entity: str) -> DataFrame:
    """Raw rows of ``entity`` from the rows of its base table."""
    _, where, columns = FEED[entity]
    if where:
        rows = rows.where(where)
    types = {f.name: f.dataType.simpleString() for f in raw_schema(entity).fields}
    return rows.selectExpr(*[f"cast({columns[name]} as {types[name]}) as {name}" for name in types])


class RawTables(Mapping):
    """Raw entities by name; each base table is opened once, when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._bases: dict[str, DataFrame] = {}
        self._entities: dict[str, DataFrame] = {}

    def base(self, table: str) -> DataFrame:
        if table not in self._bases:
            self._bases[table] = read_table(self.spark, self.sf_dir, table)
        return self._bases[table]

    def as_read(self, entity: str) -> DataFrame:
        """The entity in the partitions of its files, for scans of a column or two."""
        return from_feed(self.base(FEED[entity][0]), entity)

    def __getitem__(self, entity: str) -> DataFrame:
        if entity not in self._entities:
            table = FEED[entity][0]
            rows = self.base(table)
            self._entities[entity] = from_feed(self._spread(rows, _LARGE[table]) if table in _LARGE else rows, entity)
        return self._entities[entity]

    def _spread(self, rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
        """Give every core a share of a table that comes in fewer pieces than there are cores.

        A small file is one row group, which one task would read, turn into text
        and sort. Tables of many row groups are left as they are.
        """
        cores = self.spark.sparkContext.defaultParallelism
        if rows.rdd.getNumPartitions() >= cores:
            return rows
        return rows.repartition(cores, *by)

    def __iter__(self):
        return iter(SOURCES)

    def __len__(self):
        return len(SOURCES)


def raw_entity(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return RawTables(spark, sf_dir)[entity]
