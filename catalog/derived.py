"""File listings, ledger events and deliveries derived from the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.plans.ingest import run_batch
from tallyhouse.session import scratch_path
from tallyhouse.sources.feed import raw_entity
from tallyhouse.sources.lake import Lake
from tallyhouse.specs import SOURCES

Tables = Callable[[str], DataFrame]

_SOURCE = ("case user_id%6 when 0 then 'orders' when 1 then 'order_items' when 2 then 'customers'"
           " when 3 then 'products' when 4 then 'shipments' else 'payments' end")
_FOLDER = f"case when user_id%8=7 then 'returns' else {_SOURCE} end"
_DAY = "cast(cast(ts as date) as string)"

# The SQL below reads alike in Spark and elsewhere; checks share it as input.

# A delivery folder with files to pick up and files to leave alone.
LISTING = f"""select event_id, 'landing/'||{_FOLDER}||case when value > 40 then '/old/' else '/' end
    ||case event_type when 'signup' then {_FOLDER}||'_'||{_DAY}||'.csv'
        when 'view' then '.'||{_FOLDER}||'.csv' when 'purchase' then {_FOLDER}||'_'||{_DAY}||'.CSV'
        when 'error' then {_FOLDER}||'_v2_'||{_DAY}||'.parquet' else {_FOLDER}||'_2024-13-01_notes.csv' end as load_path
    from events"""

# Status changes of files; one user stands for one file.
FILE_EVENTS = f"""select user_id as source_file_id, {_SOURCE} as source_name,
    {_SOURCE}||'_'||cast(user_id as string)||'.csv' as file_name, 'landing/'||cast(user_id as string) as file_path,
    'csv' as file_type, user_id * 100 as file_size_bytes, cast(null as date) as file_date,
    cast(user_id % 50 as string) as checksum, ts as event_at, event_id as event_seq,
    case event_type when 'signup' then 'discovered' when 'view' then 'validated' when 'purchase' then 'loaded'
        when 'error' then 'failed' else 'skipped' end as status,
    case when event_type = 'error' then 'code '||cast(event_id as string) end as error_message from events"""

# Status changes of ingestion runs.
RUN_EVENTS = f"""select user_id as ingestion_run_id, 'daily' as job_id, {_SOURCE} as source_name,
    {_SOURCE}||'.csv' as file_name, ts as event_at, event_id as event_seq,
    case event_type when 'purchase' then 'success' when 'error' then 'failed' else 'running' end as status,
    case when event_type = 'purchase' then cast(floor(value) as bigint) else 0 end as rows_loaded,
    case when event_type = 'error' then 'code '||cast(event_id as string) end as error_message from events"""

# Documents as files: graded ones were loaded (quality 1) or failed (quality 0) before.
DOCUMENT_FILES = """select d.doc_id, d.source as batch_id, d.source||'_'||cast(d.doc_id as string)||'.csv' as file_name,
    d.text, d.n_chars, l.quality from documents d left join labels l on l.doc_id = d.doc_id"""

# Headers as they arrive: some sources unknown, some types unsupported, some columns gone.
HEADERS = """select o_orderkey as file_id, case o_custkey%4 when 0 then 'payments' when 1 then 'products'
    when 2 then 'shipments' else 'refunds' end as source_name,
    'f'||cast(o_orderkey as string)||case o_orderpriority when '1-URGENT' then '.CSV' when '5-LOW' then '.json'
        else '.csv' end as file_name,
    case when o_totalprice < 20000 then 0 else cast(floor(o_totalprice) as bigint) end as file_size_bytes,
    case o_orderstatus when 'F' then 'payment_id,order_id,payment_method,payment_status,payment_amount,paid_at,note'
        when 'O' then 'shipment_id,order_id,carrier,shipping_method,shipping_cost,shipped_at,shipment_status'
        else 'product_id,product_name,category,subcategory,brand,sale_price,is_active' end as header from orders"""


def derived(spark: SparkSession, table: Tables, sql: str, *names: str) -> DataFrame:
    """The SQL over the named test tables, passed in as arguments rather than views."""
    for name in names:
        sql = sql.replace(f" {name} ", f" {{{name}}} ").replace(f" {name}\n", f" {{{name}}}\n")
        if sql.endswith(f" {name}"):
            sql = sql[: -len(name)] + f"{{{name}}}"
    return spark.sql(sql, **{name: table(name) for name in names})


def deliver(spark: SparkSession, sf_dir: str, entities: tuple[str, ...]) -> str:
    """Write raw entities as delivered files and return the landing folder."""
    landing = scratch_path(spark, "landing")
    for entity in entities:
        rows = raw_entity(spark, sf_dir, entity).select(*SOURCES[entity].columns)
        if SOURCES[entity].extension == ".csv":
            rows.write.option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false") \
                .option("ignoreTrailingWhiteSpace", "false").csv(f"{landing}/{entity}")
        else:
            typed = rows.selectExpr(
                "order_item_id", "order_id", "product_id", "cast(quantity as int) as quantity",
                *[f"cast({c} as double) as {c}" for c in ("unit_price", "discount_amount", "tax_amount", "line_total")])
            typed.write.option("compression", "zstd").parquet(f"{landing}/{entity}")
    return landing


def loaded(lake: Lake, landing: str, at: datetime) -> None:
    """One batch of delivered files, which go once it is committed: the lake has their rows, and nothing reads them again.

    A batch that fails leaves them.
    """
    run_batch(lake, landing, at)
    folder = lake.spark._jvm.org.apache.hadoop.fs.Path(landing)
    folder.getFileSystem(lake.spark._jsc.hadoopConfiguration()).delete(folder, True)


def ingested_in_turn(spark: SparkSession, sf_dir: str, *batches: tuple[str, ...]) -> Lake:
    """A new lake with one batch, an hour after the other, for each of the given groups of entities."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    for hour, entities in enumerate(batches, 6):
        loaded(lake, deliver(spark, sf_dir, entities), datetime(2024, 2, 1, hour))
    return lake


def ingested(spark: SparkSession, sf_dir: str, *entities: str) -> Lake:
    """A new lake with the entities delivered and loaded through the whole ingest path."""
    landing = deliver(spark, sf_dir, entities)
    lake = Lake(spark, scratch_path(spark, "lake"))
    loaded(lake, landing, datetime(2024, 2, 1, 6))
    return lake
