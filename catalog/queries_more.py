"""Queries of ingest, ledgers, scalar functions, quality rules and reports."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import file_date, file_extension, file_stem, hours_between, title_words
from tallyhouse.operators import ledger, quality, states
from tallyhouse.operators.skew import HotKeys, spread_join
from tallyhouse.plans import checks, reports
from tallyhouse.plans.ingest import run_batch
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.session import prepare, scratch_path
from tallyhouse.sources.generations import Generations
from tallyhouse.sources.lake import Lake
from tallyhouse.sources.manifest import checksum, csv_header, dated, recognise, validated
from tallyhouse.specs import SOURCES
from tallyhouse.streaming.pickup import pick_up_available

from . import derived as d
from .queries import QUERIES, present, query, table_query

Tables = Callable[[str], DataFrame]
AS_OF = datetime(1999, 6, 30, 12, 0)


def folder_query(name: str):
    """Register ``f(spark, sf_dir)``: the query delivers files of its own."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: present(build(prepare(spark), sf_dir))
        return build

    return register


# Ingest


@table_query("i1_recognised_files")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    found = recognise(d.derived(spark, table, d.LISTING, "events"), "landing")
    return found.select("event_id", "source_name", "file_name")


@table_query("i2_content_checksum")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    return table("documents").select("doc_id", checksum(F.col("text").cast("binary")).alias("checksum"))


@table_query("i3_not_yet_loaded")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    files = d.derived(spark, table, d.DOCUMENT_FILES, "documents", "labels").withColumn(
        "checksum", checksum(F.col("text").cast("binary")))
    known = files.filter("quality is not null").select(
        "checksum", F.when(F.col("quality") == 1, "loaded").otherwise("failed").alias("status"))
    return ledger.not_yet_loaded(files.select("doc_id", "checksum"), known)


@table_query("i4_file_date")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    listing = d.derived(spark, table, d.LISTING, "events").withColumn("file_name", F.substring_index("load_path", "/", -1))
    return dated(listing).select("event_id", "file_type", "file_date")


@table_query("i5_header_validation")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    files = d.derived(spark, table, d.HEADERS, "orders").withColumn("file_columns", csv_header(F.col("header")))
    return validated(files).select(
        "file_id", "is_valid", F.array_join("missing_columns", ",").alias("missing"), "validation_error")


@folder_query("i6_csv_load")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = d.ingested(spark, sf_dir, "shipments")
    return lake.raw("shipments").select(*SOURCES["shipments"].columns)


@folder_query("i7_parquet_load")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = d.ingested(spark, sf_dir, "order_items")
    return lake.raw("order_items").select(*SOURCES["order_items"].columns)


@folder_query("i8_raw_append")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source as the ledger has them and as the raw tables do."""
    lake = d.ingested(spark, sf_dir, "customers", "orders", "products", "payments")
    counts = None
    for name in ("customers", "orders", "products", "payments"):
        part = lake.raw(name).agg(F.count("*").alias("raw_rows")).withColumn("source_name", F.lit(name))
        counts = part if counts is None else counts.unionByName(part)
    recorded = lake.ingestion_runs().groupBy("source_name").agg(
        F.sum("rows_loaded").alias("recorded_rows"), F.count_if(F.col("status") != "success").alias("open_runs"))
    return recorded.join(counts, "source_name")


@table_query("i9_source_file_states")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    found = ledger.file_states(d.derived(spark, table, d.FILE_EVENTS, "events"))
    return found.select("source_file_id", "source_name", "status", "error_message", "discovered_at", "loaded_at")


@table_query("i10_ingestion_run_states")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    return ledger.run_states(d.derived(spark, table, d.RUN_EVENTS, "events"))


def _document_outcomes(spark: SparkSession, table: Tables) -> DataFrame:
    files = d.derived(spark, table, d.DOCUMENT_FILES, "documents", "labels")
    return ledger.outcomes(files.withColumns({
        "validation_error": F.when(F.col("n_chars") < 200, "File is too short"),
        "load_error": F.when(F.col("quality") == 0, "bad rows"),
        "rows_loaded": F.col("n_chars"),
    }))


@table_query("i11_file_outcomes")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    result = _document_outcomes(spark, table)
    name = ledger.archive_name(F.col("file_name"), F.col("run_status").isNull(), F.lit(AS_OF).cast("timestamp_ntz"))
    return result.select("doc_id", "status", "run_status", "error", "rows_loaded", "disposition", name.alias("target"))


@table_query("i12_batch_rollup")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    return ledger.batch_rollup(_document_outcomes(spark, table).withColumn(
        "status", F.when(F.col("quality").isNull() & (F.col("n_chars") > 1000), "skipped").otherwise(F.col("status"))))


@folder_query("i13_incremental_pickup")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two calls over one folder: the second finds nothing new."""
    landing = d.deliver(spark, sf_dir, ("orders", "payments"))
    lake, progress = Lake(spark, scratch_path(spark, "lake")), scratch_path(spark, "progress")
    for _ in range(2):
        pick_up_available(lake, landing, progress)
    runs = lake.ingestion_runs()
    return runs.groupBy("source_name", "status").agg(F.sum("rows_loaded").alias("rows_loaded"))


@folder_query("i14_published_mart")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two builds of a mart, of which the first lacks the newest orders: readers follow the pointer to the second."""
    store = Generations(spark, scratch_path(spark, "marts"))
    tables = Warehouse.from_tables(spark, sf_dir).raw
    older = tables["orders"].filter("order_date < '1997-01-01'")
    for day, raw in enumerate((dict(tables) | {"orders": older}, tables), 1):
        house = Warehouse(raw, store, only=("fact_daily_sales",))
        store.write(house.fact_daily_sales.drop("total_shipping_cost"), "sales_without_shipping", house.generation)
        store.publish(house.generation, ["fact_daily_sales", "sales_without_shipping"], datetime(2024, 2, day))
    costs = store.read("fact_daily_sales").select("order_date", "total_shipping_cost")
    return store.read("sales_without_shipping").join(costs, "order_date")


@folder_query("i15_staging_views")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging asked for as views, in SQL."""
    Warehouse.from_tables(spark, sf_dir).create_views()
    return spark.sql("""select o.currency, p.payment_method, count(*) as payments, sum(p.payment_amount) as paid
        from stg_orders o join stg_payments p on p.order_id = o.order_id group by o.currency, p.payment_method""")


@folder_query("i16_overlapping_batches")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches at the same time, then one that finds all their files again: ledgers of a real lake, per source.

    ``repeated_numbers`` counts file and run numbers given out twice, ``unlike_counts`` batches whose files don't add up,
    ``targets_taken_twice`` names in the archive that two files go to.
    """
    lake = Lake(spark, scratch_path(spark, "lake"))
    landings = [d.deliver(spark, sf_dir, entities) for entities in (("orders", "customers"), ("payments", "products"))]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda landing: run_batch(lake, landing, datetime(2024, 2, 1, 6)), landings))
    for landing in landings:
        run_batch(lake, landing, datetime(2024, 2, 1, 7))
    files, runs, batches = lake.source_files(), lake.ingestion_runs(), lake.pipeline_runs()
    twice = files.select(F.col("source_file_id").alias("n")).groupBy("n").count().unionByName(
        runs.select(F.col("ingestion_run_id").alias("n")).groupBy("n").count()).agg(F.count_if(F.col("count") > 1).alias("repeated_numbers"))
    sums = F.col("files_loaded") + F.col("files_failed") + F.col("files_skipped")
    unlike = batches.agg(F.count_if(F.col("files_discovered") != sums).alias("unlike_counts"),
                         F.sum("files_loaded").alias("loaded"), F.sum("files_skipped").alias("skipped"), F.count("*").alias("batches"))
    targets = lake.outcomes().filter("target is not null").groupBy("disposition", "target").count().agg(
        F.count_if(F.col("count") > 1).alias("targets_taken_twice"))
    per_source = runs.groupBy("source_name").agg(F.sum("rows_loaded").alias("rows_loaded"), F.count_if(F.col("status") != "success").alias("open_runs"))
    # One row each.
    return per_source.join(F.broadcast(twice), F.lit(True)).join(F.broadcast(unlike), F.lit(True)).join(
        F.broadcast(targets), F.lit(True)).select("source_name", "rows_loaded", "open_runs", "repeated_numbers", "unlike_counts",
                                                  "batches", (F.col("loaded") == F.col("skipped")).alias("all_found_again"),
                                                  "targets_taken_twice")


@table_query("j8_loaded_checksum_lookup")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    known = ledger.file_states(d.derived(spark, table, d.FILE_EVENTS, "events"))
    files = table("events").select("event_id", F.expr("cast(event_id % 60 as string)").alias("checksum"))
    return ledger.not_yet_loaded(files, known)


# Scalar functions


@table_query("f1_text_functions")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    noisy = F.concat(F.lit("  "), F.col("c_name"), F.lit("-"), F.lower("c_mktsegment"), F.lit("'s  "))
    return table("customer").select(
        "c_custkey", F.trim(noisy).alias("trimmed"), F.lower(F.trim(noisy)).alias("lowered"),
        F.upper(F.trim(noisy)).alias("uppered"), title_words(F.trim(noisy)).alias("titled"))


@table_query("f2_file_name_parts")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    name = F.substring_index("load_path", "/", -1)
    return d.derived(spark, table, d.LISTING, "events").select(
        "event_id", file_stem(name).alias("stem"), file_extension(name).alias("extension"),
        file_date(name).alias("file_date"))


@table_query("f3_age_in_hours")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    now = F.lit(datetime(2024, 2, 1)).cast("timestamp_ntz")
    return table("events").select("event_id", hours_between(F.col("ts"), now).alias("hours"))


# Quality


def _shown(results: DataFrame) -> DataFrame:
    return results.select("check_name", "table_name", "column_name", "check_type", "check_status", "failed_row_count", "details")


def _with_missing(w: Warehouse) -> dict[str, DataFrame]:
    """The raw tables with some order item and payment keys taken out."""
    tables = {rule.table: w[rule.table] for rule in checks.RAW_KEYS}
    tables["raw.order_items"] = tables["raw.order_items"].withColumn(
        "order_item_id", F.when(F.col("quantity") != "1", F.col("order_item_id")))
    tables["raw.payments"] = tables["raw.payments"].withColumn(
        "payment_id", F.when(~F.col("payment_method").startswith("GIFT"), F.col("payment_id")))
    return tables


@query("q1_row_counts")
def _(w: Warehouse) -> DataFrame:
    return _shown(quality.run_rules(w, checks.RAW_HAS_ROWS, AS_OF))


@query("q2_null_keys")
def _(w: Warehouse) -> DataFrame:
    return _shown(quality.run_rules(_with_missing(w), checks.RAW_KEYS, AS_OF))


@query("q3_duplicate_keys")
def _(w: Warehouse) -> DataFrame:
    rules = [*checks.ORDER_UNIQUE, quality.unique("raw.order_items", "order_item_id")]
    return _shown(quality.run_rules(w, rules, AS_OF))


@query("q4_negative_amounts")
def _(w: Warehouse) -> DataFrame:
    tables = {t: w[t] for t in ("marts.fact_orders", "marts.fact_order_items")}
    tables |= {"customer": w.raw.base("customer"), "supplier": w.raw.base("supplier")}
    rules = [*checks.AMOUNTS, quality.not_negative("customer", "c_acctbal"), quality.not_negative("supplier", "s_acctbal")]
    return _shown(quality.run_rules(tables, rules, AS_OF))


@query("q5_date_order")
def _(w: Warehouse) -> DataFrame:
    rules = [checks.DATES[0], quality.not_before("marts.fact_shipping_performance", "shipped_at", "order_date")]
    return _shown(quality.run_rules(w, rules, AS_OF))


@query("q6_future_dates")
def _(w: Warehouse) -> DataFrame:
    return _shown(quality.run_rules(w, [checks.DATES[1]], AS_OF))


@query("q7_freshness")
def _(w: Warehouse) -> DataFrame:
    tables = [("raw", "orders"), ("raw", "order_items"), ("staging", "stg_orders"), ("marts", "fact_orders"),
              ("marts", "fact_daily_sales")]
    return quality.freshness([(s, t, w[f"{s}.{t}"]) for s, t in tables], datetime(2001, 11, 5, 6, 20))


@query("q8_quality_results")
def _(w: Warehouse) -> DataFrame:
    return quality.run_rules(w, checks.RUNTIME_RULES, AS_OF)


def _usual_counts(table: Tables) -> DataFrame:
    events = table("events").select("event_type", "ts")
    per_day = events.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    usual = per_day.filter("event_type <> 'click'").groupBy(F.col("event_type").alias("table_name")).agg(
        F.floor(F.sum("n") / F.count("*")).alias("expected_min_rows"))
    return quality.row_count_history(events, F.col("event_type"), F.col("ts"), usual, AS_OF)


@table_query("q9_row_count_history")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    return _usual_counts(table)


@query("q10_model_keys_unique")
def _(w: Warehouse) -> DataFrame:
    return _shown(quality.run_rules(w, checks.MODEL_UNIQUE, AS_OF))


@query("q11_model_columns_present")
def _(w: Warehouse) -> DataFrame:
    return _shown(quality.run_rules(w, checks.MODEL_NOT_NULL, AS_OF))


@query("q12_model_accepted_values")
def _(w: Warehouse) -> DataFrame:
    strict = quality.accepted_values("marts.fact_orders", "currency", ("USD", "EUR"))
    return _shown(quality.run_rules(w, [*checks.MODEL_ACCEPTED, strict], AS_OF))


@folder_query("q14_merged_states")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of raw tables from what two batches stored, without reading the rows."""
    lake = d.ingested_in_turn(spark, sf_dir, ("customers", "orders", "payments"), ("products",))
    names = ("customers", "orders", "payments", "products")
    tables = [f"raw.{n}" for n in names]
    rules = [r for r in (*checks.RAW_HAS_ROWS, *checks.RAW_KEYS) if r.table in tables]
    results = _shown(states.rules_from_states(lake.table_states(), rules, AS_OF))
    ages = states.freshness_from_states(lake.table_states(), tables, datetime(2024, 2, 4, 6))
    return results.join(ages.select(F.concat_ws(".", "schema_name", "table_name").alias("table_name"), "row_count", "is_fresh",
                                    "staleness_hours"), "table_name")


@folder_query("q15_recorded_checks")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of a lake run and recorded, and read back."""
    lake = d.ingested_in_turn(spark, sf_dir, tuple(SOURCES))
    expected = spark.createDataFrame([("raw.orders", 1), ("raw.payments", 10**9)], "table_name string, expected_min_rows long")
    checks.run_checks(lake, Warehouse(lake.raw_tables()), expected, AS_OF)
    days = lake.quality("row_counts").select(F.lit("row_counts").alias("kind"), F.col("table_name").alias("name"),
                                             "check_status", F.col("actual_row_count").alias("n"))
    ages = lake.quality("freshness").select(F.lit("freshness"), "table_name", F.col("is_fresh").cast("string"), "row_count")
    return days.union(ages).union(lake.quality("results").select(F.lit("results"), "check_name", "check_status", "failed_row_count"))


@table_query("q13_ledger_statuses")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    tables = {
        "metadata.source_files": ledger.file_states(d.derived(spark, table, d.FILE_EVENTS, "events")),
        "metadata.ingestion_runs": ledger.run_states(d.derived(spark, table, d.RUN_EVENTS, "events")),
        "metadata.pipeline_runs": ledger.batch_rollup(_document_outcomes(spark, table)),
        "quality.row_count_checks": _usual_counts(table),
    }
    stated = [quality.accepted_values("metadata.source_files", "status", ("discovered", "loaded")),
              quality.accepted_values("metadata.pipeline_runs", "status", ("success",)),
              quality.accepted_values("quality.row_count_checks", "check_status", ("passed", "warning"))]
    tables["quality.data_quality_results"] = quality.run_rules(tables, stated, AS_OF)
    strict = quality.accepted_values("quality.data_quality_results", "check_status", ("passed",))
    return _shown(quality.run_rules(tables, [*checks.LEDGER_RULES, *stated, strict], AS_OF))


# Reports

def _recorded(w: Warehouse) -> Lake:
    """A lake to which two runs of checks were written, one after the other."""
    spark = w["raw.orders"].sparkSession
    lake = Lake(spark, scratch_path(spark, "quality"))
    lake.record_quality("results", quality.run_rules(w, checks.RAW_KEYS, AS_OF))
    lake.record_quality("results", quality.run_rules(w, [*checks.MODEL_ACCEPTED, *checks.DATES], AS_OF))
    return lake


_MART_REPORTS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "d1_total_revenue": lambda w: reports.total_revenue(w.fact_daily_sales),
    "d2_total_orders": lambda w: reports.total_orders(w.fact_orders),
    "d3_average_order_value": lambda w: reports.average_order_value(w.fact_orders),
    "d4_revenue_by_day": lambda w: reports.revenue_by_day(w.fact_daily_sales),
    "d5_orders_by_day": lambda w: reports.orders_by_day(w.fact_daily_sales),
    "d6_revenue_by_category": lambda w: reports.revenue_by_category(w.sold_items, w.order_states, w.dim_products),
    "d7_top_products": lambda w: reports.top_products(w.sold_items, w.order_states, w.dim_products),
    "d8_total_customers": lambda w: reports.total_customers(w.dim_customers),
    "d9_customers_by_segment": lambda w: reports.customers_by_segment(w.dim_customers),
    "d10_top_customers": lambda w: reports.top_customers(w.fact_customer_revenue),
    "d11_revenue_by_country": lambda w: reports.revenue_by_country(w.fact_customer_revenue),
    "d12_new_customers_by_month": lambda w: reports.new_customers_by_month(w.dim_customers),
    "d13_average_delivery_days": lambda w: reports.average_delivery_days(w.fact_shipping_performance),
    "d14_late_shipments": lambda w: reports.late_shipments(w.fact_shipping_performance),
    "d15_delivery_days_by_carrier": lambda w: reports.delivery_days_by_carrier(w.fact_shipping_performance),
    "d16_late_by_carrier": lambda w: reports.late_by_carrier(w.fact_shipping_performance),
    "d17_shipment_statuses": lambda w: reports.shipment_statuses(w.fact_shipping_performance),
    "d18_shipping_cost_by_day": lambda w: reports.shipping_cost_by_day(w.fact_shipping_performance),
    "d22_checks_by_status": lambda w: reports.checks_by_status(_recorded(w).quality("results")),
}
for _name, _build in _MART_REPORTS.items():
    query(_name)(_build)


@table_query("d19_files_loaded_on_day")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    return reports.files_loaded_on(ledger.file_states(d.derived(spark, table, d.FILE_EVENTS, "events")), date(2024, 1, 30))


@table_query("d20_failed_files")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    return reports.failed_files(ledger.file_states(d.derived(spark, table, d.FILE_EVENTS, "events")))


@table_query("d21_rows_by_source")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    return reports.rows_by_source(ledger.run_states(d.derived(spark, table, d.RUN_EVENTS, "events")))


@table_query("d23_run_listing")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    return reports.run_listing(ledger.run_states(d.derived(spark, table, d.RUN_EVENTS, "events")))


# Joins with hot keys on both sides of a fan-out, sliced by hint


def _by_nation(table: Tables, name: str, key: str) -> DataFrame:
    prefix = name[0]
    rows = table(name).select(key, F.col(f"{prefix}_nationkey").cast("string").alias("nation"))
    return rows.filter("nation <> '3'") if name == "supplier" else rows


_HOT_LEFT = HotKeys(("1", "3", "7"), True, (8, 4, 2), 4)
_HOT_RIGHT = HotKeys(("1", "3", "12"), False, (4, 8, 2))


@table_query("j11_hot_keys_left_join")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    return spread_join(_by_nation(table, "customer", "c_custkey"), _by_nation(table, "supplier", "s_suppkey"), "nation", "left",
                       _HOT_LEFT, _HOT_RIGHT, fan_out=True)


@table_query("j12_hot_keys_inner_join")
def _(spark: SparkSession, table: Tables) -> DataFrame:
    return spread_join(_by_nation(table, "supplier", "s_suppkey"), _by_nation(table, "customer", "c_custkey"), "nation", "inner",
                       _HOT_RIGHT, _HOT_LEFT, fan_out=True)
