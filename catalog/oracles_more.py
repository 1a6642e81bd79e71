"""Expected results of ingest, ledgers, scalar functions, quality rules and reports."""

from __future__ import annotations

from . import derived as d
from .oracles import CTES, ORACLES, _title, exact_mean, shown

CTES |= {
    "listing": d.LISTING,
    "file_events": d.FILE_EVENTS,
    "run_events": d.RUN_EVENTS,
    "document_files": d.DOCUMENT_FILES,
    "headers": d.HEADERS,
    "listed_names": "select event_id, load_path, string_split(load_path, '/')[-1] as file_name from listing",
    "name_parts": """select event_id, file_name, regexp_replace(file_name, '([^.])\\.[^.]*$', '\\1') as stem,
        lower(regexp_extract(file_name, '[^.](\\.[^.]*)$', 1)) as extension from listed_names""",
    "name_dates": """select event_id, file_name, stem, extension, list_filter(
        list_transform(string_split(stem, '_'), lambda p: case when regexp_full_match(p, '\\d{4}-\\d{1,2}-\\d{1,2}')
        then try_cast(p as date) end), lambda x: x is not null)[1] as file_date from name_parts""",
    "document_outcomes": """select *, case when n_chars < 200 then 'File is too short' end as invalid,
        case when n_chars < 200 then 'File is too short' when quality = 0 then 'bad rows' end as error
        from document_files""",
    "source_file_states": """select source_file_id, max_by(source_name, (event_at, event_seq)) as source_name,
        arg_max_null(status, (event_at, event_seq)) as status,
        arg_max_null(error_message, (event_at, event_seq)) as error_message, max_by(checksum, (event_at, event_seq)) as checksum,
        min(event_at) as discovered_at, max(event_at) filter (where status = 'loaded') as loaded_at
        from file_events group by source_file_id""",
    "ingestion_run_states": """select ingestion_run_id, max_by(job_id, (event_at, event_seq)) as job_id,
        max_by(source_name, (event_at, event_seq)) as source_name, max_by(file_name, (event_at, event_seq)) as file_name,
        min(event_at) as started_at,
        case when max_by(status, (event_at, event_seq)) <> 'running' then max(event_at) end as finished_at,
        max_by(rows_loaded, (event_at, event_seq)) as rows_loaded, max_by(status, (event_at, event_seq)) as status,
        arg_max_null(error_message, (event_at, event_seq)) as error_message from run_events group by ingestion_run_id""",
    "document_batches": """select source as batch_id, count(*) as files_discovered from documents group by 1""",
}

_TOKENS = ("('','#N/A','#N/A N/A','#NA','-1.#IND','-1.#QNAN','-NaN','-nan','1.#IND','1.#QNAN','<NA>','N/A','NA',"
           "'NULL','NaN','None','n/a','nan','null')")


def _csv(column: str) -> str:
    return f"case when {column} not in {_TOKENS} then {column} end as {column}"


# file 1 of its batch and source, hence run 1 .. n; the run is shown by the query, so count files by it
ORACLES |= {
    "i1_recognised_files": """select event_id, string_split(load_path, '/')[2] as source_name, file_name
        from listed_names where len(string_split(load_path, '/')) = 3 and not starts_with(file_name, '.')
        and ((string_split(load_path, '/')[2] = 'order_items' and ends_with(file_name, '.parquet'))
          or (string_split(load_path, '/')[2] in ('orders','customers','products','shipments','payments')
              and ends_with(file_name, '.csv')))""",
    "i2_content_checksum": "select doc_id, case when strlen(text) > 0 then sha256(text) end as checksum from documents",
    "i3_not_yet_loaded": """select doc_id, sha256(text) as checksum from document_files f where not exists
        (select 1 from document_files g where g.quality = 1 and sha256(g.text) = sha256(f.text))""",
    "i4_file_date": """select event_id, regexp_replace(extension, '^\\.', '') as file_type,
        cast(file_date as varchar) as file_date from name_dates""",
    "i5_header_validation": """with r as (select *, lower(regexp_extract(file_name, '[^.](\\.[^.]*)$', 1)) as ext,
            case source_name
                when 'payments' then ['payment_id','order_id','payment_method','payment_status','payment_amount','paid_at']
                when 'products' then ['product_id','product_name','category','subcategory','brand','cost_price',
                                      'sale_price','is_active']
                when 'shipments' then ['shipment_id','order_id','carrier','shipping_method','shipping_cost','shipped_at',
                                       'shipment_status'] end as required from headers),
        m as (select *, case when ext in ('.csv','.parquet') and required is not null and file_size_bytes > 0
            then list_filter(required, lambda c: not list_contains(string_split(header, ','), c)) else [] end as gone from r),
        e as (select *, case when ext not in ('.csv','.parquet') then 'Unsupported file type '''||ext||''''
            when required is null then 'Unknown source name '''||source_name||''''
            when file_size_bytes = 0 then 'File is empty: '||file_name
            when len(gone) > 0 then 'Missing required columns: '||array_to_string(gone, ', ') end as validation_error from m)
        select file_id, validation_error is null as is_valid, array_to_string(gone, ',') as missing, validation_error from e""",
    "i9_source_file_states": shown("source_file_states", "source_file_id source_name status error_message t:discovered_at"
                                   " t:loaded_at"),
    "i10_ingestion_run_states": shown("ingestion_run_states", "ingestion_run_id job_id source_name file_name t:started_at"
                                      " t:finished_at rows_loaded status error_message"),
    "i11_file_outcomes": """select doc_id, case when error is null then 'success' else 'failed' end as status,
        case when invalid is null then case when error is null then 'success' else 'failed' end end as run_status,
        error, case when error is null then n_chars else 0 end as rows_loaded,
        case when error is null then 'archive/loaded' else 'archive/failed' end as disposition,
        case when invalid is null then file_name
             else regexp_replace(file_name, '\\.csv$', '')||'_19990630T120000.csv' end as target from document_outcomes""",
    "i12_batch_rollup": """with s as (select batch_id, case when quality is null and n_chars > 1000 then 'skipped'
            when error is null then 'success' else 'failed' end as status from document_outcomes)
        select batch_id, count(*) as files_discovered, count(*) filter (where status = 'success') as files_loaded,
        count(*) filter (where status = 'failed') as files_failed,
        count(*) filter (where status = 'skipped') as files_skipped,
        case when count(*) filter (where status = 'failed') = 0 then 'success'
             when count(*) filter (where status = 'success') = 0 then 'failed' else 'partial' end as status
        from s group by batch_id""",
    "i8_raw_append": " union all ".join(
        f"select '{s}' as source_name, count(*) as recorded_rows, cast(0 as bigint) as open_runs, count(*) as raw_rows"
        f" from raw_{s}" for s in ("customers", "orders", "products", "payments")),
    "i13_incremental_pickup": " union all ".join(
        f"select '{s}' as source_name, 'success' as status, count(*) as rows_loaded from raw_{s}" for s in ("orders", "payments")),
    "i6_csv_load": "select " + ", ".join(_csv(c) for c in (
        "shipment_id", "order_id", "carrier", "shipping_method", "shipping_cost", "shipped_at", "delivered_at",
        "shipment_status")) + " from raw_shipments",
    "i7_parquet_load": """select order_item_id, order_id, product_id, quantity,
        cast(cast(unit_price as double) as varchar) as unit_price,
        cast(cast(discount_amount as double) as varchar) as discount_amount,
        cast(cast(tax_amount as double) as varchar) as tax_amount,
        cast(cast(line_total as double) as varchar) as line_total from raw_order_items""",
    "i14_published_mart": shown("fact_daily_sales", "t:order_date i:total_orders i:completed_orders i:cancelled_orders"
                                " i:refunded_orders n:total_revenue i:total_items_sold n:average_order_value"
                                " n:total_shipping_cost"),
    "i15_staging_views": """select currency, payment_method, count(*) as payments, cast(sum(payment_amount) as double) as paid
        from stg_orders join stg_payments using (order_id) group by currency, payment_method""",
    "i16_overlapping_batches": " union all ".join(
        f"select '{s}' as source_name, count(*) as rows_loaded, 0 as open_runs, 0 as repeated_numbers, 0 as unlike_counts,"
        f" 4 as batches, true as all_found_again, 0 as targets_taken_twice from raw_{s}" for s in ("orders", "customers", "payments", "products")),
    "j8_loaded_checksum_lookup": """select event_id, cast(event_id % 60 as varchar) as checksum from events
        where cast(event_id % 60 as varchar) not in (select checksum from source_file_states where status = 'loaded')""",
    "f1_text_functions": f"""with n as (select c_custkey, '  '||c_name||'-'||lower(c_mktsegment)||'''s  ' as v from customer)
        select c_custkey, trim(v) as trimmed, lower(trim(v)) as lowered, upper(trim(v)) as uppered,
        {_title('trim(v)')} as titled from n""",
    "f2_file_name_parts": "select event_id, stem, extension, cast(file_date as varchar) as file_date from name_dates",
    "f3_age_in_hours": """select event_id, cast((2 * date_diff('microsecond', ts, timestamp '2024-02-01 00:00:00') * 100
        + 3600000000) // (2 * 3600000000) as double) / 100 as hours from events""",
}

# check name, table, column, type, label, count
_LABELS = {"row_count": "Row count: ", "not_null": "Null count: ", "uniqueness": "Duplicate keys: ",
           "value_range": "Negative values: ", "accepted_values": "Values outside the list: "}


def _check(
    table: str, column: str | None, kind: str, suffix: str, count: str, label: str | None = None, name: str | None = None
) -> str:
    name = name or (f"{table}_{column}_{suffix}" if column else f"{table}_{suffix}")
    status = "n > 0" if kind == "row_count" else "n = 0"
    failed = "case when n > 0 then 0 else 1 end" if kind == "row_count" else "n"
    shown_column = f"'{column}'" if column else "cast(null as varchar)"
    return (
        f"select '{name}' as check_name, '{table}' as table_name, {shown_column} as column_name, '{kind}' as check_type,"
        f" case when {status} then 'passed' else 'failed' end as check_status, cast({failed} as bigint) as failed_row_count,"
        f" '{label or _LABELS[kind]}'||cast(n as varchar) as details from ({count})"
    )


def _relation(table: str) -> str:
    layer, _, name = table.rpartition(".")
    return f"raw_{name}" if layer == "raw" else name


def _rows(table: str) -> str:
    return _check(table, None, "row_count", "has_rows", f"select count(*) as n from {_relation(table)}")


def _null(table: str, column: str, relation: str | None = None) -> str:
    return _check(table, column, "not_null", "not_null",
                  f"select count(*) as n from {relation or _relation(table)} where {column} is null")


def _repeated(table: str, column: str, **shown: str) -> str:
    return _check(table, column, "uniqueness", "unique",
                  f"select count(*) as n from (select {column} from {_relation(table)} where {column} is not null"
                  f" group by {column} having count(*) > 1)", **shown)


def _negative(table: str, column: str) -> str:
    return _check(table, column, "value_range", "not_negative",
                  f"select count(*) as n from {_relation(table)} where {column} < 0")


def _listed(table: str, column: str, values: str, relation: str | None = None) -> str:
    quoted = ",".join(f"'{v}'" for v in values.split())
    return _check(table, column, "accepted_values", "accepted_values",
                  f"select count(*) as n from {relation or _relation(table)} where {column} not in ({quoted})")


def _before(table: str, column: str, other: str) -> str:
    return _check(table, column, "date_logic", f"not_before_{other}",
                  f"select count(*) as n from {_relation(table)} where {column} < {other}", "Rows before the other date: ")


_RAW = (("orders", "order_id"), ("order_items", "order_item_id"), ("customers", "customer_id"),
        ("products", "product_id"), ("shipments", "shipment_id"), ("payments", "payment_id"))
_FUTURE = _check("staging.stg_orders", "order_date", "date_logic", "not_future",
                 "select count(*) as n from stg_orders where order_date > date '1999-06-30'",
                 "Future order dates: ", "stg_orders_order_date_not_future")
_AMOUNTS = [_negative("marts.fact_orders", c) for c in ("total_amount", "payment_amount", "shipping_cost")] + [
    _negative("marts.fact_order_items", "line_total")]
# Names and texts under which these results are known.
_ORDER = _check("staging.stg_shipments", "delivered_at", "date_logic", "",
                "select count(*) as n from stg_shipments where delivered_at < shipped_at",
                "Shipments where delivered_at < shipped_at: ", "stg_shipments_delivered_after_shipped")
_UNIQUE_ORDERS = _repeated("marts.fact_orders", "order_id", label="Duplicate order_ids: ", name="fact_orders_order_id_unique")
_MODELS = (
    ("staging.stg_orders", "order_id customer_id total_amount"),
    ("staging.stg_order_items", "order_item_id order_id product_id quantity"),
    ("staging.stg_customers", "customer_id email"), ("staging.stg_products", "product_id"),
    ("staging.stg_shipments", "shipment_id order_id"), ("staging.stg_payments", "payment_id order_id"),
    ("marts.fact_orders", "order_id customer_id total_amount"),
    ("marts.fact_order_items", "order_item_id order_id product_id"), ("marts.fact_daily_sales", "order_date"),
    ("marts.fact_customer_revenue", "customer_id"), ("marts.fact_shipping_performance", "shipment_id"),
    ("marts.dim_customers", "customer_id"), ("marts.dim_products", "product_id"),
)
_ACCEPTED = [
    _listed("staging.stg_orders", "order_status", "completed cancelled refunded pending"),
    _listed("staging.stg_shipments", "shipment_status", "delivered in_transit pending failed"),
    _listed("staging.stg_payments", "payment_status", "paid refunded pending"),
    _listed("marts.fact_orders", "order_status", "completed cancelled refunded pending"),
]


def _union(parts: list[str]) -> str:
    return "\nunion all ".join(parts)


_HOLED = {
    "order_items": "(select case when quantity <> '1' then order_item_id end as order_item_id from raw_order_items)",
    "payments": "(select case when payment_method not like 'GIFT%' then payment_id end as payment_id from raw_payments)",
}
_RUNTIME = ([_rows(f"raw.{s}") for s, _ in _RAW] + [_null(f"raw.{s}", k) for s, k in _RAW]
            + [_UNIQUE_ORDERS] + _AMOUNTS + [_ORDER, _FUTURE])


def _age(relation: str, schema: str, table: str) -> str:
    seconds = "date_diff('microsecond', max(_loaded_at), timestamp '2001-11-05 06:20:00')"
    hours = f"cast((2 * {seconds} * 100 + 3600000000) // (2 * 3600000000) as double) / 100"
    return (f"select '{schema}' as schema_name, '{table}' as table_name, count(*) as row_count,"
            f" cast(max(_loaded_at) as varchar) as max_loaded_at, '2001-11-05 06:20:00' as checked_at,"
            f" {hours} <= 48 as is_fresh, {hours} as staleness_hours, cast(null as varchar) as note from {relation}")


def _ageless(relation: str) -> str:
    return (f"select 'marts' as schema_name, '{relation}' as table_name, count(*) as row_count,"
            " cast(null as varchar) as max_loaded_at, '2001-11-05 06:20:00' as checked_at, cast(null as boolean) as is_fresh,"
            f" cast(null as double) as staleness_hours, 'not checkable: no load time' as note from {relation}")


_PRODUCTS = """select i.product_id, sum(i.line_total) as revenue from fact_order_items i
    where i.order_id in (select order_id from fact_orders where is_completed) group by i.product_id"""
CTES["product_revenue"] = _PRODUCTS
_MEAN_DAYS = "cast(sum(delivery_micros) as double) / 86400000000.0 / cast(count(delivery_micros) as double)"

_HISTORY = """with per_day as (select event_type, cast(ts as date) as day, count(*) as n from events group by 1, 2),
        usual as (select event_type, cast(floor(sum(n) / count(*)) as bigint) as least from per_day
            where event_type <> 'click' group by 1)
        select p.event_type as table_name, cast(p.day as varchar) as check_date, u.least as expected_min_rows,
        p.n as actual_row_count, case when p.n >= u.least then 'passed' when p.n < u.least then 'failed' else 'warning' end
        as check_status, '1999-06-30 12:00:00' as checked_at
        from per_day p left join usual u on u.event_type = p.event_type"""
_BATCHES = """(select batch_id, case when count_if(error is not null) = 0 then 'success' when count_if(error is null) = 0 then 'failed'
    else 'partial' end as status from document_outcomes group by batch_id)"""
# Rules on the ledgers that are meant to find something.
_STATED = [
    _listed("metadata.source_files", "status", "discovered loaded", "source_file_states"),
    _listed("metadata.pipeline_runs", "status", "success", _BATCHES),
    _listed("quality.row_count_checks", "check_status", "passed warning", f"({_HISTORY})"),
]

ORACLES |= {
    "q1_row_counts": _union([_rows(f"raw.{s}") for s, _ in _RAW]),
    "q2_null_keys": _union([_null(f"raw.{s}", k, _HOLED.get(s)) for s, k in _RAW]),
    "q3_duplicate_keys": _union([_UNIQUE_ORDERS, _repeated("raw.order_items", "order_item_id")]),
    "q4_negative_amounts": _union([*_AMOUNTS, _negative("customer", "c_acctbal"), _negative("supplier", "s_acctbal")]),
    "q5_date_order": _union([_ORDER, _before("marts.fact_shipping_performance", "shipped_at", "order_date")]),
    "q6_future_dates": _FUTURE,
    "q7_freshness": _union([_age("raw_orders", "raw", "orders"), _age("raw_order_items", "raw", "order_items"),
                            _age("stg_orders", "staging", "stg_orders"), _ageless("fact_orders"),
                            _ageless("fact_daily_sales")]),
    "q8_quality_results": f"select *, '1999-06-30 12:00:00' as checked_at from ({_union(_RUNTIME)})",
    "q9_row_count_history": _HISTORY,
    "q14_merged_states": f"""with c as ({_union([f"select 'raw.{s}' as table_name, count(*) as row_count, {a} as staleness_hours from raw_{s}"
                                                for s, a in (("customers", 72.0), ("orders", 72.0), ("payments", 72.0), ("products", 71.0))])})
        select r.*, row_count, false as is_fresh, cast(staleness_hours as double) as staleness_hours
        from ({_union([_rows(f"raw.{s}") for s in ("customers", "orders", "payments", "products")]
                      + [_null(f"raw.{s}", k) for s, k in _RAW if s in ("customers", "orders", "payments", "products")])}) r join c using (table_name)""",
    "q15_recorded_checks": f"""{_union([
        f"select 'row_counts' as kind, 'raw.{s}' as name, {v} as check_status, count(*) as n from raw_{s}" for s, v in (
            ("orders", "'passed'"), ("payments", "'failed'"), ("customers", "'warning'"), ("products", "'warning'"),
            ("shipments", "'warning'"), ("order_items", "'warning'"))])}
        union all {_union([f"select 'freshness', '{s}', 'true', count(*) from raw_{s}" for s, _ in _RAW])}
        union all select 'results', check_name, check_status, failed_row_count from ({_union(_RUNTIME)})
        union all select 'results', 'metadata.'||t||'_status_accepted_values', 'passed', 0
        from (values ('source_files'), ('ingestion_runs'), ('pipeline_runs')) v(t)""",
    "q10_model_keys_unique": _union([_repeated(m, cols.split()[0]) for m, cols in _MODELS]),
    "q11_model_columns_present": _union([_null(m, c) for m, cols in _MODELS for c in cols.split()]),
    "q12_model_accepted_values": _union([*_ACCEPTED, _listed("marts.fact_orders", "currency", "USD EUR")]),
    "q13_ledger_statuses": _union([
        _listed("metadata.source_files", "status", "discovered validated loaded failed skipped", "source_file_states"),
        _listed("metadata.ingestion_runs", "status", "running success failed", "ingestion_run_states"),
        _listed("metadata.pipeline_runs", "status", "running success failed partial", _BATCHES),
        _listed("quality.data_quality_results", "check_status", "passed failed warning", f"({_union(_STATED)})"),
        _listed("quality.row_count_checks", "check_status", "passed failed warning", f"({_HISTORY})"),
        *_STATED,
        _listed("quality.data_quality_results", "check_status", "passed", f"({_union(_STATED)})"),
    ]),
    "d1_total_revenue": "select cast(sum(total_revenue) as double) as total_revenue from fact_daily_sales",
    "d2_total_orders": "select count(*) as total_orders from fact_orders",
    "d3_average_order_value": f"select {exact_mean('total_amount', 'is_completed')} as average_order_value from fact_orders",
    "d4_revenue_by_day": shown("fact_daily_sales", "t:order_date n:total_revenue"),
    "d5_orders_by_day": shown("fact_daily_sales", "t:order_date i:total_orders"),
    "d6_revenue_by_category": """select p.category, cast(sum(r.revenue) as double) as revenue from product_revenue r
        left join dim_products p on p.product_id = r.product_id group by p.category""",
    "d7_top_products": """select r.product_id, p.product_name, p.category, cast(r.revenue as double) as revenue
        from product_revenue r left join dim_products p on p.product_id = r.product_id
        order by r.revenue desc, r.product_id limit 10""",
    "d8_total_customers": "select count(*) as total_customers from dim_customers",
    "d9_customers_by_segment": "select customer_segment, count(*) as customers from dim_customers group by 1",
    "d10_top_customers": """select customer_id, full_name, total_orders, cast(total_revenue as double) as total_revenue
        from fact_customer_revenue order by fact_customer_revenue.total_revenue desc nulls last, customer_id limit 10""",
    "d11_revenue_by_country": "select country, cast(sum(total_revenue) as double) as total_revenue from fact_customer_revenue group by 1",
    "d12_new_customers_by_month": """select cast(cast(date_trunc('month', customer_created_at) as date) as varchar) as month,
        count(*) as new_customers from dim_customers group by 1""",
    "d13_average_delivery_days": f"select {_MEAN_DAYS} as average_days from fact_shipping_performance",
    "d14_late_shipments": "select count(*) filter (where is_late) as late_shipments from fact_shipping_performance",
    "d15_delivery_days_by_carrier": f"select carrier, {_MEAN_DAYS} as average_days from fact_shipping_performance group by 1",
    "d16_late_by_carrier": "select carrier, count(*) filter (where is_late) as late_shipments from fact_shipping_performance group by 1",
    "d17_shipment_statuses": "select shipment_status, count(*) as shipments from fact_shipping_performance group by 1",
    "d18_shipping_cost_by_day": """select cast(order_date as varchar) as order_date, cast(sum(shipping_cost) as double)
        as shipping_cost from fact_shipping_performance group by 1""",
    "d19_files_loaded_on_day": """select count(*) filter (where status = 'loaded' and cast(loaded_at as date) = date '2024-01-30')
        as files_loaded from source_file_states""",
    "d20_failed_files": "select count(*) filter (where status = 'failed') as failed_files from source_file_states",
    "d21_rows_by_source": "select source_name, cast(sum(rows_loaded) as bigint) as rows_loaded from ingestion_run_states group by 1",
    "d22_checks_by_status": "select check_status, count(*) as checks from ("
                            + _union([*[_null(f"raw.{s}", k) for s, k in _RAW], *_ACCEPTED, _ORDER, _FUTURE])
                            + ") group by 1",
    "d23_run_listing": shown("ingestion_run_states", "ingestion_run_id job_id source_name file_name t:started_at"
                             " t:finished_at rows_loaded status error_message"),
}

_SUPPLIERS = "(select s_suppkey, cast(s_nationkey as varchar) as nation from supplier where s_nationkey <> 3)"
ORACLES |= {
    "j11_hot_keys_left_join": f"""select c_custkey, nation, s_suppkey
        from (select c_custkey, cast(c_nationkey as varchar) as nation from customer) left join {_SUPPLIERS} using (nation)""",
    "j12_hot_keys_inner_join": f"""select c_custkey, nation, s_suppkey
        from (select c_custkey, cast(c_nationkey as varchar) as nation from customer) join {_SUPPLIERS} using (nation)""",
}
