from datetime import datetime, timedelta
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import DataFrame

from tallyhouse.operators import quality
from tallyhouse.operators.ledger import archive_name, batch_rollup, file_states, outcomes, run_states
from tallyhouse.plans import checks
from pyspark.sql import functions as F

NOW = datetime(2026, 5, 3)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [("a", 1, "x", datetime(2026, 5, 1), datetime(2026, 5, 2)), ("a", -1, None, datetime(2026, 5, 2), datetime(2026, 5, 1)),
         ("b", None, "y", None, datetime(2026, 5, 9)), (None, 0, "z", None, None), (None, 0, "z", None, None)],
        "k string, n int, s string, a timestamp_ntz, b timestamp_ntz")


@pytest.mark.parametrize("rule,status,count,details", [
    (quality.has_rows("t"), "passed", 0, "Row count: 5"),
    (quality.not_null("t", "k"), "failed", 2, "Null count: 2"),
    (quality.unique("t", "k"), "failed", 1, "Duplicate keys: 1"),  # keys, not rows; NULLs do not count
    (quality.not_negative("t", "n"), "failed", 1, "Negative values: 1"),
    (quality.accepted_values("t", "s", ("x", "y")), "failed", 2, "Values outside the list: 2"),
    (quality.accepted_values("t", "s", ("x", "y", "z")), "passed", 0, "Values outside the list: 0"),
    (quality.not_before("t", "b", "a"), "failed", 1, "Rows before the other date: 1"),
    (quality.not_future("t", "b"), "failed", 1, "Future dates: 1"),
])
def test_rules(table, rule, status, count, details):
    row = quality.run_rules({"t": table}, [rule], NOW).first()
    assert (row.check_name, row.check_status, row.failed_row_count, row.details) == (rule.name, status, count, details)
    assert row.checked_at == NOW and tuple(row.asDict()) == quality.RESULT_COLUMNS


def test_empty_table_has_no_rows(table):
    row = quality.run_rules({"t": table.limit(0)}, [quality.has_rows("t")], NOW).first()
    assert (row.check_status, row.failed_row_count) == ("failed", 1)


def test_scalar_rules_share_one_scan(spark, tmp_path, table, capsys):
    table.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    rules = [quality.has_rows("t"), quality.not_null("t", "k"), quality.not_negative("t", "n")]
    quality.run_rules({"t": stored}, rules, NOW).explain()
    assert capsys.readouterr().out.count("FileScan") == 1


def test_rule_counts():
    assert (len(checks.MODEL_UNIQUE), len(checks.MODEL_NOT_NULL), len(checks.MODEL_ACCEPTED)) == (13, 25, 4)
    assert len(checks.RUNTIME_RULES) == 6 + 6 + 1 + 4 + 2


def test_unknown_kind(table):
    with pytest.raises(ValueError):
        quality.run_rules({"t": table}, [quality.Rule("t", "k", "nonsense", "n")], NOW)


def test_freshness(spark):
    old = spark.createDataFrame([(datetime(2026, 5, 1),), (datetime(2026, 4, 1),)], "_loaded_at timestamp_ntz")
    rows = {r.table_name: r for r in quality.freshness(
        [("raw", "edge", old), ("raw", "stale", old.filter("_loaded_at < '2026-04-02'")), ("raw", "none", old.limit(0)),
         ("marts", "undated", spark.range(3))], NOW).collect()}
    assert (rows["edge"].is_fresh, rows["edge"].staleness_hours) == (True, Decimal("48.00"))
    assert (rows["stale"].is_fresh, rows["stale"].row_count) == (False, 1)
    assert (rows["none"].is_fresh, rows["none"].staleness_hours) == (True, None)
    assert rows["undated"].is_fresh is None and rows["undated"].note.startswith("not checkable")


def test_row_count_history(spark):
    rows = spark.createDataFrame([("a", NOW)] * 3 + [("b", NOW)] + [("c", NOW)], "t string, d timestamp_ntz")
    least = spark.createDataFrame([("a", 3), ("b", 2)], "table_name string, expected_min_rows int")
    got = quality.row_count_history(rows, F.col("t"), F.col("d"), least, NOW).collect()
    assert {r.table_name: r.check_status for r in got} == {"a": "passed", "b": "failed", "c": "warning"}


def test_ledger_states(spark):
    at = [datetime(2026, 5, 1, h) for h in range(4)]
    events = spark.createDataFrame(
        [(1, "orders", at[0], 0, "discovered", None), (1, "orders", at[0], 1, "validated", None), (1, "orders", at[1], 2, "loaded", None),
         (1, "orders", at[2], 3, "failed", "later"), (2, "orders", at[0], 0, "discovered", None)],
        "source_file_id long, source_name string, event_at timestamp_ntz, event_seq long, status string, error_message string")
    for column in ("file_name", "file_path", "file_type", "checksum", "file_size_bytes", "file_date"):
        events = events.withColumn(column, F.lit(None).cast("string"))
    one, two = file_states(events).orderBy("source_file_id").collect()
    assert (one.status, one.error_message, one.loaded_at, one.discovered_at) == ("failed", "later", at[1], at[0])
    assert (two.status, two.loaded_at) == ("discovered", None)
    runs = spark.createDataFrame(
        [(1, at[0], 0, "running", None), (1, at[1], 1, "success", 7), (2, at[0], 0, "running", None)],
        "ingestion_run_id long, event_at timestamp_ntz, event_seq long, status string, rows_loaded long")
    for column in ("job_id", "source_name", "file_name", "error_message"):
        runs = runs.withColumn(column, F.lit(None).cast("string"))
    done, open_ = run_states(runs).orderBy("ingestion_run_id").collect()
    assert (done.started_at, done.finished_at, done.rows_loaded) == (at[0], at[1], 7)
    assert (open_.finished_at, open_.status) == (None, "running")


def test_outcomes_and_rollup(spark):
    files = spark.createDataFrame(
        [("b1", None, None, 5), ("b1", "bad header", None, 0), ("b2", None, "bad row", 3), ("b3", None, None, 1)],
        "batch_id string, validation_error string, load_error string, rows_loaded long")
    done = outcomes(files)
    rows = [(r.status, r.run_status, r.rows_loaded, r.disposition) for r in done.orderBy("batch_id", "rows_loaded").collect()]
    assert rows == [("failed", None, 0, "archive/failed"), ("success", "success", 5, "archive/loaded"),
                    ("failed", "failed", 0, "archive/failed"), ("success", "success", 1, "archive/loaded")]
    got = {r.batch_id: (r.status, r.files_loaded, r.files_failed) for r in batch_rollup(done).collect()}
    assert got == {"b1": ("partial", 1, 1), "b2": ("failed", 0, 1), "b3": ("success", 1, 0)}


def test_archive_name(spark):
    df = spark.createDataFrame([("a.b.csv", True), ("a.csv", False), ("plain", True)], "n string, taken boolean")
    got = [r[0] for r in df.select(archive_name(F.col("n"), F.col("taken"), F.lit(NOW).cast("timestamp_ntz"))).collect()]
    assert got == ["a.b_20260503T000000.csv", "a.csv", "plain_20260503T000000"]


def test_results_are_kept_run_by_run(spark, tmp_path):
    from tallyhouse.plans.reports import checks_by_status
    from tallyhouse.sources.lake import Lake

    lake = Lake(spark, str(tmp_path))
    assert lake.quality("results").count() == lake.quality("freshness").count() == 0
    table = {"t": spark.createDataFrame([("a", 1), ("a", -1), (None, 2)], "k string, n int")}
    rules = [quality.not_null("t", "k"), quality.not_negative("t", "n"), quality.has_rows("t")]
    first, second = datetime(2026, 1, 1, 6), datetime(2026, 1, 2, 6)
    lake.record_quality("results", quality.run_rules(table, rules, first))
    lake.record_quality("results", quality.run_rules(table, rules[2:], second))
    kept = lake.quality("results")
    assert {(r.checked_at, r["count"]) for r in kept.groupBy("checked_at").count().collect()} == {(first, 3), (second, 1)}
    assert {(r.check_status, r.checks) for r in checks_by_status(kept).collect()} == {("passed", 2), ("failed", 2)}
    lake.record_quality("freshness", quality.freshness([("s", "t", table["t"])], first))
    assert lake.quality("freshness").first().note == "not checkable: no load time"


def test_states_merge_to_what_a_scan_gives(spark):
    """Any cut of a table into parts gives the results of the whole."""
    from tallyhouse.operators import states as st
    from tallyhouse.operators.quality import freshness, has_rows, not_null, row_count_history, run_rules

    start = datetime(2026, 5, 1, 22)
    rows = spark.createDataFrame(
        [(None if i % 7 == 0 else f"k{i}", None if i % 3 else "v", start + timedelta(minutes=11 * i), i % 4) for i in range(200)],
        "k string, v string, _loaded_at timestamp_ntz, part int")
    parts = [rows.filter(rows.part == p) for p in range(5)]  # the last one is empty
    kept = reduce(DataFrame.unionByName, [st.states_of(p, "raw.t", ["k", "v"]) for p in parts]
                  + [st.states_of(parts[0].filter("k is null"), "raw.other", ["k"])])
    rules = [has_rows("raw.t"), not_null("raw.t", "k"), not_null("raw.t", "v")]
    as_of = datetime(2026, 5, 5)
    assert st.rules_from_states(kept, rules, as_of).collect() == run_rules({"raw.t": rows}, rules, as_of).collect()
    assert st.rules_from_states(kept, [has_rows("raw.nobody")], as_of).first().check_status == "failed"
    assert st.freshness_from_states(kept, ["raw.t"], as_of).collect() == freshness([("raw", "t", rows)], as_of).collect()
    none = st.freshness_from_states(kept, ["raw.nobody"], as_of).first()
    assert (none.row_count, none.max_loaded_at, none.is_fresh) == (0, None, True)
    days = st.counts_by_day(kept).filter("table_name = 'raw.t'")
    expected = spark.createDataFrame([("raw.t", 50)], "table_name string, expected_min_rows long")
    whole = row_count_history(rows, F.lit("raw.t"), F.col("_loaded_at"), expected, as_of).select(*days.columns)
    assert sorted(days.collect()) == sorted(whole.collect())
    with pytest.raises(ValueError):
        st.rules_from_states(kept, [quality.unique("raw.t", "k")], as_of)
