"""Files in, raw rows and ledgers out."""

import hashlib
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyhouse.plans.ingest import AllFilesFailed, run_batch
from tallyhouse.plans.staging import stage
from tallyhouse.sources import manifest
from tallyhouse.sources.lake import Lake
from tallyhouse.sources.manifest import csv_header, fingerprint, list_files, recognise, validated
from tallyhouse.specs import SOURCES
from tallyhouse.streaming.pickup import pick_up_available

T1, T2 = datetime(2026, 5, 1, 6), datetime(2026, 5, 2, 6)
ORDER_HEADER = ",".join(SOURCES["orders"].columns)
ORDER_ROW = "ORD{0:03d},CUST1,2026-05-01,completed,USD,{1},2026-05-01T10:00:00,2026-05-01T10:00:00"


def orders_csv(n=5, amount="100.0", first=1):
    return "\n".join([ORDER_HEADER, *(ORDER_ROW.format(i, amount) for i in range(first, first + n))]) + "\n"


def put(landing, name, content):
    path = landing / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return path


@pytest.fixture
def place(spark, tmp_path):
    (tmp_path / "in").mkdir()
    return Lake(spark, str(tmp_path / "lake")), tmp_path / "in"


def test_discovery(spark, tmp_path):
    for name in ("orders/a.csv", "orders/.b.csv", "orders/c.CSV", "orders/d.parquet", "orders/old/e.csv",
                 "order_items/f.parquet", "returns/g.csv", "h.csv", "payments/i with space.csv"):
        put(tmp_path, name, "x\n")
    for root in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}/"):
        found = recognise(list_files(spark, root), root)
        assert {(r.source_name, r.file_name) for r in found.collect()} == {
            ("orders", "a.csv"), ("order_items", "f.parquet"), ("payments", "i with space.csv")}


@pytest.mark.parametrize("limit", [manifest.WHOLE_FILE_BYTES, 0])
def test_fingerprints(spark, tmp_path, limit):
    """Whole or streamed, the facts about a file are the same."""
    text = put(tmp_path, "orders/a.csv", "﻿order_id,\"odd, \"\"name\"\"\"\nORD1,x\n")
    put(tmp_path, "orders/same.csv", text.read_bytes())
    put(tmp_path, "orders/more.csv", text.read_bytes() + b"ORD2,y\n")
    put(tmp_path, "orders/empty.csv", "")
    pd.DataFrame({"order_item_id": ["I1"], "quantity": [1]}).to_parquet(tmp_path / "items.parquet")
    put(tmp_path, "broken.parquet", b"PAR1 not really PAR1")
    rows = {r.file_path.rsplit("/", 1)[1]: r for r in fingerprint(spark, str(tmp_path), limit).collect()}
    assert rows["a.csv"].checksum == hashlib.sha256(text.read_bytes()).hexdigest() == rows["same.csv"].checksum
    assert rows["more.csv"].checksum != rows["a.csv"].checksum and len(rows["more.csv"].checksum) == 64
    assert "empty.csv" not in rows
    assert rows["a.csv"].file_columns == ["order_id", 'odd, "name"']
    assert rows["items.parquet"].file_columns == ["order_item_id", "quantity"]
    assert rows["items.parquet"].layout == "order_item_id:string, quantity:int64" or "quantity:int64" in rows["items.parquet"].layout
    assert rows["broken.parquet"].file_columns is None and rows["broken.parquet"].checksum


def test_files_of_some_size_are_never_one_value(spark, tmp_path):
    """Four tasks of an executor at once hold several copies of such a value; stores unknown to the stream reader have no choice."""
    line = "ORD{},CUST1,note\n"
    text = "order_id,customer_id,x\n" + "".join(line.format(i) for i in range(2_200_000))
    assert 33 << 20 < len(text) < 64 << 20
    file = put(tmp_path, "orders/a.csv", text)
    row = fingerprint(spark, str(tmp_path)).filter("file_path like '%a.csv'").first()
    assert row.checksum == hashlib.sha256(file.read_bytes()).hexdigest() and row.file_columns == ["order_id", "customer_id", "x"]
    assert manifest.WHOLE_FILE_BYTES <= 32 << 20 and manifest._streamed(spark, [str(tmp_path), f"file://{tmp_path}", "s3a://b/x"])
    assert not manifest._streamed(spark, ["viewfs://c/x"]) and not manifest._streamed(spark, [str(tmp_path), "hdfs://n/x"])


@pytest.mark.parametrize("source", list(SOURCES))
def test_required_columns_defined(source):
    assert SOURCES[source].key in SOURCES[source].required


@pytest.mark.parametrize("name,source,size,header,error", [
    ("a.csv", "orders", 9, ORDER_HEADER, None),
    ("a.CSV", "orders", 9, ORDER_HEADER + ",extra,more", None),
    ("a.csv", "orders", 9, ORDER_HEADER.replace(",currency", ""), "Missing required columns: currency"),
    ("a.csv", "shipments", 9, ",".join(c for c in SOURCES["shipments"].columns if c != "delivered_at"), None),
    ("a.json", "nobody", 0, "x", "Unsupported file type '.json'"),
    ("a.csv", "nobody", 0, "x", "Unknown source name 'nobody'"),
    ("a.csv", "orders", 0, None, "File is empty: a.csv"),
    ("a.parquet", "order_items", 9, None, "Could not read file columns: a.parquet"),
])
def test_validation(spark, name, source, size, header, error):
    files = spark.createDataFrame([(name, source, size, header)], "file_name string, source_name string, file_size_bytes long, h string")
    row = validated(files.withColumn("file_columns", csv_header(F.col("h")))).first()
    assert (row.validation_error, row.is_valid) == (error, error is None)


def test_load_and_reload(place):
    lake, landing = place
    put(landing, "orders/orders_2026-05-01.csv", orders_csv(5))
    pd.DataFrame({c: ["x"] * 8 for c in SOURCES["order_items"].columns} | {
        "order_item_id": [f"I{i}" for i in range(8)], "quantity": [1] * 8, "unit_price": [50.0] * 8}
    ).to_parquet(put(landing, "order_items/order_items_2026-05-01.parquet", b"-"))
    done = run_batch(lake, str(landing), T1)
    assert (done.loaded, done.failed) == (2, 0)
    orders = lake.raw("orders").collect()
    assert len(orders) == 5 and lake.raw("order_items").count() == 8
    first = orders[0]
    assert first._source_file_name == "orders_2026-05-01.csv" and first._source_file_path.endswith("/orders/orders_2026-05-01.csv")
    assert first._loaded_at > T1 and first._ingestion_run_id == 1
    assert {(r.quantity, r.unit_price) for r in lake.raw("order_items").collect()} == {("1", "50.0")}

    put(landing, "orders/renamed.csv", orders_csv(5))  # same content
    assert run_batch(lake, str(landing), T2).discovered == 0
    put(landing, "orders/orders_2026-05-01.csv", orders_csv(5, amount="7"))  # same name, new content
    assert run_batch(lake, str(landing), T2).loaded == 1
    assert {r.total_amount for r in stage(lake.raw("orders"), "orders").collect()} == {7}
    files = lake.source_files().orderBy("source_file_id").collect()
    assert [f.source_file_id for f in files] == [1, 2, 3]
    assert str(files[0].file_date) == "2026-05-01" and files[0].file_type == "csv"


def test_two_equal_files_in_one_scan_both_load(place):
    lake, landing = place
    put(landing, "orders/a.csv", orders_csv(2))
    put(landing, "orders/b.csv", orders_csv(2))
    assert run_batch(lake, str(landing), T1).loaded == 2
    assert lake.raw("orders").count() == 4


def test_later_file_of_a_batch_wins(place):
    lake, landing = place
    put(landing, "orders/orders_2026-05-02.csv", orders_csv(1, amount="2"))
    put(landing, "orders/orders_2026-05-01.csv", orders_csv(1, amount="1"))
    run_batch(lake, str(landing), T1)
    assert stage(lake.raw("orders"), "orders").first().total_amount == 2


def test_cells(place):
    """Column order, null words, quotes, line breaks, short rows, blank lines."""
    lake, landing = place
    columns = SOURCES["payments"].columns
    put(landing, "payments/a.csv", ",".join(columns) + "\nP1,O1,NA,paid,10,2026-05-01\n\nP2,O1,\"a, \"\"b\"\"\nc\",null,,N/A\nP3,O1\n")
    put(landing, "payments/b.csv", ",".join(reversed(columns)) + "\n2026-05-02,20,paid,None,O2,P4\n")
    run_batch(lake, str(landing), T1)
    rows = {r.payment_id: r for r in lake.raw("payments").collect()}
    assert sorted(rows) == ["P1", "P2", "P3", "P4"]
    assert rows["P1"].payment_method is None and rows["P1"].payment_status == "paid"
    assert rows["P2"].payment_method == 'a, "b"\nc' and rows["P2"].payment_status is rows["P2"].paid_at is None
    assert rows["P3"].payment_status is None
    assert (rows["P4"].payment_amount, rows["P4"].order_id, rows["P4"].payment_method) == ("20", "O2", None)


def test_one_bad_file_among_good_ones(place):
    lake, landing = place
    put(landing, "orders/a_good.csv", orders_csv(3))
    put(landing, "orders/b_missing.csv", orders_csv(3, first=10).replace(",currency", "", 1))
    put(landing, "orders/c_extra.csv", ORDER_HEADER + ",note\n" + ORDER_ROW.format(20, 1) + ",x\n")
    put(landing, "orders/d_wide.csv", orders_csv(1, first=30) + ORDER_ROW.format(31, 1) + ",surplus\n")
    put(landing, "orders/e_long.csv", orders_csv(1, first=40).replace("ORD040", "O" * 21))
    put(landing, "orders/f_empty.csv", "")
    put(landing, "order_items/g_broken.parquet", b"PAR1 not really PAR1")
    done = run_batch(lake, str(landing), T1)
    assert (done.discovered, done.loaded, done.failed) == (6, 1, 5)  # the empty file is not registered
    files = {f.file_name: f for f in lake.source_files().collect()}
    assert "f_empty.csv" not in files
    assert files["b_missing.csv"].error_message == "Missing required columns: currency"
    assert files["c_extra.csv"].error_message == "unexpected columns: note"
    assert files["d_wide.csv"].error_message == "row has more cells than the header"
    assert files["e_long.csv"].error_message == "value too long for order_id (20)"
    assert files["g_broken.parquet"].error_message.startswith("Could not read file columns")
    assert files["a_good.csv"].loaded_at is not None and files["d_wide.csv"].loaded_at is None
    assert lake.raw("orders").count() == 3
    runs = {r.file_name: r.status for r in lake.ingestion_runs().collect()}
    assert runs == {"a_good.csv": "success", "c_extra.csv": "failed", "d_wide.csv": "failed", "e_long.csv": "failed"}
    assert {r.disposition for r in lake.outcomes().filter("status = 'failed'").collect()} == {"archive/failed"}
    again = landing / "orders" / "c_extra.csv"
    with pytest.raises(AllFilesFailed):  # failed files are tried again
        run_batch(lake, str(landing), T2)
    assert run_batch(lake, str(landing), T2, paths=[str(again)], on_extra="ignore").loaded == 1
    assert lake.raw("orders").count() == 4


def test_unreadable_data_is_found_by_halving(place):
    lake, landing = place
    for i in range(4):
        frame = pd.DataFrame({c: [f"{c}{i}{j}"[-18:] for j in range(2000)] for c in SOURCES["order_items"].columns})
        path = put(landing, f"order_items/p{i}.parquet", b"-")
        frame.to_parquet(path)
        if i == 2:  # the footer stays readable
            data = bytearray(path.read_bytes())
            data[4:2000] = b"\xff" * 1996
            path.write_bytes(bytes(data))
    done = run_batch(lake, str(landing), T1)
    assert (done.loaded, done.failed) == (3, 1)
    assert lake.raw("order_items").count() == 6000
    assert [f.file_name for f in lake.source_files().filter("status = 'failed'").collect()] == ["p2.parquet"]


def test_nothing_counts_before_the_commit(place, monkeypatch):
    lake, landing = place
    put(landing, "orders/a.csv", orders_csv(3))
    monkeypatch.setattr("tallyhouse.plans.ingest._record", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        run_batch(lake, str(landing), T1)
    assert lake.raw("orders").count() == 0 and lake.source_files().count() == 0
    monkeypatch.undo()
    assert run_batch(lake, str(landing), T2).loaded == 1
    assert lake.raw("orders").count() == 3


CELLS = ["plain", 'Pipe 5" steel', '"a, b"', '"two\nlines"', '"say ""hi""\n\nand ""bye"""', "", '"x""y"', 'TV 55" screen', "é" * 40]


@pytest.mark.parametrize("limit", [manifest.WHOLE_FILE_BYTES, 0])
def test_a_file_means_the_same_at_every_size(place, monkeypatch, limit):
    """Stray quotes, cells over lines, blank lines, a long header, a character across any block: read whole or as a stream."""
    lake, landing = place
    monkeypatch.setattr(manifest.fingerprint, "__defaults__", (limit,))
    columns = SOURCES["payments"].columns
    more = [f"extra_{i}" for i in range(9000)]  # a header of over 64 KiB
    lines = [f"P{i},O{i},{CELLS[i % 9]},paid,{i},2026-05-01" for i in range(300)]
    body = "".join(line + "\n" + ("\n" if i % 7 == 0 else "   \n" if i % 11 == 0 else "") for i, line in enumerate(lines))
    put(landing, "payments/a.csv", ",".join(columns) + "\n" + body)
    put(landing, "payments/b.csv", ",".join([*columns, *more]) + "\n" + body.replace("P", "Q").replace("O", "R"))
    put(landing, "payments/c.csv", ",".join(columns) + "\nS1,T1," + "x" * (65535 - len(",".join(columns)) - 7) + "é,paid,1,2026-05-01\n")
    done = run_batch(lake, str(landing), T1, on_extra="ignore")
    files = {f.file_name: f for f in lake.source_files().collect()}
    assert files["c.csv"].error_message == "value too long for payment_method (50)"  # decoded, and judged as a row
    assert (done.loaded, done.failed) == (2, 1)
    rows = {r.payment_id: r.payment_method for r in lake.raw("payments").collect()}
    assert len(rows) == 600
    for i in range(300):
        cell = CELLS[i % 9]
        want = cell[1:-1].replace('""', '"') if cell.startswith('"') else cell
        assert rows[f"P{i}"] == (want or None) and rows[f"Q{i}"] == (want.replace("P", "Q") or None)


@pytest.mark.parametrize("limit", [manifest.WHOLE_FILE_BYTES, 0])
def test_bytes_that_are_no_text_fail_their_file_only(place, tmp_path, monkeypatch, limit):
    lake, landing = place
    monkeypatch.setattr(manifest.fingerprint, "__defaults__", (limit,))
    put(landing, "orders/a.csv", orders_csv(3))
    put(landing, "orders/b.csv", orders_csv(1, first=10).encode() + ORDER_ROW.format(11, 1).replace("CUST1", "caf").encode() + b"\xe9\n")
    put(landing, "orders/c.csv", b"\xff\xfe" + orders_csv(1, first=20).encode())
    progress = str(tmp_path / "progress")
    pick_up_available(lake, str(landing), progress)
    assert lake.raw("orders").count() == 3
    errors = {f.file_name: f.error_message for f in lake.source_files().filter("status = 'failed'").collect()}
    assert errors == {n: f"File is not valid UTF-8: {n}" for n in ("b.csv", "c.csv")}
    put(landing, "orders/d.csv", orders_csv(4, first=30))  # the stream goes on
    pick_up_available(lake, str(landing), progress)
    assert lake.raw("orders").count() == 7


def test_names_are_no_patterns(place, tmp_path):
    lake, landing = place
    names = ["p_1.csv", "p_2.csv", "p_[12].csv", "p_{x}.csv", "p_*.csv", "p_?.csv"]
    for i, name in enumerate(names):
        put(landing, f"orders/{name}", orders_csv(i + 1, first=10 * i + 1))
    pick_up_available(lake, str(landing), str(tmp_path / "progress"))
    got = {r["_source_file_name"]: r["count"] for r in lake.raw("orders").groupBy("_source_file_name").count().collect()}
    assert got == {name: i + 1 for i, name in enumerate(names)}
    assert {r.file_name: r.rows_loaded for r in lake.ingestion_runs().collect()} == got


def test_a_batch_inside_the_window_of_another(place, monkeypatch):
    """Both give out the same numbers; no row and no file of either is lost."""
    from tallyhouse.plans import ingest

    lake, landing = place
    bad = put(landing, "orders/bad.csv", orders_csv(2).replace(",currency", "", 1))
    wide = put(landing, "orders/wide.csv", orders_csv(1) + ORDER_ROW.format(2, 1) + ",surplus\n")
    own = ingest._record

    def late(*a):
        monkeypatch.setattr(ingest, "_record", own)
        good = put(landing, "orders/good.csv", orders_csv(3, first=50))
        ingest.run_batch(lake, str(landing), T2, paths=[str(good)])
        own(*a)

    monkeypatch.setattr(ingest, "_record", late)
    with pytest.raises(AllFilesFailed):
        run_batch(lake, str(landing), T1, paths=[str(bad), str(wide)])
    assert lake.raw("orders").count() == 3
    assert {f.file_name: f.status for f in lake.source_files().collect()} == {
        "bad.csv": "failed", "wide.csv": "failed", "good.csv": "loaded"}
    runs = {r.file_name: r for r in lake.ingestion_runs().collect()}
    assert {n: r.status for n, r in runs.items()} == {"wide.csv": "failed", "good.csv": "success"}
    assert all(r.finished_at > r.started_at for r in runs.values())


def test_what_is_no_fault_of_a_file_is_raised(place, monkeypatch):
    from pyspark.errors import PySparkException

    lake, landing = place
    put(landing, "orders/a.csv", orders_csv(3))
    put(landing, "orders/b.csv", orders_csv(3, first=9))
    calls = []

    def lost(*a):
        calls.append(a)
        raise PySparkException("Job aborted due to stage failure: ExecutorLostFailure")

    monkeypatch.setattr(Lake, "append", lost)
    with pytest.raises(PySparkException):
        run_batch(lake, str(landing), T1)
    assert len(calls) == 1


def test_empty_folder(place):
    lake, landing = place
    assert run_batch(lake, str(landing), T1).discovered == 0


def test_incremental_pickup(place, tmp_path):
    lake, landing = place
    put(landing, "orders/orders_2026-05-01.csv", orders_csv(3))
    progress = str(tmp_path / "progress")
    pick_up_available(lake, str(landing), progress, files_per_trigger=1)
    put(landing, "orders/orders_2026-05-02.csv", orders_csv(4, first=50))
    put(landing, "orders/orders_2026-05-03.csv", orders_csv(3))  # content known
    put(landing, "orders/orders_2026-05-04.csv", "nonsense\n")
    pick_up_available(lake, str(landing), progress, files_per_trigger=1)
    pick_up_available(lake, str(landing), progress)
    assert lake.raw("orders").count() == 7
    assert {f.file_name: f.status for f in lake.source_files().collect()} == {
        "orders_2026-05-01.csv": "loaded", "orders_2026-05-02.csv": "loaded", "orders_2026-05-04.csv": "failed"}
