"""The ledger of batches: numbers, replays, skipped files, where files go."""

import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_ingest import ORDER_HEADER, orders_csv, place, put  # noqa: F401

from tallyhouse.operators.ledger import archive_targets
from tallyhouse.operators.quality import run_rules
from tallyhouse.plans import checks, ingest
from tallyhouse.plans.ingest import AllFilesFailed, fault_of_file, run_batch
from tallyhouse.sources.lake import COMMITS, Lake
from tallyhouse.streaming.pickup import pick_up_available

T1, T2, T3 = (datetime(2026, 5, d, 6) for d in (1, 2, 3))


def test_claims_never_overlap(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    taken, lock = [], threading.Lock()

    def work(n):
        first = lake.claim(n)
        with lock:
            taken.extend(range(first, first + n))

    threads = [threading.Thread(target=work, args=(n,)) for n in (3, 1, 4, 1, 5, 9, 2, 6) * 2]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(set(taken)) == len(taken) == 62
    after = lake.claim(1)
    assert after > max(taken) and lake.claim(2) == after + 1
    # A claim that was left, or whose batch died, is not given out again.
    (tmp_path / "lake" / "metadata" / "claims" / f"{after + 3:019d}.50.x").write_text("")
    assert lake.claim(1) == after + 53


def test_two_open_batches_share_no_number(place, monkeypatch):
    lake, landing = place
    for i in range(3):
        put(landing, f"orders/a{i}.csv", orders_csv(2, first=10 * i + 1))
    own = ingest._record

    def late(*a):
        monkeypatch.setattr(ingest, "_record", own)
        inner = [put(landing, f"orders/b{i}.csv", orders_csv(2, first=10 * i + 100)) for i in range(2)]
        run_batch(lake, str(landing), T2, paths=[str(p) for p in inner], batch_id="inner")
        own(*a)

    monkeypatch.setattr(ingest, "_record", late)
    run_batch(lake, str(landing), T1, batch_id="outer")
    files, runs = lake.source_files().collect(), lake.ingestion_runs().collect()
    assert len({f.source_file_id for f in files}) == len(files) == 5 == len({r.ingestion_run_id for r in runs})
    assert {(f.batch_id, f.file_name[0]) for f in files} == {("outer", "a"), ("inner", "b")}
    assert {r.batch_id for r in runs} == {"outer", "inner"}
    assert lake.raw("orders").select("_ingestion_run_id").distinct().count() == 5


def batches(lake):
    return {r.batch_id: r for r in lake.pipeline_runs().collect()}


def test_skipped_files_count(place):
    lake, landing = place
    put(landing, "orders/a.csv", orders_csv(2))
    put(landing, "orders/b.csv", orders_csv(2, first=5).replace(",currency", "", 1))
    first = run_batch(lake, str(landing), T1, batch_id="1")
    put(landing, "orders/c.csv", orders_csv(2))  # the content of a
    put(landing, "orders/d.csv", orders_csv(2, first=9))
    second = run_batch(lake, str(landing), T2, batch_id="2")
    assert (first.loaded, first.failed, first.skipped) == (1, 1, 0)
    assert (second.loaded, second.failed, second.skipped) == (1, 1, 2)
    rows = batches(lake)
    assert [rows[b].status for b in "12"] == ["partial", "partial"]
    for r in rows.values():
        assert r.files_discovered == r.files_loaded + r.files_failed + r.files_skipped
        assert r.finished_at > r.started_at
    assert sorted((r.file_name, r.target) for r in lake.outcomes().filter("status = 'skipped'").collect()) == [
        ("a.csv", None), ("c.csv", None)]
    assert run_batch(lake, str(landing), T3, paths=[str(landing / "orders" / "a.csv")], batch_id="3").skipped == 1
    assert batches(lake)["3"].status == "success"


def test_a_dead_batch_shows_as_running(place, monkeypatch):
    lake, landing = place
    put(landing, "orders/a.csv", orders_csv(2))
    monkeypatch.setattr(ingest, "_load_groups", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        run_batch(lake, str(landing), T1, batch_id="dead")
    row = batches(lake)["dead"]
    assert (row.status, row.finished_at, row.files_discovered, row.job_id) == ("running", None, 0, "ingest")
    rule = [r for r in checks.LEDGER_RULES if r.table == "metadata.pipeline_runs"]
    assert [r.check_status for r in run_rules({"metadata.pipeline_runs": lake.pipeline_runs()}, rule, T2).collect()] == ["passed"]


def test_a_dead_attempt_is_not_mixed_with_the_next(place, monkeypatch):
    """Died after its rows and events were written: the same batch again loads every row once."""
    lake, landing = place
    put(landing, "orders/a.csv", orders_csv(3))
    own = Lake.append

    def append(self, df, *parts):
        if parts[:2] == ("metadata", "batches"):
            raise RuntimeError("lost")
        own(self, df, *parts)

    monkeypatch.setattr(Lake, "append", append)
    with pytest.raises(RuntimeError):
        run_batch(lake, str(landing), T1, batch_id="b")
    assert lake.raw("orders").count() == 0 and lake.source_files().count() == 0
    monkeypatch.undo()
    assert run_batch(lake, str(landing), T2, batch_id="b").loaded == 1
    assert lake.raw("orders").count() == 3 and lake.source_files().count() == 1
    assert run_batch(lake, str(landing), T3, batch_id="b").loaded == 1  # its result, not another run
    assert lake.raw("orders").count() == 3 and lake.pipeline_runs().count() == 1
    assert batches(lake)["b"].started_at == T1


def test_of_two_attempts_that_finish_the_first_counts(place, monkeypatch):
    lake, landing = place
    put(landing, "orders/a.csv", orders_csv(3))
    run_batch(lake, str(landing), T1, batch_id="b")
    monkeypatch.setattr(Lake, "finished", lambda self, b: None)
    monkeypatch.setattr(Lake, "source_files", lambda self, own=Lake.source_files: own(self).limit(0))
    run_batch(lake, str(landing), T2, batch_id="b")
    monkeypatch.undo()
    assert lake.spark.read.schema(COMMITS).parquet(lake.path("metadata", "batches")).count() == 2
    assert lake.raw("orders").count() == 3 and lake.source_files().count() == 1


def test_a_replayed_micro_batch_is_one_batch(place, tmp_path, monkeypatch):
    lake, landing = place
    put(landing, "orders/a.csv", orders_csv(3))
    progress = str(tmp_path / "progress")
    # The batch is committed, then the stream dies before it notes that the micro-batch is done.
    own = ingest.run_batch

    def dying(*a, **k):
        own(*a, **k)
        raise RuntimeError("lost")

    monkeypatch.setattr("tallyhouse.streaming.pickup.run_batch", dying)
    with pytest.raises(Exception, match="lost"):
        pick_up_available(lake, str(landing), progress)
    monkeypatch.undo()
    put(landing, "orders/b.csv", orders_csv(3, first=10))
    pick_up_available(lake, str(landing), progress)
    assert lake.raw("orders").count() == 6
    rows = batches(lake)
    assert len(rows) == 2 and all(r.status == "success" and r.job_id == "pickup" for r in rows.values())
    assert sum(r.files_discovered for r in rows.values()) == 2


def test_a_micro_batch_that_died_before_its_commit(place, tmp_path, monkeypatch):
    lake, landing = place
    put(landing, "orders/a.csv", orders_csv(3))
    progress = str(tmp_path / "progress")
    monkeypatch.setattr(ingest, "_record", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        pick_up_available(lake, str(landing), progress)
    assert [r.status for r in batches(lake).values()] == ["running"]
    monkeypatch.undo()
    pick_up_available(lake, str(landing), progress)
    assert lake.raw("orders").count() == 3 and [r.status for r in batches(lake).values()] == ["success"]


def test_three_files_of_one_name_get_three_targets(place):
    lake, landing = place
    for name in ("orders", "payments"):
        put(landing, f"{name}/day.csv", "nothing of use\n")
    put(landing, "orders/good.csv", orders_csv(1))
    run_batch(lake, str(landing), T1)
    for name in ("orders", "payments", "customers"):
        put(landing, f"{name}/day.csv", "nothing of use either\n")
    with pytest.raises(AllFilesFailed):
        run_batch(lake, str(landing), T1)  # the same second
    rows = [(r.disposition, r.target) for r in lake.outcomes().filter("status <> 'skipped'").collect()]
    assert len(set(rows)) == len(rows) == 6
    failed = sorted(t for d, t in rows if d == "archive/failed")
    assert failed[:2] == ["day.csv", "day_20260501T060000.csv"]
    assert all(t.startswith("day_20260501T060000_") and t.endswith(".csv") for t in failed[2:])
    assert ("archive/loaded", "good.csv") in rows


def test_targets_and_names_that_look_like_targets(spark):
    names = ["a.csv", "a.csv", "a_20260501T060000.csv", "b", "b", "c.tar.gz"]
    files = spark.createDataFrame([(i, n, f"s{i}", f"p{i}", "x") for i, n in enumerate(names)],
                                  "source_file_id long, file_name string, source_name string, file_path string, disposition string")
    taken = spark.createDataFrame([("x", "c.tar.gz"), ("y", "b"), ("x", None)], "disposition string, target string")
    made = {r.source_file_id: r.target for r in archive_targets(files, taken, F.lit(T1).cast("timestamp_ntz")).collect()}
    assert made == {0: "a.csv", 1: "a_20260501T060000_1.csv", 2: "a_20260501T060000.csv", 3: "b", 4: "b_20260501T060000",
                    5: "c.tar_20260501T060000.gz"}


@pytest.mark.parametrize("text,of_file", [
    ("[CANNOT_READ_FILE_FOOTER] Could not read footer for file", True),
    ("[FAILED_READ_FILE.NO_HINT] x\nCaused by: org.apache.parquet.io.ParquetDecodingException: bad page", True),
    ("[FAILED_READ_FILE.NO_HINT] x\nCaused by: java.net.SocketTimeoutException: Read timed out", False),
    ("[FAILED_READ_FILE.FILE_NOT_EXIST] File does not exist", False),
    ("[PATH_NOT_FOUND] Path does not exist", False),
    ("Job aborted due to stage failure: ExecutorLostFailure", False),
])
def test_whose_fault_a_failure_is(text, of_file):
    assert fault_of_file(RuntimeError(text)) is of_file
