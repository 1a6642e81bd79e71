"""Large CSV files are split if no cell spans lines; the rows are the same either way."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_ingest import place, put  # noqa: F401

from tallyhouse.plans import ingest
from tallyhouse.plans.ingest import run_batch
from tallyhouse.sources.manifest import fingerprint
from tallyhouse.sources.readers import closed, closed_files, read_csv_files
from tallyhouse.specs import SOURCES

COLUMNS = SOURCES["payments"].columns


@pytest.mark.parametrize("line,whole", [
    ("", True), ("a,b", True), ('"a","b"', True), ('"a,b",c', True), ('"say ""hi""",x', True), ('""', True), ('"",""', True),
    ('""""', True), ("a,b\r", True), ("é ü,\t", True),
    ('a"', False), ('5" x,"', False), ('"open', False), ('a,"open ""x""', False), ('"a" ,b', False), (' "a",b', False),
    ('"a"b,c', False), ("a\rb", False), ("a\x00b", False), ("\x01,b", False), ('"""', False), ('x"y,"start', False),
])
def test_lines(spark, line, whole):
    assert spark.createDataFrame([(line,)], "l string").select(closed(F.col("l"))).first()[0] is whole


def rows(spark, path, by_lines):
    read = read_csv_files(spark, [str(path)], "payments", COLUMNS, by_lines)
    return sorted((tuple(r[c] for c in (*COLUMNS, "_fault")) for r in read.collect()), key=str)


cell = st.one_of(st.sampled_from(["", "a", '"b"', '"c,d"', '"e ""f"" g"', '"h\ni"', '5" j', " k ", "NA", "é", '"', '""', "l\rm", "\t", '"n" ']),
                 st.text("ab\"',\n\r é", max_size=6))
record = st.lists(cell, min_size=0, max_size=8).map(",".join)


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(record, max_size=8), st.sampled_from(["\n", "\r\n"]), st.booleans())
def test_closed_files_read_alike(spark, tmp_path, records, end, last):
    path = tmp_path / "a.csv"
    path.write_text(end.join([",".join(COLUMNS), *records]) + (end if last else ""), newline="")
    if closed_files(spark, [str(path)]):
        assert rows(spark, path, True) == rows(spark, path, False)


def test_some_files_are_closed(spark, tmp_path):
    head = ",".join(COLUMNS)
    texts = {"plain": f"{head}\nP1,O1,card,paid,1,2026-05-01\n", "quoted": f'"{head.replace(",", chr(34) + "," + chr(34))}"\n"P,1",O,,,,\n',
             "crlf": f"{head}\r\nP1,O1\r\n", "mixed": f"{head}\r\nP1,O1\n", "open": f'{head}\nP1,"two\nlines",,,,\n', "bare": f"{head}\nP\r1\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    found = closed_files(spark, [str(tmp_path / n) for n in texts])
    assert sorted(os.path.basename(f) for f in found) == ["crlf", "plain", "quoted"]


def test_a_large_file_uses_many_tasks(spark, place, monkeypatch):  # noqa: F811
    lake, landing = place
    lines = [f"P{i},O{i},\"card, {i % 7}\",paid,{i}.5,2026-05-01" for i in range(40_000)]
    put(landing, "payments/big.csv", ",".join(COLUMNS) + "\n" + "\n".join(lines) + "\n")
    put(landing, "payments/odd.csv", ",".join(COLUMNS) + "\n" + "\n".join(lines).replace("P", "Q").replace("card", "card\n") + "\n")
    monkeypatch.setattr(ingest, "SPLIT_BYTES", 1000)
    tasks = []
    own = ingest.read_csv_files

    def read(*a):
        df = own(*a)
        tasks.append((a[4], df.rdd.getNumPartitions()))
        return df

    monkeypatch.setattr(ingest, "read_csv_files", read)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        done = run_batch(lake, str(landing), ingest.datetime(2026, 5, 1))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert done.loaded == 2 and lake.raw("payments").count() == 80_000
    assert dict(tasks)[False] == 1 and dict(tasks)[True] > 4
    assert lake.raw("payments").filter("payment_id = 'Q8'").first().payment_method == "card\n, 1"


HEADERS = {
    "two bare returns": ("\r\rorder_id,customer_id\rx,y\r", ["order_id", "customer_id"]),
    "blank lines": ("\n  \n\t\norder_id,customer_id\nx,y\n", ["order_id", "customer_id"]),
    "a mark": ("﻿order_id,customer_id\n", ["order_id", "customer_id"]),
    "a mark and blank lines": ("﻿\r\n\r\norder_id,customer_id\r\n", ["order_id", "customer_id"]),
    "a break in a cell": ('order_id,"customer\nid",x\n1,2,3\n', ["order_id", "customer\nid", "x"]),
    "a break and quotes": ('"a ""b""\r\nc","d"\nx,y\n', ['a "b"\r\nc', "d"]),
    "a stray quote": ('id,5" size\n1,"2\n3"\n', ["id", '5" size']),
    "an open quote": ('id,"size\n1,2\n', ["id", '"size']),
    "no line end": ("order_id,customer_id", ["order_id", "customer_id"]),
    "leading blanks of a cell": ("  id , x\n", ["  id ", " x"]),
    "only blank lines": ("\n\n  \n", [""]),
}


@pytest.mark.parametrize("limit", [512 << 20, 0])
def test_one_header_rule_for_all_sizes(spark, tmp_path, limit):
    for i, (text, _) in enumerate(HEADERS.values()):
        (tmp_path / f"f{i}.csv").write_text(text, newline="")
    got = {os.path.basename(r.load_path): r.file_columns for r in fingerprint(spark, str(tmp_path), limit).collect()}
    for i, (name, (_, want)) in enumerate(HEADERS.items()):
        have = got[f"f{i}.csv"]
        if name == "an open quote":  # what it is called does not matter, as long as it is the same
            assert have[0] == "id" and len(have) == 2
        elif name == "only blank lines":
            assert [c.strip() for c in have] == want
        else:
            assert have == want, name


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text('ab",\n\r \t﻿é', min_size=1, max_size=25), min_size=1, max_size=12))
def test_headers_are_read_alike(spark, tmp_path_factory, texts):
    folder = tmp_path_factory.mktemp("headers")
    for i, text in enumerate(texts):
        (folder / f"f{i}.csv").write_text(text, newline="")
    whole, streamed = ({r.load_path: (r.file_columns, r.checksum, r.content_fault) for r in fingerprint(spark, str(folder), limit).collect()}
                       for limit in (512 << 20, 0))
    assert whole == streamed
