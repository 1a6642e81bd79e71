"""Run queries next to their SQL and compare the rows.

    python tests/oracle_compare.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
          " conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if value is None:
        return "~"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, con, build, sql: str) -> str | None:
    """None if the rows agree, else what differs."""
    result = build(spark, sf_dir)
    names, got = rows_of(result.columns, result.collect())
    cursor = con.execute(sql)
    expected_names, expected = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"first difference\n  got      {a}\n  expected {b}"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    from tallyhouse.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    expected, bad = entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in expected:
                problem = compare(spark, sf_dir, con, build, expected[name])
                note = "ok" if problem is None else problem
            else:
                problem, note = None, f"no SQL, {build(spark, sf_dir).count()} rows"
        except Exception as e:  # noqa: BLE001
            problem = note = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:34s} {time.time() - start:6.2f}s {note}", flush=True)
    unused = set(expected) - set(entry.queries())
    if unused:
        print("SQL without query:", sorted(unused))
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
