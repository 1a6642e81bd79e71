from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import specs
from tallyhouse.functions import (
    days_between, exact_average, file_date, file_extension, file_stem, hours_between, mean_days, null_tokens, plain_text,
    title_words,
)


def apply(spark, values, build, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[1] for r in df.select("i", build(F.col("v"))).orderBy("i").collect()]


def test_title_words(spark):
    got = apply(spark, ["non-fiction", "o'BRIEN", "a  b", "", "3d printer", "élan VITAL", "tab\there", "x-", None], title_words)
    assert got == ["Non-Fiction", "O'Brien", "A  B", "", "3d Printer", "Élan Vital", "Tab\tHere", "X-", None]


def test_null_tokens(spark):
    assert apply(spark, list(specs.NULL_TOKENS), null_tokens) == [None] * len(specs.NULL_TOKENS)
    assert apply(spark, [" ", "NaT", "none", "x"], null_tokens) == [" ", "NaT", "none", "x"]


def test_file_names(spark):
    names = ["orders_2026-05-01.csv", "orders_v2_2026-5-1.csv", "orders_2026-13-01.csv", "2026-02-30_2026-03-01.csv",
             "orders.csv", "a.b_2026-05-01.tar", ".hidden", "plain"]
    assert apply(spark, names, file_date) == [
        date(2026, 5, 1), date(2026, 5, 1), None, date(2026, 3, 1), None, date(2026, 5, 1), None, None]
    assert apply(spark, names, file_extension)[-4:] == [".csv", ".tar", "", ""]
    assert apply(spark, names, file_stem)[-4:] == ["orders", "a.b_2026-05-01", ".hidden", "plain"]


@pytest.mark.parametrize("values,dtype,expected", [
    ([True, False, None], T.BooleanType(), ["True", "False", None]),
    ([10000000.0, 0.1, 1e16, 1.5e-5, 0.0001, 123456789.125, -2.5e20, 0.0], T.DoubleType(),
     ["10000000.0", "0.1", "1e+16", "1.5e-05", "0.0001", "123456789.125", "-2.5e+20", "0.0"]),
    ([5, None], T.LongType(), ["5", None]),
    ([Decimal("1.50")], T.DecimalType(12, 2), ["1.50"]),
])
def test_plain_text(spark, values, dtype, expected):
    assert apply(spark, values, lambda c: plain_text(c, dtype), dtype.simpleString()) == expected


def test_exact_average_rounds_once(spark):
    df = spark.createDataFrame([(Decimal("0.01"),)] * 2 + [(Decimal("0.02"),)] * 2 + [(None,)], "v decimal(12,2)")
    assert df.agg(exact_average(F.col("v"))).first()[0] == Decimal("0.02")  # 0.015 half-up
    assert df.filter("v is null").agg(exact_average(F.col("v"))).first()[0] is None


@settings(max_examples=15, deadline=None)
@given(cents=st.lists(st.integers(0, 10**9), min_size=1, max_size=30))
def test_exact_average_property(spark, cents):
    df = spark.createDataFrame([(Decimal(c) / 100,) for c in cents], "v decimal(12,2)")
    got = df.agg(exact_average(F.col("v"))).first()[0]
    assert got == Decimal((2 * sum(cents) + len(cents)) // (2 * len(cents))) / 100


def test_durations(spark):
    a, b = datetime(2026, 5, 1), datetime(2026, 5, 2, 12, 0, 0, 1)
    df = spark.createDataFrame([(a, b), (a, None)], "a timestamp_ntz, b timestamp_ntz")
    days = [r[0] for r in df.select(days_between(F.col("a"), F.col("b"))).collect()]
    assert days == [(36 * 3600 * 10**6 + 1) / 86_400_000_000, None]
    assert df.select(hours_between(F.col("a"), F.col("b"))).first()[0] == Decimal("36.00")
    assert df.select(days_between(F.col("a"), F.col("b")).alias("d")).agg(mean_days(F.col("d"))).first()[0] == days[0]


def test_mean_days_of_many_shipments(spark):
    """Far beyond what a sum of microseconds in 64 bits can hold."""
    from tallyhouse.functions.dates import mean_days

    days = spark.range(100_000_000).select((F.col("id") % 2 * 2 + 2).cast("double").alias("d"))
    assert days.agg(mean_days(F.col("d")).alias("m")).first().m == 3.0
