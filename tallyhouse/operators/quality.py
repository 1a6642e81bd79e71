"""Declarative data-quality rules.

All rules of a table are counted in one pass: if one asks for a unique key, the
row-wise rules are counted per key and added up. Each further key needs a
grouping of its own. Every rule gives one result row; a failed rule never fails
the job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import hours_between
from ..specs import FRESH_HOURS

_TEXT, _COUNT, _TIME = T.StringType(), T.LongType(), T.TimestampNTZType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


RESULTS = _schema(check_name=_TEXT, table_name=_TEXT, column_name=_TEXT, check_type=_TEXT, check_status=_TEXT,
                  failed_row_count=_COUNT, checked_at=_TIME, details=_TEXT)
FRESHNESS = _schema(schema_name=_TEXT, table_name=_TEXT, row_count=_COUNT, max_loaded_at=_TIME, checked_at=_TIME,
                    is_fresh=T.BooleanType(), staleness_hours=T.DecimalType(10, 2), note=_TEXT)
COUNT_CHECKS = _schema(table_name=_TEXT, check_date=T.DateType(), expected_min_rows=_COUNT, actual_row_count=_COUNT,
                       check_status=_TEXT, checked_at=_TIME)
RESULT_COLUMNS = tuple(RESULTS.names)


@dataclass(frozen=True)
class Rule:
    """``kind`` is one of the keys of ``_KINDS``; ``values`` and ``other`` parametrise it.

    ``label`` replaces the kind's text before the count in the details.
    """

    table: str
    column: str | None
    kind: str
    name: str
    values: tuple[str, ...] = ()
    other: str | None = None
    label: str | None = None


# Kind -> (check type shown in results, text before the count in the details)
_KINDS = {
    "has_rows": ("row_count", "Row count: "),
    "not_null": ("not_null", "Null count: "),
    "unique": ("uniqueness", "Duplicate keys: "),
    "not_negative": ("value_range", "Negative values: "),
    "accepted_values": ("accepted_values", "Values outside the list: "),
    "not_before": ("date_logic", "Rows before the other date: "),
    "not_future": ("date_logic", "Future dates: "),
}


def has_rows(table: str) -> Rule:
    return Rule(table, None, "has_rows", f"{table}_has_rows")


def not_null(table: str, column: str) -> Rule:
    return Rule(table, column, "not_null", f"{table}_{column}_not_null")


def unique(table: str, column: str) -> Rule:
    return Rule(table, column, "unique", f"{table}_{column}_unique")


def not_negative(table: str, column: str) -> Rule:
    return Rule(table, column, "not_negative", f"{table}_{column}_not_negative")


def accepted_values(table: str, column: str, values: Sequence[str]) -> Rule:
    return Rule(table, column, "accepted_values", f"{table}_{column}_accepted_values", values=tuple(values))


def not_before(table: str, column: str, other: str) -> Rule:
    return Rule(table, column, "not_before", f"{table}_{column}_not_before_{other}", other=other)


def not_future(table: str, column: str) -> Rule:
    return Rule(table, column, "not_future", f"{table}_{column}_not_future")


def _count(rule: Rule, as_of: Column) -> Column:
    """Rows that break the rule, or all rows for ``has_rows``."""
    if rule.kind == "has_rows":
        return F.count("*")
    column = F.col(rule.column)
    broken = {
        "not_null": lambda: column.isNull(),
        "not_negative": lambda: column < 0,
        "accepted_values": lambda: ~column.isin(*rule.values),
        "not_before": lambda: column < F.col(rule.other),
        "not_future": lambda: column > as_of.cast("date"),
    }[rule.kind]()
    return F.count_if(broken)


def _by_key(df: DataFrame, column: str, scalar: Sequence[Rule], now: Column) -> DataFrame:
    """The counts of the row-wise rules, then how many distinct non-null values of the key occur more than once: in one pass."""
    per_key = df.groupBy(F.col(column).alias("_key")).agg(
        F.count("*").alias("_n"), *[_count(r, now).alias(f"_c{i}") for i, r in enumerate(scalar)])
    sums = [F.coalesce(F.sum(f"_c{i}"), F.lit(0)).alias(f"_c{i}") for i in range(len(scalar))]
    return per_key.agg(*sums, F.count_if((F.col("_n") > 1) & F.col("_key").isNotNull()).alias(f"_c{len(scalar)}"))


def run_rules(tables: Mapping[str, DataFrame], rules: Sequence[Rule], as_of: datetime) -> DataFrame:
    """One result row per rule, with ``as_of`` as the time of the check."""
    unknown = sorted({r.kind for r in rules} - set(_KINDS))
    if unknown:
        raise ValueError(f"unknown rule kinds {unknown}")
    now = F.lit(as_of).cast("timestamp_ntz")
    parts = []
    for table in dict.fromkeys(r.table for r in rules):
        scalar = [r for r in rules if r.table == table and r.kind != "unique"]
        keys = [r for r in rules if r.table == table and r.kind == "unique"]
        if keys:
            parts.append(results_of(_by_key(tables[table], keys[0].column, scalar, now), [*scalar, keys[0]], now))
        elif scalar:
            counts = tables[table].agg(*[_count(r, now).alias(f"_c{i}") for i, r in enumerate(scalar)])
            parts.append(results_of(counts, scalar, now))
        for rule in keys[1:]:
            parts.append(results_of(_by_key(tables[table], rule.column, [], now), [rule], now))
    return reduce(DataFrame.unionByName, parts)


def results_of(counts: DataFrame, rules: Sequence[Rule], now: Column) -> DataFrame:
    """Result rows from one row of counts, ``_c0`` for the first rule and so on."""
    rows = []
    for i, rule in enumerate(rules):
        kind, label = _KINDS[rule.kind]
        label = rule.label or label
        count = F.col(f"_c{i}")
        passed = count > 0 if rule.kind == "has_rows" else count == 0
        failed_rows = F.when(count > 0, F.lit(0)).otherwise(F.lit(1)) if rule.kind == "has_rows" else count
        rows.append(F.struct(
            F.lit(rule.name).alias("check_name"),
            F.lit(rule.table).alias("table_name"),
            F.lit(rule.column).cast("string").alias("column_name"),
            F.lit(kind).alias("check_type"),
            F.when(passed, "passed").otherwise("failed").alias("check_status"),
            failed_rows.cast("bigint").alias("failed_row_count"),
            now.alias("checked_at"),
            F.concat(F.lit(label), count.cast("string")).alias("details"),
        ))
    return counts.select(F.inline(F.array(*rows)))


def freshness(tables: Sequence[tuple[str, str, DataFrame]], as_of: datetime) -> DataFrame:
    """Age of the newest load per table.

    A table without a load time gets a row that says so, and no verdict. A
    table with no load yet counts as fresh.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    parts = []
    for schema, name, df in tables:
        dated = "_loaded_at" in df.columns
        newest = F.max("_loaded_at") if dated else F.lit(None)
        age = hours_between(F.col("max_loaded_at"), now)
        fresh = F.coalesce(age <= FRESH_HOURS, F.lit(True)) if dated else F.lit(None).cast("boolean")
        parts.append(
            df.agg(F.count("*").alias("row_count"), newest.cast("timestamp_ntz").alias("max_loaded_at")).select(
                F.lit(schema).alias("schema_name"), F.lit(name).alias("table_name"), "row_count", "max_loaded_at",
                now.alias("checked_at"), fresh.alias("is_fresh"), age.alias("staleness_hours"),
                F.lit(None if dated else "not checkable: no load time").cast("string").alias("note"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def row_count_history(
    df: DataFrame, table: Column, day: Column, expected_min: DataFrame, as_of: datetime
) -> DataFrame:
    """Rows per table and day against the least number expected.

    ``expected_min`` has one row per table: (table_name, expected_min_rows). A
    table without an expectation gives a warning.
    """
    counts = df.groupBy(table.alias("table_name"), day.cast("date").alias("check_date")).agg(
        F.count("*").alias("actual_row_count"))
    return judged_counts(counts, expected_min, as_of)


def judged_counts(counts: DataFrame, expected_min: DataFrame, as_of: datetime) -> DataFrame:
    """The verdict on ``table_name, check_date, actual_row_count``."""
    enough = F.col("actual_row_count") >= F.col("expected_min_rows")
    return counts.join(expected_min, "table_name", "left").select(
        "table_name", "check_date", F.col("expected_min_rows").cast("bigint").alias("expected_min_rows"),
        "actual_row_count",
        F.when(enough, "passed").when(~enough, "failed").otherwise("warning").alias("check_status"),
        F.lit(as_of).cast("timestamp_ntz").alias("checked_at"),
    )
