"""What the checks of a table count, kept for each part that was written, so that results are merged and not counted anew.

A part's counts are stored with it. Rows and missing values add up and the newest load time is a maximum, so
any number of parts gives the same result as a scan of them all, at a row per part and column.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import hours_between
from ..specs import FRESH_HOURS
from .quality import FRESHNESS, Rule, results_of

STATES = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("loaded_on", T.DateType()),
    T.StructField("rows", T.LongType()),
    T.StructField("newest", T.TimestampNTZType()),
    # Null for the table itself.
    T.StructField("column_name", T.StringType()),
    T.StructField("missing", T.LongType()),
])


def _own() -> Column:
    """Whether a state is of the table itself."""
    return F.col("column_name").isNull()


def states_of(rows: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """The states of a part: one row per load day for the table, and one for each column to be checked for missing values."""
    counts = rows.groupBy(F.col("_loaded_at").cast("date").alias("loaded_on")).agg(
        F.count("*").alias("rows"), F.max("_loaded_at").cast("timestamp_ntz").alias("newest"),
        *[F.count_if(F.col(c).isNull()).alias(f"_missing{i}") for i, c in enumerate(columns)])
    return by_column(counts, F.lit(table), [(F.lit(c), F.col(f"_missing{i}")) for i, c in enumerate(columns)])


def by_column(counts: DataFrame, table: Column, missing: Sequence[tuple[Column, Column]]) -> DataFrame:
    """States from ``loaded_on, rows, newest`` and the missing values of columns, by name."""
    none = F.struct(F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("long").alias("missing"))
    each = [F.struct(c.alias("column_name"), n.cast("long").alias("missing")) for c, n in missing]
    return counts.select(table.alias("table_name"), "loaded_on", "rows", "newest", F.inline(F.array(none, *each)))


def rules_from_states(states: DataFrame, rules: Sequence[Rule], as_of: datetime) -> DataFrame:
    """Results of row counts and missing values, as ``run_rules`` gives them."""
    other = sorted({r.kind for r in rules} - {"has_rows", "not_null"})
    if other:
        raise ValueError(f"states don't say anything about {other}")

    def count(rule: Rule) -> Column:
        table = F.col("table_name") == rule.table
        if rule.kind == "has_rows":
            return F.sum(F.when(table & _own(), F.col("rows")))
        return F.sum(F.when(table & (F.col("column_name") == rule.column), F.col("missing")))

    counts = states.agg(*[F.coalesce(count(r), F.lit(0)).alias(f"_c{i}") for i, r in enumerate(rules)])
    return results_of(counts, rules, F.lit(as_of).cast("timestamp_ntz"))


def freshness_from_states(states: DataFrame, tables: Sequence[str], as_of: datetime) -> DataFrame:
    """Age of the newest load, as ``freshness`` gives it, for tables by layer and name."""
    spark = states.sparkSession
    asked = spark.createDataFrame([(t,) for t in tables], "table_name string")
    merged = states.filter(_own()).groupBy("table_name").agg(F.sum("rows").alias("rows"), F.max("newest").alias("max_loaded_at"))
    now = F.lit(as_of).cast("timestamp_ntz")
    age = hours_between(F.col("max_loaded_at"), now)
    found = asked.join(merged, "table_name", "left")
    return found.select(
        F.substring_index("table_name", ".", 1).alias("schema_name"), F.substring_index("table_name", ".", -1).alias("table_name"),
        F.coalesce("rows", F.lit(0)).cast("long").alias("row_count"), "max_loaded_at", now.alias("checked_at"),
        F.coalesce(age <= FRESH_HOURS, F.lit(True)).alias("is_fresh"), age.alias("staleness_hours"),
        F.lit(None).cast("string").alias("note")).select(*FRESHNESS.names)


def counts_by_day(states: DataFrame) -> DataFrame:
    """``table_name, check_date, actual_row_count``: rows per table and day of loading."""
    return states.filter(_own() & F.col("loaded_on").isNotNull()).groupBy(
        "table_name", F.col("loaded_on").alias("check_date")).agg(F.sum("rows").alias("actual_row_count"))
