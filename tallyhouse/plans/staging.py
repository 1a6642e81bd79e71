"""Typed, cleaned rows; the newest row per key wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import MONEY, days_between, title_words
from ..operators.latest import MANY_ROWS, latest_of_repeated, repeated_keys
from ..specs import NOT_DELIVERED, TRUE_WORDS, Source, source

_TYPES = {
    "date": "date", "timestamp": "timestamp_ntz", "optional_timestamp": "timestamp_ntz",
    "integer": "int", "money": MONEY,
}


def _value(name: str, rule: str, lenient: bool = False) -> Column:
    text = F.col(name)
    if rule == "asis":
        return text
    if rule == "trim":
        return F.trim(text)
    if rule == "lower":
        return F.lower(F.trim(text))
    if rule == "upper":
        return F.upper(F.trim(text))
    if rule == "title":
        return title_words(F.trim(text))
    if rule == "flag":
        return F.coalesce(F.lower(F.trim(text)).isin(*TRUE_WORDS), F.lit(False))
    if rule == "optional_timestamp":
        text = F.when(~F.trim(text).isin(*NOT_DELIVERED), text)
    return text.try_cast(_TYPES[rule]) if lenient else text.cast(_TYPES[rule])


def split_rejects(raw: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Raw rows that staging can cast, and those it cannot with the bad columns named.

    Staging is strict and fails on a value it cannot cast; pass it the first
    part to set such rows aside instead.
    """
    spec = source(name)
    bad = F.array_compact(F.array(*[
        F.when(_blanked(f.name, f.clean).isNotNull() & _value(f.name, f.clean, lenient=True).isNull(), F.lit(f.name))
        for f in spec.fields if f.clean in _TYPES
    ]))
    checked = raw.withColumn("_bad_columns", bad)
    good = checked.filter(F.size("_bad_columns") == 0).drop("_bad_columns")
    return good, checked.filter(F.size("_bad_columns") > 0)


def _blanked(name: str, rule: str) -> Column:
    text = F.col(name)
    return F.when(~F.trim(text).isin(*NOT_DELIVERED), text) if rule == "optional_timestamp" else text


def with_key(raw: DataFrame, name: str) -> DataFrame:
    """Rows that have their primary key."""
    return raw.filter(F.col(source(name).key).isNotNull())


def cleaned(raw: DataFrame, name: str) -> DataFrame:
    spec = source(name)
    return with_key(raw, name).select(
        *[_value(f.name, f.clean).alias(f.name) for f in spec.fields],
        "_source_file_name",
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
        "_ingestion_run_id",
    )


def newest_first(spec: Source) -> list[Column]:
    """Load time first (a missing one counts as newest), then a full tiebreak."""
    ties = ["_ingestion_run_id", "_source_file_name", *[c for c in spec.columns if c != spec.key]]
    return [F.col("_loaded_at").desc_nulls_first(), *[F.col(c).desc_nulls_last() for c in ties]]


def stage(raw: DataFrame, name: str, as_read: DataFrame | None = None, many_rows: int = MANY_ROWS) -> DataFrame:
    """Cleaned, cast and deduplicated rows of one source.

    ``as_read``, if given, are the same raw rows in the partitions they are stored in, to look up repeated keys.
    """
    spec = source(name)
    repeated = repeated_keys(cleaned(as_read, name).select(spec.key), spec.key, many_rows) if as_read is not None else None
    newest = latest_of_repeated(
        cleaned(raw, name), spec.key, newest_first(spec), repeated, hashed=name not in _JOINED_ON_KEY
    ).drop("_ingestion_run_id")
    return _DERIVED.get(name, lambda df: df)(newest)


def _customers(df: DataFrame) -> DataFrame:
    # concat is NULL as soon as one part is
    return df.withColumn("full_name", F.concat("first_name", F.lit(" "), "last_name"))


def _products(df: DataFrame) -> DataFrame:
    sale, cost = F.col("sale_price"), F.col("cost_price")
    return df.withColumn("gross_margin_pct", F.round((sale - cost) / F.nullif(sale, F.lit(0)) * 100, 2))


def _shipments(df: DataFrame) -> DataFrame:
    return df.withColumn("delivery_days", days_between(F.col("shipped_at"), F.col("delivered_at")))


# Marts join these on their primary key and reuse the exchange made here.
_JOINED_ON_KEY = ("orders", "customers", "products")

_DERIVED = {"customers": _customers, "products": _products, "shipments": _shipments}


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: stage(rows, name) for name, rows in raw.items()}
