"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# In tables of fewer rows, finding the repeated keys first saves nothing.
MANY_ROWS = 1_000_000
# At most so many repeated keys are sent to every task; with more, all rows are ranked.
MOST_REPEATED = 1_000_000


def latest_by_key(
    df: DataFrame, key: str | Sequence[str], newest_first: Sequence[Column], hashed: bool = False
) -> DataFrame:
    """Keep one row per key: the first in ``newest_first`` order.

    Give an order without ties. The filter on ``row_number`` sits directly on
    the window, so each map task forwards at most one row per key before the
    single exchange: a key that holds a third of all rows costs no more in the
    reduce step than any other.

    ``hashed`` sorts by a hash of the key first. Keys with a long common prefix
    then compare by one number, which halves the sort; but a later join on the
    key can no longer reuse the exchange. Use it where no such join follows.
    """
    keys = [F.col(k) for k in ([key] if isinstance(key, str) else key)]
    window = Window.partitionBy(*([F.xxhash64(*keys)] if hashed else []), *keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def repeated_keys(df: DataFrame, key: str, min_rows: int = MANY_ROWS, most: int = MOST_REPEATED) -> DataFrame | None:
    """Hashes, ``_h``, of the keys that several rows have; None for a small table, or if they are too many to be sent around.

    One pass over the key column. Of keys with the same hash all count as repeated, so the answer may name a key too
    many and never one too few. The hashes are written once and read back.
    """
    spark, rows = df.sparkSession, df.count()
    if rows < min_rows:
        return None
    # A sketch, good to a twentieth, spares the exchange of the keys where far too many are repeated.
    if rows - df.agg(F.approx_count_distinct(F.xxhash64(key))).first()[0] > most + rows / 10:
        return None
    path = scratch_path(spark, "repeated")
    df.groupBy(F.xxhash64(key).alias("_h")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_h").write.parquet(path)
    found = spark.read.schema("_h bigint").parquet(path)
    return found if found.count() <= most else None


def latest_of_repeated(
    df: DataFrame, key: str, newest_first: Sequence[Column], repeated: DataFrame | None, hashed: bool = False
) -> DataFrame:
    """``latest_by_key`` that ranks only the rows whose key is among ``repeated_keys``; a row alone with its key is the newest.

    Rows that are alone are neither sorted nor exchanged, and columns of theirs that nobody asks for are not computed,
    though they are part of the order.
    """
    if repeated is None:
        return latest_by_key(df, key, newest_first, hashed)
    if repeated.isEmpty():
        return df
    told, few = df.withColumn("_h", F.xxhash64(key)), F.broadcast(repeated)  # at most MOST_REPEATED numbers
    alone, several = (told.join(few, "_h", how).drop("_h") for how in ("left_anti", "left_semi"))
    return alone.unionByName(latest_by_key(several, key, newest_first, hashed))
