"""Joins that stay balanced when one key holds a large share of a side.

Spark's own skew handling splits only the preserved side of an outer join, and
only when the join is alone in its stage. ``spread_join`` covers the rest, in one
join on key and slice: rows of hot keys are salted into slices, and the rows
they meet are repeated once per slice. Rows of all other keys have slice 0.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot if it holds more rows than this many average tasks of a shuffle.
HOT_TASKS = 4
# At most so many keys per column are looked for; the frequency sketches are sized to find them.
MOST_KEYS = 2_000
# Below this many rows a single task copes without help.
HOT_ROWS = 1_000_000
# Slices of a key whose number of rows is not known.
SLICES = 64
# A sliced join has at least so many tasks a core, so that keys of unlike fan-out even out.
TASKS_PER_CORE = 4
# Rows of a key that a task of a join with fan-out holds while the other side's rows pass by.
BLOCK_ROWS = 1024

_SKETCH_GROUPS = 64


@dataclass(frozen=True)
class HotKeys:
    """Keys to slice; ``parts`` has the number of slices per key, ``null_parts`` that of NULL, if known."""

    keys: tuple[str, ...] = ()
    null: bool = False
    parts: tuple[int, ...] = ()
    null_parts: int = 0

    def __bool__(self) -> bool:
        return bool(self.keys) or self.null

    def slices(self, column: Column, unknown: int) -> Column:
        """The number of slices of a row's key, 1 for keys that are not hot."""
        by_number: dict[int, list[str]] = {}
        for key, number in zip(self.keys, self.parts or (unknown,) * len(self.keys), strict=True):
            by_number.setdefault(number, []).append(key)
        out = F.lit(1)
        for number, keys in sorted(by_number.items()):
            out = F.when(column.isin(*keys), F.lit(number)).otherwise(out)
        return F.when(column.isNull(), F.lit(self.null_parts or unknown)).otherwise(out) if self.null else out


COLD = HotKeys()


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> HotKeys:
    """Keys that hold more rows than a few tasks of a shuffle, and NULL if it does."""
    return hot_keys_each({key: (df, key)}, min_rows)[key]


def hot_keys_each(columns: Mapping[str, tuple[DataFrame, str]], min_rows: int = HOT_ROWS) -> dict[str, HotKeys]:
    """The hot keys of several (table, key column) pairs, found in one job.

    One scan of each key column without shuffling it: every task fills a
    fixed-size frequency sketch, and the sketches are merged in two steps. At
    most ``MOST_KEYS`` keys per pair reach the driver. The limit is a number of
    tasks, not of rows, so a task's load does not grow with the table. A table
    of fewer than ``min_rows`` rows can't have a key of so many, which a count
    tells; stored rows are counted by the files' footers.
    """
    result = dict.fromkeys(columns, COLD)
    columns = {label: (df, key) for label, (df, key) in columns.items() if df.count() >= min_rows}
    if not columns:
        return result
    frames = [df for df, _ in columns.values()]
    tasks = int(frames[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(1, min(MOST_KEYS, tasks // HOT_TASKS))
    tracked = max(1024, 4 * wanted)
    parts = [
        df.select(F.lit(label).alias("label"), F.pmod(F.spark_partition_id(), F.lit(_SKETCH_GROUPS)).alias("part"),
                  F.col(key).cast("string").alias("k"))
        for label, (df, key) in columns.items()
    ]
    found = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("label", "part")
        .agg(
            F.expr(f"approx_top_k_accumulate(k, {tracked})").alias("sketch"),
            F.count("*").alias("rows"),
            F.count_if(F.col("k").isNull()).alias("nulls"),
        )
        .groupBy("label")
        .agg(
            F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {wanted})").alias("top"),
            F.sum("rows").alias("rows"),
            F.sum("nulls").alias("nulls"),
        )
        .collect()  # one row per pair
    )
    for row in found:
        per_task = max(1, row.rows / max(tasks, 1))
        limit = max(min_rows, min(HOT_TASKS * per_task, row.rows / HOT_TASKS))

        def parts_of(rows: int, per_task: float = per_task) -> int:
            # Powers of two, so that few different numbers occur.
            return 1 << max(1, int(rows // per_task).bit_length())

        top = sorted((t["item"], t["count"]) for t in row.top if t["item"] is not None and t["count"] >= limit)
        null = row.nulls >= limit
        result[row.label] = HotKeys(tuple(k for k, _ in top), null, tuple(parts_of(n) for _, n in top),
                                    parts_of(row.nulls) if null else 0)
    return result


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    left_hot: HotKeys = COLD,
    right_hot: HotKeys = COLD,
    slices: int = SLICES,
    fan_out: bool = False,
) -> DataFrame:
    """Equi-join on ``key`` with the hot keys of either side sliced, in one join.

    ``how`` is inner, left, left_semi or left_anti. The hot sets are hints: a
    key listed too much or left out changes the plan, never the result.

    ``fan_out`` is for inner and left joins whose keys have many rows on both
    sides, so that far more come out than go in. Of an inner join the side of
    fewer rows is then the one that tasks hold, and the side that is held is cut
    into blocks of ``BLOCK_ROWS``: a task's memory is bounded, a key's pairs come
    from as many tasks as it has blocks, and rows come out in short cycles beside
    a value that stays, which columnar files store in a fraction of the space.
    Both sides are counted for it and the keys of one, so they should be stored.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    if fan_out and how in ("inner", "left"):
        turned = how == "inner" and not _shared(left, right, key) and left.count() < right.count()
        if turned:
            out = spread_join(right, left, key, how, right_hot, _in_blocks(left, key, left_hot, slices), slices)
            return out.select(key, *[c for c in (*left.columns, *right.columns) if c != key])
        right_hot = _in_blocks(right, key, right_hot, slices)
    if how in ("left_semi", "left_anti"):
        # Only the keys matter on this side; one row each cannot be hot.
        right = right.select(key).distinct()
        right_hot = COLD
    right_hot = HotKeys(right_hot.keys, False, right_hot.parts)  # NULL meets nothing
    if not (left_hot or right_hot):
        return left.join(right, key, how)

    column = F.col(key)
    kept = left.columns
    left_parts, right_parts = left_hot.slices(column, slices), right_hot.slices(column, slices)
    sides = left.withColumn("_l", _slot(left, left_parts)), right.withColumn("_r", _slot(right, right_parts))
    if how == "left" and right_hot:
        # A key that the right side does not have must not be repeated, or its rows would come out once per slice.
        there = right.filter(column.isin(*right_hot.keys)).select(key).distinct().withColumn("_there", F.lit(True))
        first = sides[0].join(F.broadcast(there), key, "left")  # at most one row per hot key
        repeated = F.when(F.col("_there"), right_parts).otherwise(F.lit(1))
    else:
        first, repeated = sides[0].withColumn("_there", F.lit(True)), right_parts
    first = first.withColumn("_r", F.explode(F.sequence(F.lit(0), repeated - 1)))
    # NULL meets nothing, so only keys are repeated.
    met = HotKeys(left_hot.keys, False, left_hot.parts).slices(column, slices)
    second = sides[1].withColumn("_l", F.explode(F.sequence(F.lit(0), met - 1)))
    first, second = _dealt(first, key), _dealt(second, key)
    if how != "left":
        return first.join(second, [key, "_l", "_r"], how).drop("_l", "_r", "_there")
    joined = first.join(second.withColumn("_hit", F.lit(True)), [key, "_l", "_r"], "left")
    if right_hot:
        # Such a key matches in some slice; what its other slices left without a match is no result.
        single = ~F.coalesce(F.col("_there"), F.lit(False)) | ~F.coalesce(column.isin(*right_hot.keys), F.lit(False))
        joined = joined.filter(F.col("_hit").isNotNull() | single)
    return joined.select(*kept, *[c for c in right.columns if c != key])


def _shared(left: DataFrame, right: DataFrame, key: str) -> set[str]:
    """Names of both sides other than the key's, which can't be told apart in the result."""
    return ({c.lower() for c in left.columns} & {c.lower() for c in right.columns}) - {key.lower()}


def _in_blocks(side: DataFrame, key: str, hot: HotKeys, unknown: int) -> HotKeys:
    """``hot`` with so many slices for each key that one holds about ``BLOCK_ROWS`` rows. At most ``MOST_KEYS`` keys are added."""
    large = side.filter(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("k")).agg(F.count("*").alias("n")).filter(
        F.col("n") > BLOCK_ROWS).orderBy(F.desc("n"), "k").limit(MOST_KEYS).collect()
    parts = dict(zip(hot.keys, hot.parts or (unknown,) * len(hot.keys), strict=True))
    for row in large:
        # Powers of two, so that few different numbers occur.
        parts[row.k] = max(parts.get(row.k, 1), 1 << (row.n // BLOCK_ROWS).bit_length())
    return HotKeys(tuple(parts), hot.null, tuple(parts.values()), hot.null_parts)


def _dealt(side: DataFrame, key: str) -> DataFrame:
    """One side of the sliced join by key and slice, in a fixed number of tasks.

    The join meets both sides as they are and exchanges neither again. A side small enough for Spark to broadcast
    would else leave the other one in the few tasks its files are read in, and small shuffles would be put together,
    whatever number of rows comes out of them.
    """
    spark = side.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    return side.repartition(tasks, key, "_l", "_r")


def bounded_broadcast(
    df: DataFrame, row_bytes: int, limit_bytes: int = 64 << 20, superset: DataFrame | None = None
) -> DataFrame | None:
    """``df`` marked for broadcast if it provably fits, else None.

    ``row_bytes`` is the most one row can take. A ``superset`` that is cheaper to
    count, such as the stored rows ``df`` is computed from, is tried first.
    """
    allowed = max(1, limit_bytes // row_bytes)
    for rows in (superset, df):
        # A plain count: one number per task, for stored rows from the files' footers.
        if rows is not None and rows.count() <= allowed:
            return F.broadcast(df)
    return None


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    row_bytes: int,
    raw_facts: DataFrame | None = None,
    raw_dimension: DataFrame | None = None,
) -> DataFrame:
    """Left join to a dimension that is unique by key, broadcast if it fits, else sliced by hot keys.

    The raw tables, if given, answer the questions about size and hot keys
    without computing the tables made from them.
    """
    small = bounded_broadcast(dimension, row_bytes, superset=raw_dimension)
    if small is not None:
        return facts.join(small, key, "left")
    return spread_join(facts, dimension, key, left_hot=hot_keys(raw_facts if raw_facts is not None else facts, key))


def _slot(df: DataFrame, parts: Column) -> Column:
    """The slice of a row, from its content, so a re-run task puts each row in the same slice."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), parts.cast("bigint")).cast("int")
