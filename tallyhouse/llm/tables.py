"""Reading test tables, written intermediates and small column helpers shared by the operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyhouse.session import scratch_path

# Fixed value: what separates words in every contract (space and the controls 9 to 13).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage: what follows survives the loss of executors without
    running the steps before it again.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column_or(df: DataFrame, name: str, kind: str) -> Column:
    """The column as ``kind``, or nulls where the table has none."""
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)


def text_of(df: DataFrame, name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(column_or(df, name, "string"), F.lit(""))


def small_batches(spark: SparkSession, rows: int = 200) -> SparkSession:
    """Let Python tasks see few rows at a time, since texts can be long, and find this package where it lies."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark


def ranked(values: DataFrame, name: str) -> DataFrame:
    """``values`` with ``rank`` from 0 in code-point order of ``name``, null last; no task sees all rows.

    Ranges of the sorted column are ranked alone, then shifted by the number of rows in the ranges before.
    """
    order = F.col(name).asc_nulls_last()
    spread = written(
        values.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ranges")
    before, start = {}, 0
    # One row for each partition, whatever the number of values.
    for row in spread.groupBy("_range").count().orderBy("_range").collect():
        before[row["_range"]], start = start, start + row["count"]
    shifts = spread.sparkSession.createDataFrame(
        list(before.items()), T.StructType([T.StructField("_range", T.IntegerType()),
                                            T.StructField("_before", T.LongType())]))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return (spread.withColumn("_inside", inside).join(F.broadcast(shifts), "_range")
            .withColumn("rank", F.col("_before") + F.col("_inside")).drop("_range", "_before", "_inside"))
