"""Tables that are replaced as a whole: a folder for each build, and a pointer written last.

A build writes its tables below a folder of its own. Only when all of them are there does one pointer file
name them, and readers follow the newest pointer of a table. So a build that dies leaves what was there
before, tables of one build change together, and a reader that has opened a table keeps its files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTERS = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("generation", T.StringType()),
    T.StructField("number", T.LongType()),
    T.StructField("published_at", T.TimestampNTZType()),
])


class NotPublished(LookupError):
    """No build of the table has been published."""


def new_generation(at: datetime) -> str:
    return f"{at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


class Generations:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, generation: str, table: str) -> str:
        return f"{self.root}/generations/{generation}/{table}"

    def write(self, df: DataFrame, table: str, generation: str, sort_by: str | None = None, bucket_by: str | None = None) -> DataFrame:
        """Write a table of one build and read it back; nobody else sees it yet.

        With ``sort_by`` the files cover disjoint, sorted ranges of that column. With ``bucket_by`` they are sorted
        buckets of it, as many as a shuffle has partitions, so that tables so written join on it without one; the
        session's catalog then knows the table under a name of this build.
        """
        if bucket_by:
            buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            name = f"{table}_{generation}".replace("-", "_")
            # One file for each bucket.
            df.repartition(buckets, bucket_by).write.bucketBy(buckets, bucket_by).sortBy(bucket_by).format("parquet").option(
                "path", self.path(generation, table)).saveAsTable(name)
            return self.spark.table(name)
        if sort_by:
            df = df.repartitionByRange(F.col(sort_by)).sortWithinPartitions(sort_by)
        path = self.path(generation, table)
        df.write.parquet(path)  # fails if the build has written the table before
        return self.spark.read.schema(df.schema).parquet(path)

    def publish(self, generation: str, tables: Iterable[str], at: datetime) -> None:
        """Point readers to the tables of a build. One file of one task: they all change at once, or none."""
        tables = sorted(tables)
        number = 1 + (self._pointers().agg(F.max("number")).first()[0] or 0)
        rows = [(t, generation, number, at) for t in tables]
        # In a folder of its own, since another build may publish at the same time.
        self.spark.createDataFrame(rows, POINTERS).coalesce(1).write.parquet(f"{self.root}/pointers/_build={uuid.uuid4().hex}")

    def _pointers(self) -> DataFrame:
        try:
            return self.spark.read.schema(POINTERS).parquet(f"{self.root}/pointers").select(*POINTERS.names)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], POINTERS)

    def current(self) -> DataFrame:
        """The pointer that counts for each table. Of builds published at once, the later time and name count."""
        newest = F.max_by(F.struct("generation", "number", "published_at"), F.struct("number", "published_at", "generation"))
        return self._pointers().groupBy("table_name").agg(newest.alias("p")).select("table_name", "p.*")

    def read(self, table: str) -> DataFrame:
        """The published table."""
        row = self.current().filter(F.col("table_name") == table).first()
        if row is None:
            raise NotPublished(f"{table} has not been published below {self.root}")
        return self.spark.read.parquet(self.path(row["generation"], table))

    def create_views(self) -> list[str]:
        """A view for each published table, of its present generation; their names."""
        names = [r["table_name"] for r in self.current().select("table_name").collect()]  # one row per table
        for name in names:
            self.read(name).createOrReplaceTempView(name)
        return sorted(names)

    def superseded(self) -> DataFrame:
        """``table_name, generation, path`` of published tables that no reader is sent to any more.

        Readers that opened one may still be at work, so when to remove it is up to the caller.
        """
        old = self._pointers().select("table_name", "generation").distinct().join(
            self.current().select("table_name", "generation"), ["table_name", "generation"], "left_anti")
        return old.withColumn("path", F.concat_ws("/", F.lit(self.root), F.lit("generations"), "generation", "table_name"))
