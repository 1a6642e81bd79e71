"""Where raw rows, ledgers and results live, and which of them count.

Each attempt at a batch writes into folders of its own, and its one commit row last. Readers look at
committed attempts only, so one that died half-way leaves nothing visible but the row that says it began.
"""

from __future__ import annotations

import random
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ledger import FILE_EVENTS, RUN_EVENTS, file_states, run_states
from ..operators.quality import COUNT_CHECKS, FRESHNESS, RESULTS
from ..operators.skew import bounded_broadcast
from ..operators.states import STATES
from ..specs import SOURCES, raw_schema, source

STARTS = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("attempt", T.StringType()),
    T.StructField("job_id", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
])
COMMITS = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("attempt", T.StringType()),
    T.StructField("committed_at", T.TimestampNTZType()),
    T.StructField("files_discovered", T.LongType()),
    T.StructField("files_loaded", T.LongType()),
    T.StructField("files_failed", T.LongType()),
    T.StructField("files_skipped", T.LongType()),
    T.StructField("status", T.StringType()),
])
OUTCOMES = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("disposition", T.StringType()),
    T.StructField("target", T.StringType()),
])


# Quality tables: what each check found, run by run.
QUALITY = {"results": RESULTS, "freshness": FRESHNESS, "row_counts": COUNT_CHECKS}


def with_field(schema: T.StructType, name: str, dtype: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, dtype)])


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        """The table, or no rows if nothing has been written to it."""
        try:
            return self.spark.read.schema(schema).parquet(path).select(*schema.names)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def append(self, df: DataFrame, *parts: str) -> None:
        # Raw rows are text: a quarter smaller than with Spark's usual codec.
        df.write.mode("append").option("compression", "zstd").parquet(self.path(*parts))

    def append_alone(self, df: DataFrame, *parts: str) -> None:
        """Append to a table that several jobs may write to at once: each into a folder of its own."""
        self.append(df, *parts, f"_part={uuid.uuid4().hex}")

    def commits(self) -> DataFrame:
        """One row per finished batch: of several attempts that finished, the first counts."""
        rows = self._read(self.path("metadata", "batches"), COMMITS)
        first = F.min_by(F.struct(*COMMITS.names), F.struct("committed_at", "attempt")).alias("c")
        return rows.groupBy(F.col("batch_id").alias("_batch")).agg(first).select("c.*")

    def finished(self, batch_id: str) -> dict | None:
        """The commit row of a batch, if it has been committed."""
        row = self.commits().filter(F.col("batch_id") == batch_id).first()
        return row and row.asDict()

    def pipeline_runs(self) -> DataFrame:
        """One row per batch, from its first start on; one that did not finish shows as running."""
        starts = self._read(self.path("metadata", "batch_starts"), STARTS).groupBy("batch_id").agg(
            F.min("job_id").alias("job_id"), F.min("started_at").alias("started_at"))
        done = self.commits().withColumnRenamed("committed_at", "finished_at").drop("attempt")
        rows = starts.join(done, "batch_id", "full")
        counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("files_discovered", "files_loaded", "files_failed", "files_skipped")]
        return rows.select("batch_id", "job_id", "started_at", "finished_at", *counts,
                           F.coalesce("status", F.lit("running")).alias("status"))

    def claim(self, n: int) -> int:
        """The first of ``n`` numbers that no other batch has or gets, however many are at work.

        A claim is a file that says its range in its name. Who has written one looks for others that overlap, and
        if there is any, leaves the range and tries behind it. Of two claims the later writer sees the earlier
        one, so never do both stand. The store must list what has been written; nothing more is asked of it.
        """
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(self.path("metadata", "claims"))
        store = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        store.mkdirs(folder)

        def claims() -> dict[str, tuple[int, int]]:
            names = [status.getPath().getName() for status in store.listStatus(folder)]
            return {name: (int(name.split(".")[0]), int(name.split(".")[1])) for name in names}

        tries = 0
        while True:
            start = max((first + size for first, size in claims().values()), default=1)
            own = f"{start:019d}.{n}.{uuid.uuid4().hex}"
            store.create(hadoop.Path(folder, own)).close()
            if not any(first < start + n and start < first + size for name, (first, size) in claims().items() if name != own):
                return start
            tries += 1
            time.sleep(random.uniform(0, min(2, 0.02 * 2**tries)))

    def _of_commits(self, path: str, schema: T.StructType) -> DataFrame:
        """Rows of finished batches, with ``batch_id`` and the attempt, ``_batch_id``, which is their folder."""
        rows = self._read(path, with_field(schema, "_batch_id", T.StringType()))
        done = self.commits().select(F.col("attempt").alias("_batch_id"), F.col("batch_id").alias("_batch"))
        return rows.join(done, "_batch_id").select(*schema.names, "_batch_id", "_batch")

    def file_events(self) -> DataFrame:
        return self._of_commits(self.path("metadata", "file_events"), FILE_EVENTS).drop("_batch_id", "_batch")

    def run_events(self) -> DataFrame:
        return self._of_commits(self.path("metadata", "run_events"), RUN_EVENTS).drop("_batch_id", "_batch")

    def source_files(self) -> DataFrame:
        """State of every registered file, with the batch it came in. Numbers are unique (``claim``)."""
        events = self._of_commits(self.path("metadata", "file_events"), FILE_EVENTS).drop("_batch_id")
        return file_states(events.withColumnRenamed("_batch", "batch_id"), "batch_id")

    def ingestion_runs(self) -> DataFrame:
        """State of every run, with its batch. Numbers are unique (``claim``)."""
        events = self._of_commits(self.path("metadata", "run_events"), RUN_EVENTS).drop("_batch_id")
        return run_states(events.withColumnRenamed("_batch", "batch_id"), "batch_id")

    def outcomes(self) -> DataFrame:
        return self._of_commits(self.path("metadata", "outcomes"), OUTCOMES).drop("_batch_id", "_batch")

    def record_quality(self, table: str, rows: DataFrame) -> None:
        """Append the rows of one run to ``results``, ``freshness`` or ``row_counts``; earlier runs stay."""
        schema = QUALITY[table]
        self.append_alone(rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), "quality", table)

    def quality(self, table: str) -> DataFrame:
        """All rows recorded so far."""
        return self._read(self.path("quality", table), QUALITY[table])

    def raw(self, name: str) -> DataFrame:
        """Raw rows of all successfully loaded files."""
        stored = with_field(raw_schema(name), "_fault", T.StringType())
        rows = self._of_commits(self.path("raw", name), stored)
        runs = self._of_commits(self.path("metadata", "run_events"), RUN_EVENTS)
        failed = runs.filter(F.col("status") == "failed").select("_batch_id", F.col("ingestion_run_id").alias("_ingestion_run_id"))
        few = bounded_broadcast(failed, row_bytes=128)
        return rows.join(failed if few is None else few, ["_batch_id", "_ingestion_run_id"], "left_anti").select(*raw_schema(name).names)

    def written(self, name: str, folder: str) -> DataFrame:
        """Run ids, faults and what the checks count of the rows a batch wrote, committed or not."""
        stored = with_field(raw_schema(name), "_fault", T.StringType())
        rows = self._read(self.path("raw", name, folder), stored)
        return rows.select("_ingestion_run_id", "_loaded_at", "_fault", F.col(source(name).key).isNull().alias("_keyless"))

    def table_states(self) -> DataFrame:
        """What the checks count of the raw tables, per committed batch."""
        return self._of_commits(self.path("metadata", "table_states"), STATES).drop("_batch_id", "_batch")

    def raw_tables(self) -> dict[str, DataFrame]:
        return {name: self.raw(name) for name in SOURCES}
