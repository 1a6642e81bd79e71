"""Pick up new files: discover, compare, validate, load, record.

One call is one batch. The steps that touch file contents run on the executors;
the driver handles header signatures and bounded chunks of file names.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce
from itertools import islice

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from py4j.protocol import Py4JError

from ..operators.ledger import FILE_EVENTS, RUN_EVENTS, archive_targets, batch_rollup, not_yet_loaded, outcomes
from ..operators.states import STATES, by_column
from ..sources.lake import COMMITS, OUTCOMES, STARTS, Lake
from ..sources.manifest import dated, fingerprint, recognise, validated
from ..sources.readers import SPLIT_BYTES, closed_files, read_csv_files, read_parquet_files
from ..specs import LINEAGE, SOURCES, lookup

FILES_PER_READ = 5_000
# Error conditions that speak of what is in a file ...
_DATA_FAULT = re.compile(r"\[(FAILED_READ_FILE|CANNOT_READ_FILE|MALFORMED|UNABLE_TO_INFER_SCHEMA|CANNOT_MERGE_SCHEMAS|"
                         r"FAILED_MERGE_SCHEMA|PARQUET|CAST_INVALID_INPUT|INVALID_UTF8)")
# ... unless one of these is behind them: the file could not be reached, or not at this moment.
_STORAGE_FAULT = re.compile(r"java\.net\.|java\.nio\.file\.|java\.nio\.channels\.|TimeoutException|InterruptedIOException|"
                            r"FileNotFoundException|AccessControlException|org\.apache\.hadoop\.(?:ipc|hdfs|security|fs\.\w+\.)|"
                            r"com\.amazonaws|software\.amazon|com\.google\.cloud|com\.microsoft\.azure|"
                            r"\[FAILED_READ_FILE\.FILE_NOT_EXIST|java\.io\.IOException: (?:Connection|Broken pipe|Filesystem closed|Input/output error)")


class AllFilesFailed(RuntimeError):
    """No file of a batch could be loaded."""


@dataclass(frozen=True)
class BatchResult:
    batch_id: str
    discovered: int
    loaded: int
    failed: int
    skipped: int = 0


def run_batch(
    lake: Lake,
    landing: str,
    batch_ts: datetime,
    paths: Sequence[str] | None = None,
    batch_id: str | None = None,
    on_extra: str = "fail",
    job_id: str = "ingest",
) -> BatchResult:
    """Load every file below ``landing`` whose content has not been loaded before.

    ``paths`` limits the batch to given files. ``on_extra`` says what a column
    the source does not have does to its file: ``fail`` or ``ignore``. A file's
    failure never stops the others; the batch raises only if all files failed,
    and then after recording them. A batch that has been committed under this
    ``batch_id`` is not run again; its result is returned.
    """
    began = time.monotonic()
    batch_id = batch_id or f"{batch_ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    if done := lake.finished(batch_id):
        return _result(done)
    # What a dead attempt left is never mixed with this one.
    attempt = f"{batch_id}.{uuid.uuid4().hex[:8]}"
    folder = f"_batch_id={attempt}"
    work = lake.path("work", folder)
    lake.append_alone(lake.spark.createDataFrame([(batch_id, attempt, job_id, batch_ts)], STARTS), "metadata", "batch_starts")
    files, skipped = _register(lake, landing, batch_ts, paths, on_extra, work)

    errors = _load_groups(lake, files, batch_ts, folder)
    result = _outcomes(lake, files, errors, folder, batch_ts, f"{work}/outcomes")
    commit = _commit_row(result, skipped, batch_id, attempt, batch_ts)
    _record(lake, result, skipped, time.monotonic() - began, commit, folder, job_id)
    if commit["status"] == "failed":
        raise AllFilesFailed(f"all {commit['files_failed']} file(s) of batch {batch_id} failed")
    return _result(commit)


def _result(commit: dict) -> BatchResult:
    return BatchResult(commit["batch_id"], commit["files_loaded"] + commit["files_failed"], commit["files_loaded"],
                       commit["files_failed"], commit["files_skipped"])


def _commit_row(result: DataFrame, skipped: DataFrame, batch_id: str, attempt: str, at: datetime) -> dict:
    """What the batch came to. Without a new file it is a success."""
    every = result.select("status").unionByName(skipped.select(F.lit("skipped").alias("status")))
    total = batch_rollup(every.withColumn("batch_id", F.lit(batch_id))).first()
    counts = ("files_discovered", "files_loaded", "files_failed", "files_skipped")
    return {"batch_id": batch_id, "attempt": attempt, "committed_at": at, **{c: total[c] if total else 0 for c in counts},
            "status": total["status"] if total else "success"}


def _register(
    lake: Lake, landing: str, batch_ts: datetime, paths: Sequence[str] | None, on_extra: str, work: str
) -> tuple[DataFrame, DataFrame]:
    """New files with ids, order and validation result, and the files whose content is known; written once and read back."""
    spark = lake.spark
    found = dated(recognise(fingerprint(spark, paths or landing), landing)).filter(F.col("checksum").isNotNull())
    found.write.parquet(f"{work}/manifest")  # contents are hashed once, whatever follows
    found = spark.read.parquet(f"{work}/manifest")
    unknown = not_yet_loaded(found, lake.source_files())
    unknown.write.parquet(f"{work}/new")
    unknown = spark.read.parquet(f"{work}/new")
    # A path is listed once.
    found.select("source_name", "file_name", "file_path").join(unknown.select("file_path"), "file_path", "left_anti").write.parquet(
        f"{work}/skipped")
    new = validated(unknown)

    order = {name: position for position, name in enumerate(SOURCES)}
    extra = F.array_except("file_columns", lookup(F.col("source_name"), lambda s: s.columns))
    surplus = F.when(F.col("is_valid") & (F.size(extra) > 0),
                     F.concat(F.lit("unexpected columns: "), F.array_join(extra, ", ")))

    # Position among the source's files by name: one row per file, not per record.
    by_name = Window.partitionBy("source_name").orderBy("file_name", "file_path")
    new = new.withColumns({
        "load_error": surplus if on_extra == "fail" else F.lit(None).cast("string"),
        "_position": F.row_number().over(by_name),
    })
    counts = {r["source_name"]: r["count"] for r in new.groupBy("source_name").count().collect()}  # one row per source
    before, n = {}, 0
    for name in sorted(counts, key=order.get):
        before[name], n = n, n + counts[name]
    ordinal = F.col("_position") + lookup(F.col("source_name"), lambda s: before.get(s.name, 0))
    first = lake.claim(n) if n else 1
    new = new.withColumns({
        "source_file_id": ordinal + (first - 1),
        "ingestion_run_id": ordinal + (first - 1),
        "loaded_at": F.timestamp_add("MICROSECOND", ordinal, F.lit(batch_ts).cast("timestamp_ntz")),
    })
    new.write.parquet(f"{work}/files")
    return spark.read.parquet(f"{work}/files"), spark.read.parquet(f"{work}/skipped")


def _chunks(rows: Iterator, size: int) -> Iterator[list]:
    while chunk := list(islice(rows, size)):
        yield chunk


def _load_groups(lake: Lake, files: DataFrame, batch_ts: datetime, folder: str) -> list[tuple[int, str]]:
    """Read and append the loadable files, group by group; the run ids that could not be read."""
    todo = files.filter(F.col("is_valid") & F.col("load_error").isNull())
    group = ["source_name", "file_type", "file_columns", "layout"]
    errors: list[tuple[int, str]] = []
    for key in todo.select(*group).distinct().collect():  # one row per header layout
        members = todo
        for column in group:
            members = members.filter(F.col(column).eqNullSafe(F.lit(key[column])))
        names = members.select("file_path", "load_path", "file_size_bytes", "ingestion_run_id", "file_name", "loaded_at")
        for chunk in _chunks(names.toLocalIterator(), FILES_PER_READ):
            errors += _load(lake, key, chunk, folder)
    return errors


def _load(lake: Lake, key, chunk: list, folder: str) -> list[tuple[int, str]]:
    """Append the rows of the files; on a read error, halve to find the files at fault."""
    if not chunk:
        return []
    spark, name = lake.spark, key["source_name"]
    try:
        if key["file_type"] == "csv":
            rows = _csv_rows(spark, chunk, name, key["file_columns"])
        else:
            rows = read_parquet_files(spark, [c.load_path for c in chunk], name)
        about = spark.createDataFrame(
            [(c.file_path, c.file_name, c.load_path, c.loaded_at, c.ingestion_run_id) for c in chunk],
            "_file string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LINEAGE.fields))
        # At most FILES_PER_READ short rows.
        rows = rows.join(F.broadcast(about), "_file")
        lake.append(rows.select(*SOURCES[name].columns, *LINEAGE.names, "_fault"), "raw", name, folder)
        return []
    except (PySparkException, Py4JError) as e:
        if not fault_of_file(e):
            raise  # a lost executor, a full disk or a store out of reach
        if len(chunk) == 1:
            return [(chunk[0].ingestion_run_id, str(e))]
        half = len(chunk) // 2
        return _load(lake, key, chunk[:half], folder) + _load(lake, key, chunk[half:], folder)


def fault_of_file(e: Exception) -> bool:
    """Whether a read failed for what is in the file, and would fail again. Judged by the error and by what caused it."""
    told, cause = [str(e)], getattr(e, "_origin", None) or getattr(e, "java_exception", None)
    while cause is not None and len(told) < 20:
        told.append(cause.toString())
        cause = cause.getCause()
    text = "\n".join(told)
    return bool(_DATA_FAULT.search(text)) and not _STORAGE_FAULT.search(text)


def _csv_rows(spark: SparkSession, chunk: list, name: str, header: Sequence[str]) -> DataFrame:
    """Rows of CSV files. Large ones are split if no cell of theirs spans lines; that changes the tasks, not the rows."""
    large = [c.load_path for c in chunk if c.file_size_bytes > SPLIT_BYTES]
    closed = set(closed_files(spark, large)) if large else set()
    parts = [([c.load_path for c in chunk if (c.file_path in closed) == by_lines], by_lines) for by_lines in (False, True)]
    return reduce(DataFrame.unionByName, [read_csv_files(spark, paths, name, header, by_lines) for paths, by_lines in parts if paths])


def _outcomes(
    lake: Lake, files: DataFrame, errors: list[tuple[int, str]], folder: str, batch_ts: datetime, out: str
) -> DataFrame:
    """Outcome per file, from the rows just written, and where the file goes."""
    spark = lake.spark
    written = reduce(DataFrame.unionByName, [lake.written(name, folder) for name in SOURCES])
    counts = written.groupBy(F.col("_ingestion_run_id").alias("ingestion_run_id")).agg(
        F.count("*").alias("rows_written"), F.min("_fault").alias("fault"), F.max("_loaded_at").alias("newest"),
        F.count_if("_keyless").alias("keyless"))
    unreadable = spark.createDataFrame(errors, "ingestion_run_id bigint, read_error string")
    joined = (
        files.join(counts, "ingestion_run_id", "left").join(unreadable, "ingestion_run_id", "left")
        .withColumn("load_error", F.coalesce("load_error", "read_error", "fault"))
        .withColumn("rows_loaded", F.coalesce("rows_written", F.lit(0)).cast("bigint"))
    )
    at = F.lit(batch_ts).cast("timestamp_ntz")
    archive_targets(outcomes(joined), lake.outcomes().select("disposition", "target"), at).write.parquet(out)
    return spark.read.parquet(out)


def _events(files: DataFrame, schema, steps: Sequence[tuple]) -> DataFrame:
    """One event row per step whose condition holds for the file."""
    rows = F.array_compact(F.array(*[
        F.when(condition, F.struct(F.lit(seq).cast("bigint").alias("event_seq"), status.alias("status"),
                                   error.cast("string").alias("error_message"), count.cast("bigint").alias("rows_loaded"),
                                   at.cast("timestamp_ntz").alias("event_at")))
        for seq, (condition, status, error, count, at) in enumerate(steps)
    ]))
    own = ("event_seq", "status", "error_message", "rows_loaded", "event_at")
    spread = files.withColumn("_e", F.explode(rows))
    return spread.select(*[
        F.col(f"_e.{f.name}" if f.name in own else f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _record(
    lake: Lake, result: DataFrame, skipped: DataFrame, seconds: float, commit: dict, folder: str, job_id: str
) -> None:
    """Append ledger events and outcomes, then the commit row that makes the batch count."""
    none, always = F.lit(None), F.lit(True)
    stamped = result.withColumn("job_id", F.lit(job_id))
    start = F.col("loaded_at")
    end = F.timestamp_add("MICROSECOND", F.lit(max(1, int(seconds * 1e6))), start)
    lake.append(_events(stamped, FILE_EVENTS, [
        (always, F.lit("discovered"), none, none, start),
        (F.col("is_valid"), F.lit("validated"), none, none, start),
        (always, F.col("file_status"), F.col("error"), none, end),
    ]), "metadata", "file_events", folder)
    has_run = F.col("run_status").isNotNull()
    lake.append(_events(stamped, RUN_EVENTS, [
        (has_run, F.lit("running"), none, none, start),
        (has_run, F.col("run_status"), F.col("error"), F.col("rows_loaded"), end),
    ]), "metadata", "run_events", folder)
    # Files that were skipped stay where they are.
    left = skipped.select("source_name", "file_name", F.lit("skipped").alias("status"), F.lit(0).cast("long").alias("rows_loaded"))
    every = result.unionByName(left, allowMissingColumns=True).withColumn("batch_id", F.lit(commit["batch_id"]))
    lake.append(every.select(*OUTCOMES.names), "metadata", "outcomes", folder)
    lake.append(_states(result), "metadata", "table_states", folder)
    finished = commit | {"committed_at": commit["committed_at"] + timedelta(seconds=seconds)}
    lake.append_alone(lake.spark.createDataFrame([tuple(finished[c] for c in COMMITS.names)], COMMITS), "metadata", "batches")


def _states(result: DataFrame) -> DataFrame:
    """What the checks count of the rows that were loaded, from the counts per file."""
    loaded = result.filter((F.col("status") == "success") & (F.col("rows_loaded") > 0))
    counts = loaded.groupBy("source_name", F.col("newest").cast("date").alias("loaded_on")).agg(
        F.sum("rows_loaded").alias("rows"), F.max("newest").alias("newest"), F.sum("keyless").alias("keyless"))
    key = lookup(F.col("source_name"), lambda s: s.key)
    return by_column(counts, F.concat(F.lit("raw."), "source_name"), [(key, F.col("keyless"))]).select(*STATES.names)
