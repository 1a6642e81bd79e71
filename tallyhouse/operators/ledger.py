"""Ledgers of source files, ingestion runs and batches.

Written tables take appends only, so a change of status is a new event row. The
present state of a file or run is derived from its events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import file_stem
from .skew import hot_keys, spread_join

_NTZ = T.TimestampNTZType()

FILE_EVENTS = T.StructType([
    T.StructField("source_file_id", T.LongType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("file_type", T.StringType()),
    T.StructField("file_size_bytes", T.LongType()),
    T.StructField("file_date", T.DateType()),
    T.StructField("checksum", T.StringType()),
    T.StructField("event_at", _NTZ),
    T.StructField("event_seq", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])

RUN_EVENTS = T.StructType([
    T.StructField("ingestion_run_id", T.LongType()),
    T.StructField("job_id", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("event_at", _NTZ),
    T.StructField("event_seq", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("error_message", T.StringType()),
])


def _newest(columns: list[str]) -> Column:
    values = F.struct(*columns)
    return F.max_by(values, F.struct("event_at", "event_seq")).alias("_newest")


def file_states(events: DataFrame, *within: str) -> DataFrame:
    """One row per registered file, known by its number ``within`` the given columns, which come first.

    ``loaded_at`` is the last time the file was loaded and outlives later
    status changes.
    """
    kept = [f.name for f in FILE_EVENTS.fields if f.name not in ("source_file_id", "event_at", "event_seq")]
    return (
        events.groupBy(*within, "source_file_id")
        .agg(
            _newest(kept),
            F.min("event_at").alias("discovered_at"),
            F.max(F.when(F.col("status") == "loaded", F.col("event_at"))).alias("loaded_at"),
        )
        .select(*within, "source_file_id", "_newest.*", "discovered_at", "loaded_at")
    )


def run_states(events: DataFrame, *within: str) -> DataFrame:
    """One row per ingestion run, known by its number ``within`` the given columns; an unfinished run has no finish time."""
    kept = ["job_id", "source_name", "file_name", "event_at", "status", "rows_loaded", "error_message"]
    return (
        events.groupBy(*within, "ingestion_run_id")
        .agg(_newest(kept), F.min("event_at").alias("started_at"))
        .select(
            *within, "ingestion_run_id", "_newest.job_id", "_newest.source_name", "_newest.file_name", "started_at",
            F.when(F.col("_newest.status") != "running", F.col("_newest.event_at")).alias("finished_at"),
            "_newest.rows_loaded", "_newest.status", "_newest.error_message",
        )
    )


def not_yet_loaded(files: DataFrame, states: DataFrame) -> DataFrame:
    """Files whose content has not been loaded before; failed ones come again.

    Many files may share one content, so the checksums that hold a large share
    of the files are spread over slices.
    """
    loaded = states.filter(F.col("status") == "loaded").select("checksum")
    return spread_join(files, loaded, "checksum", "left_anti", left_hot=hot_keys(files, "checksum"))


def outcomes(files: DataFrame) -> DataFrame:
    """What becomes of each new file.

    Needs ``validation_error``, ``load_error`` and ``rows_loaded``. An invalid
    file fails without a run; a load error fails file and run.
    """
    error = F.coalesce("validation_error", "load_error")
    return files.withColumns({
        "status": F.when(error.isNull(), "success").otherwise("failed"),
        "file_status": F.when(error.isNull(), "loaded").otherwise("failed"),
        "run_status": F.when(F.col("validation_error").isNull(), F.when(error.isNull(), "success").otherwise("failed")),
        "error": error,
        "rows_loaded": F.when(error.isNull(), F.col("rows_loaded")).otherwise(F.lit(0)),
        "disposition": F.when(error.isNull(), "archive/loaded").otherwise("archive/failed"),
    })


def archive_name(name: Column, taken: Column, at: Column) -> Column:
    """Target name in the archive; a taken name gets the time before its suffix."""
    return F.when(taken, _marked(name, F.date_format(at, "yyyyMMdd'T'HHmmss"))).otherwise(name)


def _marked(name: Column, mark: Column) -> Column:
    stem = file_stem(name)
    return F.concat(stem, F.lit("_"), mark, F.substring(name, F.length(stem) + 1, F.length(name)))


def archive_targets(files: DataFrame, taken: DataFrame, at: Column) -> DataFrame:
    """Adds ``target``, a name that no other file has where the file goes (``disposition``).

    ``taken`` has the names there already (disposition, target). The first file of a name keeps it, if it is
    free; another gets the time before its suffix, and where that name is in use as well, its number behind
    the time. Files without a disposition stay where they are and have no target.
    """
    held = taken.filter("target is not null").select("disposition", F.col("target").alias("_name")).distinct().withColumn("_held", F.lit(True))
    same = Window.partitionBy("disposition", "file_name").orderBy("source_name", "file_path")
    rows = files.withColumn("_at", F.row_number().over(same)).withColumn("_name", F.col("file_name")).join(
        held, ["disposition", "_name"], "left")
    rows = rows.withColumns({"_later": F.col("_at") - F.when(F.col("_held"), 0).otherwise(1), "_name": archive_name(
        F.col("file_name"), F.lit(True), at)}).drop("_held")
    # A name with a time may be in use by earlier files, or be the own name of a file of this batch.
    own = files.select("disposition", F.col("file_name").alias("_name"), F.lit(True).alias("_held"))
    rows = rows.join(held.unionByName(own).distinct(), ["disposition", "_name"], "left")
    stamped = F.when((F.col("_later") == 1) & F.col("_held").isNull(), F.col("_name")).otherwise(
        _marked(F.col("_name"), F.col("source_file_id").cast("string")))
    target = F.when(F.col("_later") == 0, F.col("file_name")).otherwise(stamped)
    return rows.withColumn("target", F.when(F.col("disposition").isNotNull(), target)).drop("_name", "_held", "_at", "_later")


def batch_rollup(outcome: DataFrame) -> DataFrame:
    """Counts and overall status per batch from rows with ``batch_id`` and ``status``.

    A status other than success or failed counts as skipped.
    """
    status = F.col("status")
    loaded, failed = F.count_if(status == "success"), F.count_if(status == "failed")
    return outcome.groupBy("batch_id").agg(
        F.count("*").alias("files_discovered"),
        loaded.alias("files_loaded"),
        failed.alias("files_failed"),
        F.count_if(status.isNull() | ~status.isin("success", "failed")).alias("files_skipped"),
        F.when(failed == 0, "success").when(loaded == 0, "failed").otherwise("partial").alias("status"),
    )
