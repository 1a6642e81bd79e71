"""Incremental pickup of dated files as a stream of file names.

The stream notices new paths; the checksum ledger still decides what is loaded.
A stream remembers paths, so use plain batches for snapshots that are delivered
again under the same name.
"""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from ..plans.ingest import AllFilesFailed, run_batch
from ..sources.lake import Lake

FILES_PER_TRIGGER = 5_000


def pick_up_available(
    lake: Lake, landing: str, checkpoint: str, files_per_trigger: int = FILES_PER_TRIGGER, job_id: str = "pickup"
) -> None:
    """Load the files that arrived since the last call, then stop.

    A batch is named by the stream and the micro-batch's number. One that is
    repeated after a failure is the same batch: it is left out if it has been
    committed, and what an attempt without a commit wrote never counts.
    """
    # A checkpoint folder is one stream, and numbers its micro-batches for good.
    stream = f"{job_id}-{hashlib.sha256(checkpoint.rstrip('/').encode()).hexdigest()[:12]}"

    def load(batch: DataFrame, epoch: int) -> None:
        # At most files_per_trigger names.
        paths = [row.path for row in batch.select("path").collect()]
        if not paths:
            return
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        try:
            run_batch(lake, landing, now, paths=paths, batch_id=f"{stream}-{epoch:09d}", job_id=job_id)
        except AllFilesFailed:
            pass  # recorded; the next files still get their turn

    (
        lake.spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(landing)
        .select("path")
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
