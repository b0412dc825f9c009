"""Following jobs as a stream of status rows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plateflow.operators.jobs import finished, job_states
from plateflow.streaming.families import GRACE, ending_state, family_progress


def once(rows: DataFrame, watermark: str | None = None) -> DataFrame:
    """The first row of each job.

    Without a `watermark` the stream remembers every job name for good. With one on `ts` it forgets those
    that old: a job reported again later than that is new.
    """
    if watermark is None:
        return rows.dropDuplicates(["job_name"])
    timed = rows.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need an instant
    return timed.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["job_name"])


def errors_once(status: DataFrame, watermark: str | None = None) -> DataFrame:
    """Each failed job once."""
    failed = job_states(status).where(F.col("state").isin("failed", "error"))
    return once(failed, watermark).select("job_name", "sub_id", "analysis_id")


def ended(status: DataFrame) -> DataFrame:
    """Rows of ended jobs, as often as their status is reported."""
    return finished(job_states(status)).where(F.col("job_family").isNotNull())


def write_batches(stream: DataFrame, path: str, checkpoint: str, mode: str, keep=None) -> StreamingQuery:
    """Write every micro-batch to its own folder `batch_id=...`.

    A replayed batch overwrites its own folder, so each result is there exactly once.
    """
    def write(batch: DataFrame, number: int) -> None:
        rows = batch if keep is None else batch.where(keep)
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def stream_errors_once(status: DataFrame, path: str, checkpoint: str, watermark: str | None = None) -> StreamingQuery:
    """Write each failed job once."""
    return write_batches(errors_once(status, watermark), path, checkpoint, "append")


def stream_progress(status: DataFrame, path: str, checkpoint: str, grace: timedelta = GRACE) -> StreamingQuery:
    """Write the families that changed in each micro-batch."""
    with ending_state(status.sparkSession):
        return write_batches(family_progress(ended(status), grace), path, checkpoint, "update")


def stream_complete(status: DataFrame, path: str, checkpoint: str, grace: timedelta = GRACE) -> StreamingQuery:
    """Write each family once, in the micro-batch that completes it.

    `status` are job status rows, or those of `sources.markers.stream_markers`. What is known of a family's jobs is dropped when it
    is complete, and the family itself once `grace` is over.
    """
    with ending_state(status.sparkSession):
        complete = F.col("done") == F.col("total")
        return write_batches(family_progress(ended(status), grace), path, checkpoint, "update", keep=complete)


def latest_progress(spark: SparkSession, path: str) -> DataFrame:
    """Current progress from the folders of `stream_progress`."""
    changes = spark.read.parquet(path)
    return changes.groupBy("job_family").agg(
        F.max_by("done", "batch_id").alias("done"), F.max_by("total", "batch_id").alias("total")
    )
