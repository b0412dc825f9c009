"""Following event logs: snapshots of what they say."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from plateflow.operators.eventlog import Fold, fold_batch


def stream_fold(events: DataFrame, fold: Fold, folder: str, checkpoint: str) -> StreamingQuery:
    """Keep a snapshot of a growing log of events in `folder`; read it by `eventlog.folded`.

    Each micro-batch reads its own events and the last snapshot, not the log.
    """
    return (
        events.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, number: fold_batch(batch, number, fold, folder))
        .start()
    )
