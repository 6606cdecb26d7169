"""What every stream job shares: naming a micro-batch and starting a query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from eventmarts.contracts import FLUSH_SECONDS


def batch_key(batch: DataFrame, batch_id: int) -> str:
    """Name of a micro-batch that is the same when the batch is retried.

    Batch numbers start again with a new checkpoint, so the name carries the query's own id,
    which lives in the checkpoint.  A stream restarted without its checkpoint repeats rows
    under new names, which deduplication collapses; it never overwrites the old ones.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id:012d}"


def start(
    rows: DataFrame,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    drain: bool = True,
    every_seconds: float = FLUSH_SECONDS,
    mode: str = "append",
) -> StreamingQuery:
    """Start a job: ``drain`` reads what is there now and stops; otherwise a batch per interval."""
    writer = rows.writeStream.outputMode(mode).foreachBatch(each_batch)
    writer = writer.option("checkpointLocation", checkpoint)
    if drain:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{every_seconds} seconds").start()
