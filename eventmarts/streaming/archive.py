"""Typed topic to the validated, append-only bronze table, with its dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmarts.contracts import EventType
from eventmarts.operators.validation import accepted, rejected, validate_flat
from eventmarts.sources.ledger import Ledger, Unit
from eventmarts.sources.tables import DAY_COLUMNS, with_day_columns, write_unit
from eventmarts.streaming.batches import batch_key, start


def archive_stream(
    records: DataFrame,
    event: EventType,
    bronze: str,
    dlq: str,
    checkpoint: str,
    *,
    ingest_ts: Column | None = None,
    summary: dict[str, int] | None = None,
    ledger: Ledger | None = None,
    drain: bool = True,
    **options,
) -> StreamingQuery:
    """Validate each micro-batch and write good rows to bronze, bad ones to the dead letters.

    ``ingest_ts`` is the batch's own time, recorded in the checkpoint: one value per batch,
    and the same value when a batch is repeated.  ``summary`` collects how many rows this
    run archived and quarantined.  ``ledger`` gets each batch after its rows are written, so a
    load that goes by it may run at any time beside this stream.
    """
    stamp = F.current_timestamp() if ingest_ts is None else ingest_ts
    checked = validate_flat(records, event).withColumn("ingest_ts", stamp)
    totals = {} if summary is None else summary
    totals.update(archived_this_run=0, dlq_this_run=0)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            key = batch_key(batch, batch_id)
            good = with_day_columns(accepted(rows, event))
            bad = rejected(rows, event, F.col("ingest_ts"))
            measures = {
                "days": F.collect_set("ingest_day"),
                "newest": F.max(F.unix_micros(F.col("created_at").cast("timestamp"))),
            }
            seen = write_unit(good, bronze, "batch", key, DAY_COLUMNS, **measures)
            totals["archived_this_run"] += seen["rows"]
            totals["dlq_this_run"] += write_unit(bad, dlq, "batch", key)["rows"]
            if ledger is not None:
                # The stamp is one value per batch, so a batch has one day, or no rows.
                days = seen["days"] or [None]
                ledger.add([Unit(key, day, seen["rows"], seen["newest"]) for day in days], key)
        finally:
            rows.unpersist()

    return start(checked, each_batch, checkpoint, drain=drain, **options)
