"""Raw lines to typed topics, dead letters and counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmarts.contracts import EVENT_TYPES
from eventmarts.operators.progress import ingest_counters, topic_partition
from eventmarts.operators.routing import DEAD, VALID, raw_payload, route_events
from eventmarts.sources.raw import WANTED, select_events
from eventmarts.sources.tables import write_unit
from eventmarts.streaming.batches import batch_key, start


#: Event times leave with all their microseconds.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def outgoing(routed: DataFrame, line: str = "value") -> DataFrame:
    """What leaves the router: one JSON payload per row, flat for a valid event, the original
    for a dead letter, none for a skipped line."""
    payload = F.when(F.col("route") == DEAD, raw_payload(line))
    for event in EVENT_TYPES.values():
        ours = (F.col("route") == VALID) & (F.col("event_type") == event.name)
        payload = payload.when(ours, F.to_json(F.struct(*event.record.names), _JSON))
    return routed.select(
        "route",
        "reason",
        "event_type",
        "intended_topic",
        payload.alias("payload"),
        topic_partition("did").alias("kafka_partition"),
        F.col("cursor").alias("kafka_offset"),
    )


def ingest_stream(
    lines: DataFrame,
    topics: dict[str, str],
    dlq: str,
    counters: str,
    checkpoint: str,
    *,
    cursor: int | None = None,
    collections: Sequence[str] | None = None,
    drain: bool = True,
    **options,
) -> StreamingQuery:
    """Route each micro-batch once and write its parts.

    With ``cursor`` or ``collections`` the stream is a subscription: only events above the
    cursor and of the wanted collections are taken from the lines.

    A topic record has its author's partition, and the event's cursor as its offset.  The
    offsets of a batch are committed by the checkpoint after all its writes; a batch
    interrupted in between is repeated; it overwrites its own unfinished parts and leaves
    finished ones alone, which an archive may have read by then.
    """
    if cursor is not None or collections is not None:
        lines = select_events(lines, cursor, WANTED if collections is None else collections)
    routed = outgoing(route_events(lines)).withColumn("received_at", F.current_timestamp())

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            key = batch_key(batch, batch_id)
            for name, path in topics.items():
                ours = (F.col("route") == VALID) & (F.col("event_type") == name)
                topic = rows.where(ours).select("payload", "kafka_partition", "kafka_offset")
                write_unit(topic, path, "batch", key, once=True)
            dead = rows.where(F.col("route") == DEAD).select(
                F.col("payload").alias("raw_payload"),
                F.col("reason").alias("error"),
                "intended_topic",
                "received_at",
            )
            write_unit(dead, dlq, "batch", key, once=True)
            write_unit(ingest_counters(rows), counters, "batch", key, once=True)
        finally:
            rows.unpersist()

    return start(routed, each_batch, checkpoint, drain=drain, **options)
