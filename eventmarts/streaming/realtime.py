"""Typed topic straight to the versioned real-time table, and windowed counts on the stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmarts.contracts import POST, REALTIME
from eventmarts.functions.times import arrival_millis
from eventmarts.operators.dedup import latest_per_key
from eventmarts.operators.validation import validate_flat
from eventmarts.sources.tables import read_table, write_unit
from eventmarts.streaming.batches import batch_key, start

# Position of a record in its topic, kept beside the contract's columns: records that
# arrive in one micro-batch share their arrival stamp, and the later one has to win.
_POSITION = [("kafka_partition", "int"), ("kafka_offset", "bigint")]
VERSION = ("ingested_at", "kafka_partition", "kafka_offset", "cid")


def typed_posts(topic: DataFrame) -> DataFrame:
    """Posts of a payload topic in their own columns, with their topic position.

    Records that break the contract are left out here; the archive of the same topic sends
    them to the dead letters.
    """
    checked = validate_flat(topic, POST).where(F.col("error").isNull())
    return checked.select(*POST.record.names, *[n for n, _ in _POSITION])


def realtime_stream(
    posts: DataFrame,
    path: str,
    checkpoint: str,
    *,
    ingested_at: Column | None = None,
    drain: bool = True,
    **options,
) -> StreamingQuery:
    """Append typed posts with their arrival stamp.

    ``posts`` has the post columns and the topic position; ``created_at`` may still be in
    microseconds.  No shuffle.
    """
    created = F.col("created_at")
    if posts.schema["created_at"].dataType.typeName() == "long":
        created = F.timestamp_micros("created_at")
    stamped = (
        posts.withColumn("created_at", created)
        .withColumn("langs", F.coalesce("langs", F.array().cast("array<string>")))
        .withColumn("ingested_at", arrival_millis() if ingested_at is None else ingested_at)
        .select(*REALTIME.names, *[n for n, _ in _POSITION])
    )

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        write_unit(batch, path, "batch", batch_key(batch, batch_id))

    return start(stamped, each_batch, checkpoint, drain=drain, **options)


def read_realtime(spark: SparkSession, path: str) -> DataFrame:
    """Every stored version, with its topic position."""
    return read_table(spark, path, REALTIME, _POSITION)


def realtime_latest(spark: SparkSession, path: str) -> DataFrame:
    """The deduplicated view dashboards read."""
    return latest_per_key(read_realtime(spark, path), VERSION).select(*REALTIME.names)


def minute_stream(
    events: DataFrame, path: str, checkpoint: str, column: str = "created_at", *, drain: bool = True, **options
) -> StreamingQuery:
    """Count events by minute, each micro-batch for itself.

    A batch stores its own counts, so there is no state and no watermark: an event counts
    whenever it arrives and whatever its clock says.  ``minute_counts`` adds the batches up.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        minutes = (
            batch.groupBy(F.window(column, "1 minute"))
            .agg(F.count(F.lit(1)).alias("posts"))
            .select(F.col("window.start").alias("time"), "posts")
        )
        write_unit(minutes, path, "batch", batch_key(batch, batch_id))

    return start(events, each_batch, checkpoint, drain=drain, **options)


def minute_counts(spark: SparkSession, path: str) -> DataFrame:
    """Events per minute over all batches so far."""
    return spark.read.parquet(path).groupBy("time").agg(F.sum("posts").alias("posts"))


def first_seen(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop replays on the stream itself, keeping the first record of a key.

    State is kept for ``delay`` of arrival time, which the stream stamps itself and which only
    grows, so no record is ever late: one dated far ahead or far back is kept like any other.
    A replay that comes after ``delay`` passes.  Right when replays are identical; when a later
    version must win, append every version and read through ``latest_per_key``.
    """
    arrived = events.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
    return arrived.dropDuplicatesWithinWatermark(["did", "rkey"]).drop("_arrived")
