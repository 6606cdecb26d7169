"""Where each stream stands: offsets, safe cursors, counters, staleness."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmarts.contracts import ERROR_NO_CURSOR, TOPIC_PARTITIONS
from eventmarts.functions.times import to_micros
from eventmarts.operators.dedup import latest_per_key
from eventmarts.operators.routing import DEAD, NO_CURSOR_REASON, VALID


def offset_high_water(rows: DataFrame) -> DataFrame:
    """Highest archived offset per partition, and the next one to read."""
    return rows.groupBy("kafka_partition").agg(
        F.max("kafka_offset").alias("high_water"),
        (F.max("kafka_offset") + 1).alias("next_offset"),
    )


def safe_cursor(log: DataFrame, salts: int = 16) -> DataFrame:
    """Highest cursor per stream below which every registered cursor is acknowledged.

    ``log`` holds (stream, cursor, registered, acked).  An unregistered acknowledgement is
    ignored; a missing one is none; a cursor listed more than once needs all its entries
    acknowledged.
    Streams with nothing safe yet give null.

    The first gap per stream is one small row.  It is copied once per salt and met by the log
    on (stream, salt), so a stream holding most of the log is spread over ``salts`` tasks;
    when the gaps turn out small at run time, the adaptive planner broadcasts them instead.
    """
    acked = F.coalesce("acked", F.lit(False))
    registered = log.where("registered").select("stream", "cursor", acked.alias("acked"))
    gaps = registered.groupBy("stream").agg(
        F.min(F.when(~F.col("acked"), F.col("cursor"))).alias("gap")
    )
    salted_gaps = gaps.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted_log = registered.withColumn("salt", F.pmod(F.hash("cursor"), F.lit(salts)))
    below = F.col("gap").isNull() | (F.col("cursor") < F.col("gap"))
    return (
        salted_log.join(salted_gaps, ["stream", "salt"])
        .groupBy("stream", "salt")
        .agg(F.max(F.when(below, F.col("cursor"))).alias("highest"))
        .groupBy("stream")
        .agg(F.max("highest").alias("safe_cursor"))
    )


def latest_cursors(entries: DataFrame) -> DataFrame:
    """Current cursor of each stream from the append-only log of saves."""
    return latest_per_key(entries, version=("updated_at", "cursor"), keys=("stream_name",))


def ingest_counters(routed: DataFrame) -> DataFrame:
    """Events by collection and dead letters by reason.

    A dead letter counts under its collection, except a missing cursor, which has its own name.
    """
    label = F.when(F.col("reason") == ERROR_NO_CURSOR, F.lit(NO_CURSOR_REASON)).otherwise(
        F.col("intended_topic")
    )
    return (
        routed.where(F.col("route").isin(VALID, DEAD))
        .select("route", label.alias("label"))
        .groupBy("route", "label")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def dead_letter_rate(dead: DataFrame) -> DataFrame:
    """Dead letters by intended topic and error."""
    return dead.groupBy("intended_topic", "error").agg(F.count(F.lit(1)).alias("records"))


def staleness(rows: DataFrame, now: datetime, column: str = "created_at") -> DataFrame:
    """Newest event and its age in seconds; null when there is none."""
    newest = F.max(column)
    age = (F.lit(to_micros(now)) - F.unix_micros(newest.cast("timestamp"))) / 1e6
    return rows.agg(newest.alias("newest"), F.round(age, 3).alias("age_seconds"))


def topic_partition(did: Column | str = "did", partitions: int = TOPIC_PARTITIONS) -> Column:
    """Topic partition of an author: all records of one author share one."""
    return F.pmod(F.xxhash64(did), F.lit(partitions)).cast("int")


def key_affine(rows: DataFrame, partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """Lay rows out so that each author's records share one partition."""
    return rows.repartition(partitions, "did")
