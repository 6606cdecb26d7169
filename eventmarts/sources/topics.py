"""Typed topics: one per event type, each record with its partition and offset.

A topic is a folder of parquet files, or a broker topic where Spark's Kafka and Avro
packages are on the class path.  Both give ``payload, kafka_partition, kafka_offset``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmarts.contracts import TOPIC, EventType, avro_schema

#: Bytes of files in one micro-batch, unless a caller bounds it otherwise.
BATCH_BYTES = 64 << 30


def stream_topic(
    spark: SparkSession,
    path: str,
    *,
    max_files: int | None = None,
    max_bytes: int | None = BATCH_BYTES,
) -> DataFrame:
    """Read a topic folder from its first record; the checkpoint holds the position.

    ``max_files`` or ``max_bytes`` bounds one micro-batch, so a backlog is taken in bounded
    batches and a batch that is held in memory has a known size.
    """
    reader = spark.readStream.schema(TOPIC)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    elif max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def read_topic(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC).parquet(path)


def stream_broker_topic(
    spark: SparkSession,
    servers: str,
    event: EventType,
    *,
    max_offsets: int | None = None,
) -> DataFrame:
    """Read a broker topic of framed Avro records; ``payload`` comes as a struct.

    The frame is one zero byte and a four-byte schema id in front of the record.  A record
    that cannot be decoded has a null payload, which validation sends to quarantine.  Needs
    the Kafka and Avro packages.
    """
    from pyspark.sql.avro.functions import from_avro

    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", event.topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    body = F.expr("substring(value, 6)")
    decoded = from_avro(body, avro_schema(event.name, event.record), {"mode": "PERMISSIVE"})
    return reader.load().select(
        decoded.alias("payload"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def broker_records(records: DataFrame, event: EventType, schema_id: int) -> DataFrame:
    """Key and framed Avro value of typed records, for a Kafka sink keyed by author."""
    from pyspark.sql.avro.functions import to_avro

    frame = F.unhex(F.lit(f"00{schema_id:08x}"))
    value = to_avro(F.struct(*event.record.names), avro_schema(event.name, event.record))
    return records.select(F.col("did").cast("binary").alias("key"), F.concat(frame, value).alias("value"))
