"""Declared table shapes and the fixed values that travel with the data."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  These appear in the events, topics and dead letters themselves,
# so they have to be exactly these.
COLLECTION_POST = "app.bsky.feed.post"
COLLECTION_LIKE = "app.bsky.feed.like"
COLLECTION_FOLLOW = "app.bsky.graph.follow"
TOPIC_POST = "bsky.posts.v1"
TOPIC_LIKE = "bsky.likes.v1"
TOPIC_FOLLOW = "bsky.follows.v1"
TOPIC_DLQ = "bsky.dlq.v1"
ERROR_NO_CURSOR = "missing or non-int time_us"
ERROR_EMPTY_PAYLOAD = "empty or undecodable Avro payload"
UNKNOWN_COLLECTION = "unknown"
UNDETERMINED_LANG = "und"
TOPIC_PARTITIONS = 6
FLUSH_SECONDS = 5
FLUSH_ROWS = 10_000
RUN_ROWS = 500_000
LANDING_BLOCK_ROWS = 50_000
FRESHNESS_MAX_LAG_SECONDS = 86_400
VOLUME_MIN_FRACTION = 0.25
REWINDOW_DAYS = 2
TOP_TAGS = 15
# ---------------------------------------------------------------------------

KEY = ("did", "rkey")


def _field(name: str, dtype: T.DataType, nullable: bool = False) -> T.StructField:
    return T.StructField(name, dtype, nullable)


_IDENTITY = [
    _field("did", T.StringType()),
    _field("rkey", T.StringType()),
    _field("cid", T.StringType()),
    _field("created_at", T.TimestampType()),
]
_PROVENANCE = [
    _field("kafka_partition", T.IntegerType()),
    _field("kafka_offset", T.LongType()),
    _field("ingest_ts", T.TimestampType()),
]
_BODY = {
    "post": [
        _field("text", T.StringType()),
        _field("langs", T.ArrayType(T.StringType()), nullable=True),
        _field("reply_parent", T.StringType(), nullable=True),
        _field("reply_root", T.StringType(), nullable=True),
    ],
    "like": [
        _field("subject_uri", T.StringType()),
        _field("subject_cid", T.StringType()),
    ],
    "follow": [_field("subject_did", T.StringType())],
}


def _archived(body: list[T.StructField]) -> list[T.StructField]:
    """Body columns as archived: an absent language list is stored as an empty list."""
    return [
        _field(f.name, f.dataType, nullable=False) if f.name == "langs" else f for f in body
    ]


@dataclass(frozen=True)
class EventType:
    """One event type and the shapes its rows take on the way to the mart."""

    name: str
    collection: str
    topic: str
    record: T.StructType
    bronze: T.StructType
    staging: T.StructType
    mart: T.StructType
    dimension: str
    count_name: str
    distinct_name: str


def _event_type(
    name: str, collection: str, topic: str, dimension: str, count_name: str, distinct_name: str
) -> EventType:
    body = _BODY[name]
    return EventType(
        name=name,
        collection=collection,
        topic=topic,
        record=T.StructType(_IDENTITY + body),
        bronze=T.StructType(_IDENTITY + _archived(body) + _PROVENANCE),
        staging=T.StructType(_IDENTITY + _archived(body) + _PROVENANCE[-1:]),
        mart=T.StructType(
            [
                _field("day", T.DateType()),
                _field(dimension, T.StringType()),
                _field(count_name, T.LongType()),
                _field(distinct_name, T.LongType()),
            ]
        ),
        dimension=dimension,
        count_name=count_name,
        distinct_name=distinct_name,
    )


POST = _event_type("post", COLLECTION_POST, TOPIC_POST, "lang", "posts", "authors")
LIKE = _event_type("like", COLLECTION_LIKE, TOPIC_LIKE, "subject_uri", "likes", "likers")
FOLLOW = _event_type(
    "follow", COLLECTION_FOLLOW, TOPIC_FOLLOW, "subject_did", "follows", "followers"
)
EVENT_TYPES = {e.name: e for e in (POST, LIKE, FOLLOW)}

TOPIC = T.StructType(
    [
        _field("payload", T.StringType(), nullable=True),
        _field("kafka_partition", T.IntegerType()),
        _field("kafka_offset", T.LongType()),
    ]
)
DLQ = T.StructType(
    [
        _field("raw_payload", T.StringType()),
        _field("error", T.StringType()),
        _field("intended_topic", T.StringType()),
        _field("received_at", T.TimestampType()),
    ]
)
REALTIME = T.StructType(
    _IDENTITY + _archived(_BODY["post"]) + [_field("ingested_at", T.TimestampType())]
)
CURSORS = T.StructType(
    [
        _field("stream_name", T.StringType()),
        _field("cursor", T.LongType()),
        _field("updated_at", T.TimestampType()),
    ]
)


def avro_schema(name: str, contract: T.StructType) -> str:
    """Avro schema text for a record contract, for the broker reader and writer."""
    kinds = {"string": "string", "integer": "int", "long": "long"}

    def avro_type(dtype: T.DataType):
        if isinstance(dtype, T.TimestampType):
            return {"type": "long", "logicalType": "timestamp-micros"}
        if isinstance(dtype, T.ArrayType):
            return {"type": "array", "items": avro_type(dtype.elementType)}
        return kinds[dtype.typeName()]

    fields = []
    for f in contract.fields:
        if f.nullable:
            fields.append(
                {"name": f.name, "type": ["null", avro_type(f.dataType)], "default": None}
            )
        else:
            fields.append({"name": f.name, "type": avro_type(f.dataType)})
    return json.dumps({"type": "record", "name": name, "fields": fields})


def schema_mismatches(df: DataFrame, contract: T.StructType) -> list[str]:
    """Differences in column name, order or type between a table and its contract."""
    found = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    wanted = [(f.name, f.dataType.simpleString()) for f in contract.fields]
    problems = [
        f"column {i}: expected {w[0]} {w[1]}, found {g[0]} {g[1]}"
        for i, (w, g) in enumerate(zip(wanted, found), start=1)
        if w != g
    ]
    problems += [f"missing column {n} {t}" for n, t in wanted[len(found) :]]
    problems += [f"unexpected column {n} {t}" for n, t in found[len(wanted) :]]
    return problems


def contract_report(df: DataFrame, contract: T.StructType) -> DataFrame:
    """One row per declared or extra column: position, whether name and type match, null rows, verdict.

    A column that the contract does not declare, or that stands beyond its last, is never ok.

    Files hand every column back as nullable, so a required column is proved by counting
    its nulls.  All counts come from a single pass.
    """
    spark = df.sparkSession
    found = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    rows = []
    for i, f in enumerate(contract.fields):
        same = i < len(found) and found[i] == (f.name, f.dataType.simpleString())
        rows.append((i + 1, f.name, bool(same), not f.nullable))
    names = set(contract.names)
    rows += [(i + 1, n, False, False) for i, (n, _) in enumerate(found) if n not in names]
    declared = spark.createDataFrame(
        rows, "position int, column_name string, shape_ok boolean, required boolean"
    )
    if not df.columns:
        nulls = spark.createDataFrame([], "column_name string, null_rows bigint")
    else:
        counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
        nulls = counts.unpivot([], [f"`{c}`" for c in df.columns], "column_name", "null_rows")
    # Both sides hold one row per declared column, so the join is of a fixed, tiny size.
    return (
        declared.join(F.broadcast(nulls), "column_name", "left")
        .withColumn(
            "ok",
            F.col("shape_ok")
            & (~F.col("required") | (F.coalesce(F.col("null_rows"), F.lit(1)) == 0)),
        )
        .select("position", "column_name", "shape_ok", "required", "null_rows", "ok")
    )
