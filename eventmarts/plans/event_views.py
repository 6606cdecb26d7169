"""Event-shaped views over the generic test tables, so that every operator has real input.

``events`` becomes posts, likes and follows in several stages of their life: raw nested
lines with defects placed by event number, flat topic records, archived rows, a delivery
log.  Each view is a projection of the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmarts.contracts import COLLECTION_FOLLOW, COLLECTION_LIKE, COLLECTION_POST

OTHER_COLLECTION = "example.other.record"  # a collection nobody subscribes to


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tags() -> Column:
    empty = F.array().cast("array<string>")
    slot = F.col("event_id") % 4
    return (
        F.when(slot == 0, empty)
        .when(slot == 1, F.array(F.lit("en")))
        .when(slot == 2, F.array(F.lit("en"), F.lit("ja")))
        .otherwise(F.array(F.lit("en"), F.lit("en")))
    )


def archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as archived posts; several versions per (did, rkey)."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("did"),
        (F.col("event_id") % 97).cast("string").alias("rkey"),
        F.col("event_id").cast("string").alias("cid"),
        F.col("ts").alias("created_at"),
        F.col("event_type").alias("text"),
        _tags().alias("langs"),
        (F.col("user_id") % 6).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        F.col("ts").alias("ingest_ts"),
        F.get_json_object("props", "$.k").alias("subject"),
        "event_type",
    )


def archived_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, with some events dated five days before they arrive and some two days after."""
    number = F.col("kafka_offset")
    shift = (
        F.when(number % 7 == 0, F.expr("interval 5 days"))
        .when(number % 11 == 0, F.expr("interval -2 days"))
        .otherwise(F.expr("interval 0 days"))
    )
    return archived(spark, sf_dir).withColumn("created_at", F.col("created_at") - shift)


def subjects(spark: SparkSession, sf_dir: str, event_type: str, column: str) -> DataFrame:
    """Events of one type as archived likes or follows."""
    return (
        archived(spark, sf_dir)
        .where(F.col("event_type") == event_type)
        .withColumnRenamed("subject", column)
    )


def _quoted(text: Column | str) -> Column:
    return F.concat(F.lit('"'), text if isinstance(text, Column) else F.lit(text), F.lit('"'))


def _member(key: str, value: Column | str) -> Column:
    value = value if isinstance(value, Column) else F.lit(value)
    return F.concat(F.lit(f'"{key}":'), value)


def _object(*members: Column) -> Column:
    """JSON text of an object; null members are left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw nested lines of all events, ``event_id, value``; the defect goes by number mod 31."""
    slot = F.col("event_id") % 31
    none = F.lit(None).cast("string")

    def at(n: int, value: Column | str) -> Column:
        return F.when(slot == n, value if isinstance(value, Column) else F.lit(value))

    is_like = F.col("event_type") == "click"
    is_follow = F.col("event_type") == "signup"
    collection = (
        F.when(slot.isin(6, 7), F.lit(OTHER_COLLECTION))
        .when(is_like, F.lit(COLLECTION_LIKE))
        .when(is_follow, F.lit(COLLECTION_FOLLOW))
        .otherwise(F.lit(COLLECTION_POST))
    )
    number = F.col("event_id").cast("string")
    micros = F.unix_micros(F.col("ts").cast("timestamp")).cast("string")
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    did = F.when(slot == 7, none).otherwise(_member("did", _quoted(F.col("user_id").cast("string"))))
    time_us = (
        F.when(slot == 8, none)
        .when(slot == 9, _member("time_us", _quoted(micros)))
        .otherwise(_member("time_us", micros))
    )
    rkey = F.when(slot == 13, none).otherwise(
        _member("rkey", _quoted((F.col("event_id") % 97).cast("string")))
    )
    cid = (
        F.when(slot == 14, _member("cid", "null"))
        .when(slot == 18, F.concat(_member("cid", '"old",'), _member("cid", _quoted(number))))
        .otherwise(_member("cid", _quoted(number)))
    )
    created = (
        F.when(slot == 23, none)
        .when(slot == 11, _member("createdAt", millis))
        .when(slot == 12, _member("createdAt", "true"))
        .otherwise(_member("createdAt", _quoted(iso(F.col("ts")))))
    )
    text = F.when(slot == 0, none).otherwise(
        F.coalesce(at(1, _member("text", "5")), _member("text", _quoted(F.col("event_type"))))
    )
    langs = F.when(slot == 24, none).otherwise(F.coalesce(
        at(2, '"langs":["x",1]'),
        at(3, '"langs":null'),
        at(19, '"langs":"en"'),
        at(20, '"langs":["x",null]'),
        F.concat(F.lit('"langs":'), F.to_json(_tags())),
    ))
    reply = F.when(slot == 15, none).otherwise(
        F.concat(F.lit('"reply":{"parent":{"uri":"p'), number, F.lit('"},"root":{"uri":7}}'))
    )
    subject_key = F.get_json_object("props", "$.k")
    uri = F.when(slot == 22, none).otherwise(
        F.coalesce(at(1, '"uri":5'), _member("uri", _quoted(subject_key)))
    )
    like_subject = F.when(slot == 21, _quoted(subject_key)).otherwise(
        _object(uri, _member("cid", _quoted(F.concat(F.lit("c"), subject_key))))
    )
    follow_subject = F.coalesce(at(1, "5"), _quoted(subject_key))
    subject = F.when(slot == 0, none).otherwise(
        _member("subject", F.when(is_like, like_subject).otherwise(follow_subject))
    )
    post_record = _object(created, text, langs, reply)
    other_record = _object(created, subject)
    record = F.when(slot == 16, F.lit('"gone"')).otherwise(
        F.when(is_like | is_follow, other_record).otherwise(post_record)
    )
    operation = F.when(slot == 4, F.lit("delete")).otherwise(F.lit("create"))
    kind = F.when(slot == 5, F.lit("identity")).otherwise(F.lit("commit"))
    commit = F.when(slot == 17, none).otherwise(
        _member(
            "commit",
            _object(
                _member("operation", _quoted(operation)),
                _member("collection", _quoted(collection)),
                rkey,
                cid,
                _member("record", record),
            ),
        )
    )
    line = _object(did, time_us, _member("kind", _quoted(kind)), commit)
    broken = F.when(slot == 10, F.lit('{"did":"broken')).otherwise(line)
    return table(spark, sf_dir, "events").select("event_id", broken.alias("value"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw post lines, with their whole texts."""
    record = F.struct(
        F.lit("2024-01-01T00:00:00Z").alias("createdAt"), "text", F.array("lang").alias("langs")
    )
    commit = F.struct(
        F.lit("create").alias("operation"),
        F.lit(COLLECTION_POST).alias("collection"),
        F.col("doc_id").cast("string").alias("rkey"),
        F.md5("text").alias("cid"),
        record.alias("record"),
    )
    event = F.struct(
        F.col("source").alias("did"),
        F.col("doc_id").alias("time_us"),
        F.lit("commit").alias("kind"),
        commit.alias("commit"),
    )
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", F.to_json(event).alias("value"))


def as_records(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Flat topic records of archived rows, ``payload, kafka_partition, kafka_offset``."""
    members = [iso(F.col(c)).alias(c) if c == "created_at" else F.col(c) for c in columns]
    return rows.select(F.to_json(F.struct(*members)).alias("payload"), "kafka_partition", "kafka_offset")


def topic_records(spark: SparkSession, sf_dir: str, event_name: str) -> DataFrame:
    """Flat topic records without defects, ``payload, kafka_partition, kafka_offset``."""
    members = [
        _member("did", _quoted(F.col("did"))),
        _member("rkey", _quoted(F.col("rkey"))),
        _member("cid", _quoted(F.col("cid"))),
        _member("created_at", _quoted(iso(F.col("created_at")))),
    ]
    rows = archived(spark, sf_dir)
    if event_name == "post":
        members += [
            _member("text", _quoted(F.col("text"))),
            _member("langs", F.to_json("langs")),
            _member("reply_parent", "null"),
        ]
    elif event_name == "like":
        rows = rows.where(F.col("event_type") == "click")
        members += [
            _member("subject_uri", _quoted(F.col("subject"))),
            _member("subject_cid", _quoted(F.concat(F.lit("c"), "subject"))),
        ]
    else:
        rows = rows.where(F.col("event_type") == "signup")
        members += [_member("subject_did", _quoted(F.col("subject")))]
    return rows.select(_object(*members).alias("payload"), "kafka_partition", "kafka_offset")


def flat_records(spark: SparkSession, sf_dir: str, event_name: str) -> DataFrame:
    """Flat topic records with defects by offset mod 13."""
    slot = F.col("kafka_offset") % 13
    payload = F.col("payload")
    missing = {"post": "text", "like": "subject_cid", "follow": "subject_did"}[event_name]
    broken = (
        F.when(slot == 0, F.regexp_replace(payload, r"\}$", ',"zzz":1}'))
        .when(slot == 1, F.lit(None).cast("string"))
        .when(slot == 2, F.regexp_replace(payload, f'"{missing}":"', f'"x_{missing}":"'))
        .when(slot == 3, F.regexp_replace(payload, r'"langs":\[[^\]]*\]', '"langs":null'))
        .when(slot == 4, F.regexp_replace(payload, r'"did":"(\d+)"', r'"did":$1'))
        .when(slot == 5, F.lit("null"))
        .when(slot == 6, F.lit("{not json"))
        .when(slot == 7, F.regexp_replace(payload, r'"created_at":"[^"]*"', '"created_at":true'))
        .when(slot == 8, F.lit("[1,2]"))
        .otherwise(payload)
    )
    return topic_records(spark, sf_dir, event_name).withColumn("payload", broken)


def delivery_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries of all events, one stream per event type.

    One type has no failures, one has none that succeeded, the others have gaps; a few
    acknowledgements were never registered.
    """
    number = F.col("event_id")
    acked = (
        F.when(F.col("event_type") == "view", F.lit(True))
        .when(F.col("event_type") == "error", F.lit(False))
        .otherwise(number % 509 != 508)
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("stream"),
        number.alias("cursor"),
        (number % 101 != 0).alias("registered"),
        acked.alias("acked"),
    )
