"""Sort raw firehose lines into typed events, dead letters and lines to ignore."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmarts.contracts import (
    ERROR_NO_CURSOR,
    EVENT_TYPES,
    FOLLOW,
    POST,
    UNKNOWN_COLLECTION,
    EventType,
)
from eventmarts.functions import json_fields as J
from eventmarts.functions import times

VALID, DEAD, SKIP = "valid", "dlq", "skip"
BAD_JSON = "bad_json"
NO_CURSOR_REASON = "missing_time_us"

_SHAPE = (
    "struct<did:variant,time_us:variant,kind:variant,commit:struct<operation:variant,"
    "collection:variant,rkey:variant,cid:variant,record:struct<createdAt:variant,text:variant,"
    "langs:variant,subject:variant,reply:struct<parent:struct<uri:variant>,root:struct<uri:variant>>>>>"
)
_SUBJECT_SHAPE = "struct<uri:variant,cid:variant>"
_COMMIT, _RECORD = "_e.commit", "_e.commit.record"


def _first_of(steps: list[tuple[Column, Column]], otherwise: Column) -> Column:
    return reduce(lambda rest, step: F.when(step[0], step[1]).otherwise(rest), steps[::-1], otherwise)


def _key_error(column: str, key: str) -> tuple[Column, Column]:
    return F.col(column).isNull(), F.lit(f"KeyError('{key}')")


def _lookups(event: EventType) -> list[tuple[Column, Column]]:
    """Keys an event of this type has to carry, in the order their absence is reported."""
    common = [
        _key_error(f"{_COMMIT}.rkey", "rkey"),
        _key_error(f"{_COMMIT}.cid", "cid"),
        _key_error(f"{_RECORD}.createdAt", "createdAt"),
    ]
    subject = _key_error(f"{_RECORD}.subject", "subject")
    if event is POST:
        return [*common, _key_error(f"{_RECORD}.text", "text")]
    if event is FOLLOW:
        return [*common, subject]
    return [
        subject,
        *common,
        (F.col("_subject").isNull(), F.lit("type:subject")),
        _key_error("_subject.uri", "uri"),
        _key_error("_subject.cid", "cid"),
    ]


def _misfits(event: EventType) -> list[tuple[Column, str]]:
    """Conditions under which a present field has the wrong type, with the field's name."""
    own = {
        "post": [
            (~J.is_string(f"{_RECORD}.text"), "text"),
            (~J.is_optional_string_list(f"{_RECORD}.langs"), "langs"),
        ],
        "like": [
            (~J.is_string("_subject.uri"), "subject.uri"),
            (~J.is_string("_subject.cid"), "subject.cid"),
        ],
        "follow": [(~J.is_string(f"{_RECORD}.subject"), "subject")],
    }
    return [
        (~J.is_string("_e.did"), "did"),
        (~J.is_string(f"{_COMMIT}.rkey"), "rkey"),
        (~J.is_string(f"{_COMMIT}.cid"), "cid"),
        (F.col("created_at").isNull(), "createdAt"),
        *own[event.name],
    ]


def _decide(strict_types_to_dlq: bool) -> Column:
    """Route and reason, the first rule that applies."""

    def to(route: str, reason: Column | str) -> Column:
        reason = F.lit(reason) if isinstance(reason, str) else reason
        return F.struct(F.lit(route).alias("route"), reason.alias("reason"))

    def judge(event: EventType) -> Column:
        misfits = _misfits(event)
        named = F.concat_ws(",", *[F.when(bad, F.lit(f"type:{name}")) for bad, name in misfits])
        return _first_of(
            [
                *[(absent, to(DEAD, reason)) for absent, reason in _lookups(event)],
                (
                    reduce(lambda a, b: a | b, [bad for bad, _ in misfits]),
                    to(DEAD if strict_types_to_dlq else SKIP, named),
                ),
                (F.col("cursor").isNull(), to(DEAD, ERROR_NO_CURSOR)),
            ],
            to(VALID, F.lit(None).cast("string")),
        )

    return _first_of(
        [
            (F.col("_e").isNull(), to(DEAD, BAD_JSON)),
            (~J.text("_e.kind").eqNullSafe("commit"), to(SKIP, "not a commit")),
            (F.col(_COMMIT).isNull(), to(SKIP, "no commit object")),
            (~J.text(f"{_COMMIT}.operation").eqNullSafe("create"), to(SKIP, "not a create")),
            (F.col(_RECORD).isNull(), to(SKIP, "no record object")),
            (F.col("_e.did").isNull(), to(DEAD, "KeyError('did')")),
            *[(F.col("_collection") == e.collection, judge(e)) for e in EVENT_TYPES.values()],
        ],
        to(SKIP, "unknown collection"),
    )


def route_events(
    raw: DataFrame, line: str = "value", *, strict_types_to_dlq: bool = True
) -> DataFrame:
    """Give every raw line exactly one route: ``valid``, ``dlq`` or ``skip``.

    Added columns: ``event`` (the parsed line), ``route``, ``reason``, ``event_type``,
    ``intended_topic``, ``cursor`` and the typed fields, which are meaningful on valid rows.

    A field that is present but of the wrong type makes a dead letter; with
    ``strict_types_to_dlq=False`` such an event is skipped instead.

    No shuffle.  The line is parsed once, its fields are picked out once and its route is
    decided once; the typed fields that only the output needs are taken after the decision,
    so a filter on the route comes before them.
    """
    parsed = raw.withColumn("event", J.parse(line))
    picked = parsed.withColumn("_e", J.fields("event", _SHAPE))
    created = F.col(f"{_RECORD}.createdAt")
    looked = picked.select(
        "*",
        J.text(f"{_COMMIT}.collection").alias("_collection"),
        J.integer("_e.time_us").alias("cursor"),
        J.fields(f"{_RECORD}.subject", _SUBJECT_SHAPE).alias("_subject"),
        J.kind(created).alias("_created_kind"),
        J.text(created).alias("_created_text"),
    )
    timed = looked.withColumn(
        "created_at", times.value_to_timestamp(F.col("_created_kind"), F.col("_created_text"))
    )
    event_type = _first_of(
        [(F.col("_collection") == e.collection, F.lit(e.name)) for e in EVENT_TYPES.values()],
        F.lit(None).cast("string"),
    )
    decided = J.hold(timed, _decision=_decide(strict_types_to_dlq), event_type=event_type)
    no_tags = F.array().cast("array<string>")
    return decided.select(
        *raw.columns,
        "event",
        F.col("_decision.route").alias("route"),
        F.col("_decision.reason").alias("reason"),
        "event_type",
        F.coalesce("_collection", F.lit(UNKNOWN_COLLECTION)).alias("intended_topic"),
        "cursor",
        J.text("_e.did").alias("did"),
        J.text(f"{_COMMIT}.rkey").alias("rkey"),
        J.text(f"{_COMMIT}.cid").alias("cid"),
        "created_at",
        J.text(f"{_RECORD}.text").alias("text"),
        F.coalesce(J.string_list(f"{_RECORD}.langs"), no_tags).alias("langs"),
        J.text_if_string(f"{_RECORD}.reply.parent.uri").alias("reply_parent"),
        J.text_if_string(f"{_RECORD}.reply.root.uri").alias("reply_root"),
        J.text("_subject.uri").alias("subject_uri"),
        J.text("_subject.cid").alias("subject_cid"),
        J.text(f"{_RECORD}.subject").alias("subject_did"),
    )


def valid_rows(routed: DataFrame, event: EventType) -> DataFrame:
    """The valid events of one type, in the shape of its record contract, plus the cursor."""
    return routed.where((F.col("route") == VALID) & (F.col("event_type") == event.name)).select(
        *event.record.names, "cursor"
    )


def raw_payload(line: str = "value") -> Column:
    """A quarantined line: canonical JSON where it parsed, the line itself where it did not."""
    parsed = F.when(F.col("reason") != BAD_JSON, J.canonical_json("event"))
    return F.coalesce(parsed, F.col(line), F.lit("null"))


def dead_letters(routed: DataFrame, received_at: Column, line: str = "value") -> DataFrame:
    """Dead-letter envelopes of the lines routed to quarantine."""
    return routed.where(F.col("route") == DEAD).select(
        raw_payload(line).alias("raw_payload"),
        F.col("reason").alias("error"),
        "intended_topic",
        received_at.alias("received_at"),
    )
