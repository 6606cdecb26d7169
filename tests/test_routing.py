"""Routing of single raw lines, one defect each."""

from __future__ import annotations

import copy
import json
from datetime import datetime

import pytest

from eventmarts import contracts as C
from eventmarts.functions import times
from eventmarts.operators import progress, routing
from eventmarts.sources import raw

POST = {
    "did": "did:example:a",
    "time_us": 1_700_000_000_000_001,
    "kind": "commit",
    "commit": {
        "operation": "create",
        "collection": C.COLLECTION_POST,
        "rkey": "r1",
        "cid": "c1",
        "record": {
            "createdAt": "2024-01-01T00:00:00.000Z",
            "text": "grüße",
            "langs": ["en"],
            "reply": {"parent": {"uri": "at://p"}, "root": {"uri": "at://r"}},
        },
    },
}
LIKE = {
    **{k: POST[k] for k in ("did", "time_us", "kind")},
    "commit": {
        "operation": "create",
        "collection": C.COLLECTION_LIKE,
        "rkey": "r2",
        "cid": "c2",
        "record": {"createdAt": "2024-01-01T00:00:01Z", "subject": {"uri": "at://x", "cid": "cx"}},
    },
}
FOLLOW = {
    **{k: POST[k] for k in ("did", "time_us", "kind")},
    "commit": {
        "operation": "create",
        "collection": C.COLLECTION_FOLLOW,
        "rkey": "r3",
        "cid": "c3",
        "record": {"createdAt": "2024-01-01T00:00:02Z", "subject": "did:example:b"},
    },
}
GONE = object()


def change(event: dict, path: str, value) -> str:
    out = copy.deepcopy(event)
    at = out
    *parents, last = path.split(".")
    for p in parents:
        at = at[p]
    if value is GONE:
        del at[last]
    else:
        at[last] = value
    return json.dumps(out)


R = "commit.record."
CASES = [
    ("post", json.dumps(POST), "valid", None),
    ("like", json.dumps(LIKE), "valid", None),
    ("follow", json.dumps(FOLLOW), "valid", None),
    ("no reply", change(POST, R + "reply", GONE), "valid", None),
    ("reply of another kind", change(POST, R + "reply", [1]), "valid", None),
    ("no langs", change(POST, R + "langs", GONE), "valid", None),
    ("null langs", change(POST, R + "langs", None), "valid", None),
    ("empty langs", change(POST, R + "langs", []), "valid", None),
    ("identity", change(POST, "kind", "identity"), "skip", "not a commit"),
    ("no kind", change(POST, "kind", GONE), "skip", "not a commit"),
    ("commit not an object", change(POST, "commit", "x"), "skip", "no commit object"),
    ("delete", change(POST, "commit.operation", "delete"), "skip", "not a create"),
    ("no record", change(POST, "commit.record", GONE), "skip", "no record object"),
    ("other collection", change(POST, "commit.collection", "x.y"), "skip", "unknown collection"),
    ("no did", change(POST, "did", GONE), "dlq", "KeyError('did')"),
    ("null did", change(POST, "did", None), "dlq", "type:did"),
    ("no text", change(POST, R + "text", GONE), "dlq", "KeyError('text')"),
    ("no rkey", change(POST, "commit.rkey", GONE), "dlq", "KeyError('rkey')"),
    ("no createdAt", change(LIKE, R + "createdAt", GONE), "dlq", "KeyError('createdAt')"),
    ("number as text", change(POST, R + "text", 5), "dlq", "type:text"),
    ("mixed langs", change(POST, R + "langs", ["x", 1]), "dlq", "type:langs"),
    ("null in langs", change(POST, R + "langs", ["x", None]), "dlq", "type:langs"),
    ("only null in langs", change(POST, R + "langs", [None]), "dlq", "type:langs"),
    ("langs a string", change(POST, R + "langs", "en"), "dlq", "type:langs"),
    ("boolean time", change(POST, R + "createdAt", True), "dlq", "type:createdAt"),
    ("like of a string", change(LIKE, R + "subject", "x"), "dlq", "type:subject"),
    ("like of null", change(LIKE, R + "subject", None), "dlq", "type:subject"),
    ("like without uri", change(LIKE, R + "subject.uri", GONE), "dlq", "KeyError('uri')"),
    ("like uri a number", change(LIKE, R + "subject.uri", 1), "dlq", "type:subject.uri"),
    ("like without subject", change(LIKE, R + "subject", GONE), "dlq", "KeyError('subject')"),
    ("follow of an object", change(FOLLOW, R + "subject", {"a": 1}), "dlq", "type:subject"),
    ("no cursor", change(POST, "time_us", GONE), "dlq", C.ERROR_NO_CURSOR),
    ("cursor as text", change(POST, "time_us", "17"), "dlq", C.ERROR_NO_CURSOR),
    ("cursor with fraction", change(POST, "time_us", 1.5), "dlq", C.ERROR_NO_CURSOR),
    ("not json", '{"did":', "dlq", "bad_json"),
    ("not an object", "[1]", "dlq", "bad_json"),
    ("repeated key", json.dumps(POST).replace('"c1"', '"old","cid":"c1"'), "valid", None),
]


@pytest.fixture(scope="module")
def routed(spark):
    rows = [(name, line) for name, line, _, _ in CASES]
    return routing.route_events(spark.createDataFrame(rows, "name string, value string")).persist()


@pytest.fixture(scope="module")
def decisions(routed):
    return {r["name"]: r for r in routed.select("name", "route", "reason", "intended_topic").collect()}


@pytest.mark.parametrize(("name", "line", "route", "reason"), CASES, ids=[c[0] for c in CASES])
def test_route(decisions, name, line, route, reason):
    row = decisions[name]
    assert (row["route"], row["reason"]) == (route, reason)


def test_unknown_collection_without_did_is_a_dead_letter(spark):
    event = json.loads(change(POST, "commit.collection", "x.y"))
    del event["did"]
    lines = spark.createDataFrame([(json.dumps(event),)], "value string")
    row = routing.route_events(lines).first()
    assert (row["route"], row["reason"], row["intended_topic"]) == ("dlq", "KeyError('did')", "x.y")


def test_intended_topic_without_a_collection(decisions):
    assert decisions["not json"]["intended_topic"] == C.UNKNOWN_COLLECTION
    assert decisions["no text"]["intended_topic"] == C.COLLECTION_POST


def test_wrong_types_can_be_skipped_instead(spark):
    lines = spark.createDataFrame([(change(POST, R + "text", 5),)], "value string")
    assert routing.route_events(lines, strict_types_to_dlq=False).first()["route"] == "skip"


def test_projection(routed):
    posts = {r["name"]: r for r in routed.where("route = 'valid'").collect()}
    full = posts["post"]
    assert full["did"] == "did:example:a" and full["text"] == "grüße" and full["langs"] == ["en"]
    assert (full["reply_parent"], full["reply_root"]) == ("at://p", "at://r")
    assert posts["no reply"]["reply_parent"] is None
    assert posts["reply of another kind"]["reply_root"] is None
    assert posts["null langs"]["langs"] == []
    assert posts["like"]["subject_uri"] == "at://x" and posts["like"]["subject_cid"] == "cx"
    assert posts["follow"]["subject_did"] == "did:example:b"
    assert posts["repeated key"]["cid"] == "c1"


def test_dead_letters_keep_the_whole_event(routed):
    now = datetime(2024, 2, 1)
    dead = routing.dead_letters(routed, times.instant(now))
    assert C.schema_mismatches(dead, C.DLQ) == []
    by_error = {r["error"]: r for r in dead.collect()}
    kept = json.loads(by_error["KeyError('text')"]["raw_payload"])
    assert kept == json.loads(change(POST, R + "text", GONE))
    raw_line = {r["raw_payload"] for r in dead.where("error = 'bad_json'").collect()}
    assert raw_line == {'{"did":', "[1]"}


def test_counters(routed):
    rows = {(r["route"], r["label"]): r["events"] for r in progress.ingest_counters(routed).collect()}
    assert rows[("valid", C.COLLECTION_LIKE)] == 1
    assert rows[("dlq", "missing_time_us")] == 3
    assert sum(rows.values()) == sum(1 for c in CASES if c[2] != "skip")


def test_filter_on_the_route_does_not_parse_again(routed, spark):
    lines = spark.createDataFrame([(json.dumps(POST),)], "value string")
    plan = routing.valid_rows(routing.route_events(lines), C.POST)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("parseJson") == 1


def test_subscription_starts_after_the_cursor(spark):
    lines = [change(POST, "time_us", t) for t in (1, 2, 3)]
    lines += [change(POST, "commit.collection", "x.y"), change(POST, "time_us", GONE)]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert raw.select_events(df).count() == 4
    assert raw.select_events(df, cursor=2).count() == 2
