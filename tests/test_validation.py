"""The archive boundary: flat records against their contract."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventmarts import contracts as C
from eventmarts.functions import times
from eventmarts.operators import validation

POST = {
    "did": "did:example:a",
    "rkey": "r1",
    "cid": "c1",
    "created_at": "2024-01-01T00:00:00Z",
    "text": "hello",
    "langs": ["en"],
    "reply_parent": "at://p",
    "reply_root": None,
}
LIKE = {k: POST[k] for k in ("did", "rkey", "cid", "created_at")} | {
    "subject_uri": "at://x",
    "subject_cid": "cx",
}
FOLLOW = {k: POST[k] for k in ("did", "rkey", "cid", "created_at")} | {"subject_did": "did:example:b"}


def without(record: dict, key: str) -> str:
    return json.dumps({k: v for k, v in record.items() if k != key})


def changed(record: dict, **values) -> str:
    return json.dumps(record | values)


CASES = [
    ("post", json.dumps(POST), None),
    ("post", changed(POST, langs=None), None),
    ("post", without(POST, "langs"), None),
    ("post", changed(POST, created_at=1_700_000_000), None),
    ("post", without(POST, "text"), "missing:text"),
    ("post", changed(POST, text=5), "type:text"),
    ("post", changed(POST, text=None), "type:text"),
    ("post", changed(POST, langs=["x", None]), "type:langs"),
    ("post", changed(POST, reply_parent=3), "type:reply_parent"),
    ("post", changed(POST, created_at=False), "type:created_at"),
    ("post", changed(POST, zzz=1, aaa=2), "extra:aaa,extra:zzz"),
    ("post", changed(POST, did=1, langs="en", zzz=1), "type:did,type:langs,extra:zzz"),
    ("post", None, C.ERROR_EMPTY_PAYLOAD),
    ("post", "null", C.ERROR_EMPTY_PAYLOAD),
    ("post", "{not json", C.ERROR_EMPTY_PAYLOAD),
    ("post", "[1]", "type:record"),
    ("like", json.dumps(LIKE), None),
    ("like", without(LIKE, "subject_cid"), "missing:subject_cid"),
    ("like", json.dumps(POST), None),
    ("follow", json.dumps(FOLLOW), None),
    ("follow", without(FOLLOW, "subject_did"), "missing:subject_did"),
]
CASES[18] = (
    "like",
    json.dumps(POST),
    "missing:subject_uri,missing:subject_cid,"
    "extra:langs,extra:reply_parent,extra:reply_root,extra:text",
)


def records(spark, name: str):
    rows = [(i, p, 2, 40 + i) for i, (n, p, _) in enumerate(CASES) if n == name]
    return spark.createDataFrame(
        rows, "case int, payload string, kafka_partition int, kafka_offset long"
    )


@pytest.mark.parametrize("name", ["post", "like", "follow"])
def test_verdicts(spark, name):
    checked = validation.validate_flat(records(spark, name), C.EVENT_TYPES[name])
    found = {r["case"]: r["error"] for r in checked.select("case", "error").collect()}
    assert found == {i: e for i, (n, _, e) in enumerate(CASES) if n == name}


@pytest.mark.parametrize("name", ["post", "like", "follow"])
def test_split_loses_nothing_and_keeps_the_contracts(spark, name):
    event = C.EVENT_TYPES[name]
    now = times.instant(datetime(2024, 2, 1))
    checked = validation.validate_flat(records(spark, name), event).withColumn("ingest_ts", now)
    good = validation.accepted(checked, event)
    bad = validation.rejected(checked, event, now)
    assert C.schema_mismatches(good, event.bronze) == []
    assert C.schema_mismatches(bad, C.DLQ) == []
    assert good.count() + bad.count() == sum(1 for c in CASES if c[0] == name)
    assert {r["intended_topic"] for r in bad.collect()} == {event.topic}


def test_provenance_and_empty_langs(spark):
    now = times.instant(datetime(2024, 2, 1))
    checked = validation.validate_flat(records(spark, "post"), C.POST).withColumn("ingest_ts", now)
    rows = {r["kafka_offset"]: r for r in validation.accepted(checked, C.POST).collect()}
    assert rows[40]["kafka_partition"] == 2 and rows[40]["langs"] == ["en"]
    assert rows[41]["langs"] == [] and rows[42]["langs"] == []
    assert rows[40]["reply_root"] is None


def test_payloads_of_dead_letters(spark):
    now = times.instant(datetime(2024, 2, 1))
    checked = validation.validate_flat(records(spark, "post"), C.POST)
    rows = validation.rejected(checked, C.POST, now).collect()
    payloads = [r["raw_payload"] for r in rows]
    assert payloads.count("null") == 2 and "{not json" in payloads
    missing = next(r for r in rows if r["error"] == "missing:text")
    assert json.loads(missing["raw_payload"])["did"] == "did:example:a"


def test_struct_payload_as_a_schema_aware_reader_gives_it(spark):
    moment = datetime(2024, 1, 1)
    schema = f"payload struct<{','.join(f'{f.name}:{f.dataType.simpleString()}' for f in C.POST.record)}>"
    good = (POST | {"created_at": moment, "langs": None},)
    bad = (POST | {"created_at": moment, "text": None},)
    df = spark.createDataFrame([good, bad, (None,)], schema)
    checked = validation.validate_flat(df, C.POST)
    errors = [r["error"] for r in checked.collect()]
    assert errors == [None, "type:text", C.ERROR_EMPTY_PAYLOAD]
    first = checked.where(F.col("error").isNull()).first()
    assert first["created_at"] == moment and first["langs"] == []


def test_avro_schema_lists_the_contract_fields():
    for event in C.EVENT_TYPES.values():
        text = json.loads(C.avro_schema(event.name, event.record))
        assert [f["name"] for f in text["fields"]] == event.record.names
        times_ = [f for f in text["fields"] if f["name"] == "created_at"]
        assert times_[0]["type"] == {"type": "long", "logicalType": "timestamp-micros"}
    langs = json.loads(C.avro_schema("post", C.POST.record))["fields"][5]
    assert langs["type"] == ["null", {"type": "array", "items": "string"}] and langs["default"] is None


def test_contract_shapes():
    assert C.POST.bronze.names[-3:] == ["kafka_partition", "kafka_offset", "ingest_ts"]
    assert not C.POST.bronze["langs"].nullable and C.POST.record["langs"].nullable
    assert C.POST.bronze["reply_parent"].nullable
    assert all(not f.nullable for f in C.LIKE.bronze) and all(not f.nullable for f in C.FOLLOW.bronze)
    assert set(C.POST.staging.names) == set(C.POST.bronze.names) - {"kafka_partition", "kafka_offset"}


def test_contract_report_finds_extra_missing_and_misplaced_columns(spark):
    fine = spark.createDataFrame([], C.LIKE.record)
    assert all(r["ok"] for r in C.contract_report(fine, C.LIKE.record).collect())
    extra = {r["column_name"]: r["ok"] for r in C.contract_report(fine.selectExpr("*", "1 as more"), C.LIKE.record).collect()}
    assert not extra.pop("more") and all(extra.values())
    swapped = fine.select("rkey", "did", *fine.columns[2:])
    wrong = {r["column_name"] for r in C.contract_report(swapped, C.LIKE.record).collect() if not r["ok"]}
    assert wrong == {"did", "rkey"}
    other = C.contract_report(spark.range(3).toDF("zzz"), C.LIKE.record).collect()
    assert not any(r["ok"] for r in other) and len(other) == len(C.LIKE.record.fields) + 1


def test_contract_report_finds_nulls_and_wrong_shapes(spark):
    rows = spark.createDataFrame(
        [("a", None, "c", 1)], "did string, rkey string, cid string, created_at long"
    )
    report = {r["column_name"]: r for r in C.contract_report(rows, C.LIKE.record).collect()}
    assert report["did"]["ok"] and report["rkey"]["null_rows"] == 1 and not report["rkey"]["ok"]
    assert not report["created_at"]["shape_ok"] and not report["subject_uri"]["ok"]
    assert C.schema_mismatches(rows, C.LIKE.record) == [
        "column 4: expected created_at timestamp, found created_at bigint",
        "missing column subject_uri string",
        "missing column subject_cid string",
    ]


def test_each_breach_is_looked_at_once(spark):
    rows = spark.createDataFrame([("{}", 0, 0)], "payload string, kafka_partition int, kafka_offset long")
    checked = validation.validate_flat(rows, C.LIKE).where(F.col("error").isNull())
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[subject_cid])) = STRING") == 1
