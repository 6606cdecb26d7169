from __future__ import annotations

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from eventmarts.functions import json_fields as J
from eventmarts.functions import times

# Text of a creation time and what it means, as microseconds since the epoch (None: invalid).
T0 = 1_704_067_200_000_000
TEXTS = {
    "2024-01-01T00:00:00.000Z": T0,
    "2024-01-01": T0,
    "2024-01-01T00:00": T0,
    "2024-01-01T00:00Z": T0,
    "2024-01-01 00:00:00,5": T0 + 500_000,
    "2024-01-01_00:00:00": T0,
    "2024-01-01t00:00:00z": T0,
    "2024-01-01T00:00:00.123456789Z": T0 + 123_456,
    "2024-01-01T00:00:00+0530": T0 - 19_800_000_000,
    "2024-01-01T00:00:00-05:30": T0 + 19_800_000_000,
    "2024-01-01T00:00:00+23:59": T0 - 86_340_000_000,
    "1700000000": 1_700_000_000_000_000,
    "1700000000.5": 1_700_000_000_500_000,
    "1700000000.1234567": 1_700_000_000_123_457,
    "1700000000123": 1_700_000_000_123_000,
    "-5": -5_000_000,
    "+5": 5_000_000,
    ".5": 500_000,
    "5.": 5_000_000,
    "2024": 2_024_000_000,
    "20000000000": 20_000_000_000_000_000,
    "20000000001": 20_000_000_001_000,
    "0001-01-01T00:00:00Z": -62_135_596_800_000_000,
    "": None,
    "1e3": None,
    " 2024-01-01": None,
    "2024-1-1": None,
    "2024-01": None,
    "T00:00": None,
    "0000-01-01": None,
    "2024-02-30": None,
    "2024-01-01T24:00:00": None,
    "2024-01-01T23:59:60Z": None,
    "2024-01-01T00:00:00+05": None,
    "2024-01-01T00:00:00+24:00": None,
    "2024-01-01T00:00:00 Z": None,
    "2024-01-01T00:00:00.": None,
    "2024-01-01T00": None,
    "2024-01-01Z": None,
    "253402300800000": None,
    "NaN": None,
}
VALUES = {
    "1.5": 1_500_000,
    "20000000001.5": 20_000_000_001_500,
    "-20000000001": -20_000_000_001_000,
    "1e15": None,
    "true": None,
    "null": None,
    "{}": None,
    '"2024-01-01"': T0,
}


@pytest.fixture(scope="module")
def read_texts(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    out = df.select("text", F.unix_micros(times.text_to_timestamp(F.col("text"))).alias("us"))
    return {r["text"]: r["us"] for r in out.collect()}


@pytest.mark.parametrize("text", TEXTS)
def test_text_to_timestamp(read_texts, text):
    assert read_texts[text] == TEXTS[text]


def test_value_to_timestamp(spark):
    df = spark.createDataFrame([(t,) for t in VALUES], "line string").withColumn("v", J.parse("line"))
    moment = times.value_to_timestamp(J.kind("v"), J.text("v"))
    found = {r["line"]: r["us"] for r in df.select("line", F.unix_micros(moment).alias("us")).collect()}
    assert found == VALUES


def test_reading_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00",)], "text string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(F.unix_micros(times.text_to_timestamp(F.col("text"))).alias("us")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row["us"] == T0


def test_micros_and_moments_round_trip():
    moment = datetime(2024, 3, 31, 1, 30, 0, 123_457, tzinfo=UTC)
    assert times.from_micros(times.to_micros(moment)) == moment
    assert times.to_micros(moment.replace(tzinfo=None)) == times.to_micros(moment)
    assert times.from_micros(None) is None


def test_partition_numbers(spark):
    row = spark.sql("select timestamp '2024-02-09 10:11:12.345678' as ts").select(
        times.month_number("ts").alias("m"),
        times.day_number("ts").alias("d"),
        times.minute_of("ts").alias("minute"),
    )
    got = row.select("m", "d", F.date_format("minute", "HH:mm:ss").alias("t")).first()
    assert tuple(got) == (202402, 20240209, "10:11:00")


def test_canonical_json(spark):
    df = spark.createDataFrame([('{ "b": [1, {"d": null, "c": "ü"}], "a": true }',)], "line string")
    text = df.select(J.canonical_json(J.parse("line")).alias("x")).first()["x"]
    assert text == '{"a":true,"b":[1,{"c":"ü","d":null}]}'
