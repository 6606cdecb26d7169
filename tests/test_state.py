"""Keyed state on streams: newest versions as changes, safe cursors, and loads by finished units."""

from __future__ import annotations

import random
import threading
from datetime import UTC, datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmarts import contracts as C
from eventmarts.operators import progress
from eventmarts.operators.dedup import latest_per_key
from eventmarts.plans import vertical
from eventmarts.sources import tables, topics
from eventmarts.sources.ledger import Ledger, Unit
from eventmarts.streaming import archive, changes, safe_cursors

DAY = datetime(2024, 1, 10, tzinfo=UTC)
POSTS = "did string, rkey string, cid string, created_at timestamp, ingest_ts timestamp, kafka_partition int, kafka_offset long, langs array<string>"
COLUMNS = [c.split()[0] for c in POSTS.split(", ")]


def post(did, rkey, offset, minute, ingest=0, cid=None):
    return (did, rkey, cid, DAY + timedelta(minutes=minute), DAY + timedelta(seconds=ingest), 0, offset, ["en"])


class Feed:
    """A change stream that takes one folder of rows at a time."""

    def __init__(self, spark, root, **options):
        self.spark, self.root, self.options, self.seen = spark, str(root), options, []

    def give(self, rows):
        self.seen += rows
        self.spark.createDataFrame(rows, POSTS).coalesce(2).write.mode("append").parquet(f"{self.root}/in")
        stream = self.spark.readStream.schema(POSTS).parquet(f"{self.root}/in")
        paths = [f"{self.root}/{p}" for p in ("log", "minutes", "checkpoint")]
        changes.change_stream(stream, *paths, **self.options).awaitTermination()
        return self

    def current(self):
        rows = changes.current_rows(self.spark.read.parquet(f"{self.root}/log"), COLUMNS)
        return sorted(map(tuple, rows.select(*COLUMNS).collect()), key=str)

    def minutes(self):
        found = changes.minutes_of_records(self.spark, f"{self.root}/minutes").collect()
        return sorted((r["time"], r["posts"]) for r in found)


def expected(spark, rows):
    newest = latest_per_key(spark.createDataFrame(rows, POSTS), changes.VERSION)
    minutes = newest.groupBy(F.date_trunc("minute", "created_at").alias("t")).count()
    return sorted(map(tuple, newest.collect()), key=str), sorted(map(tuple, minutes.collect()))


def test_changes_equal_the_batch_answer_after_every_batch(spark, tmp_path):
    rng, feed = random.Random(1), Feed(spark, tmp_path)
    rows = [
        post(f"d{rng.randrange(6)}", f"r{rng.randrange(5)}", n, rng.randrange(4), rng.randrange(3), rng.choice([None, "a", "b"]))
        for n in range(150)
    ]
    rng.shuffle(rows)
    for batch in (rows[:60], rows[60:100] + rows[:20], rows[100:] + rows[50:90]):
        feed.give(batch)
        assert (feed.current(), feed.minutes()) == expected(spark, feed.seen)


def test_a_moved_record_counts_once_and_old_versions_change_nothing(spark, tmp_path):
    feed = Feed(spark, tmp_path).give([post("a", "1", 5, minute=7, ingest=50)])
    feed.give([post("a", "1", 9, minute=2, ingest=90)])
    assert [n for _, n in feed.minutes()] == [1]
    feed.give([post("a", "1", 1, minute=3, ingest=10), post("a", "1", 9, minute=2, ingest=90)])
    assert feed.minutes() == [(datetime(2024, 1, 10, 0, 2), 1)]
    log = spark.read.parquet(f"{tmp_path}/log")
    assert sorted(r["change"] for r in log.collect()) == [-1, 1, 1]


def test_state_is_read_and_written_by_parts_not_by_records(spark, tmp_path, monkeypatch):
    """One part holds all records here; each still goes by its own key, nulls too, and its own time."""
    monkeypatch.setattr(changes, "PARTS", 1)
    feed = Feed(spark, tmp_path)
    for n in range(2):
        feed.give([post(f"d{i}" if i % 7 else None, "r" if i % 3 else None, i + 500 * n, i % 5 + n, n) for i in range(400)])
        assert (feed.current(), feed.minutes()) == expected(spark, feed.seen)


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_records_of_a_part_are_forgotten_each_by_its_own_last_change():
    shape = T.StructType.fromDDL("v long")
    newest, kept = changes._Newest(["k"], shape, ["v"], timedelta(milliseconds=100)), Kept()
    newest.init(kept)

    def give(now, *rows):
        return [tuple(r) for r in newest.handleInputRows((0,), iter([Row(k=k, v=v) for k, v in rows]), Clock(now))]

    assert give(0, ("a", 1), ("b", 1), ("b", 2)) == [("a", 1, 1), ("b", 2, 1)]
    assert give(60, ("a", 1), ("b", 3)) == [("b", 2, -1), ("b", 3, 1)]
    assert give(110, ("a", 1), ("b", 3)) == [("a", 1, 1)]
    assert give(170, ("a", 0), ("b", 3)) == [("b", 3, 1)]


def test_a_hot_key_is_thinned_out_before_the_shuffle(spark):
    rows = spark.range(0, 5000, 1, 4).selectExpr(
        "'a' as did", "'r' as rkey", "cast(null as string) as cid", "id as kafka_offset"
    )
    out = rows.mapInArrow(changes._combine(["did", "rkey"], ["kafka_offset", "cid"]), rows.schema).collect()
    assert len(out) <= 8 and max(r["kafka_offset"] for r in out) == 4999


def test_a_forgotten_record_is_new_again(spark, tmp_path):
    import time

    feed = Feed(spark, tmp_path, keep=timedelta(milliseconds=1)).give([post("a", "1", 5, 7)])
    time.sleep(0.1)
    feed.give([post("a", "1", 5, 7)])
    assert [r["change"] for r in spark.read.parquet(f"{tmp_path}/log").collect()] == [1, 1]


class Stored:
    """Map state as the chain of links sees it, counting what is read and written."""

    def __init__(self):
        self.links, self.reads, self.writes = {}, 0, 0

    def containsKey(self, key):
        self.reads += 1
        return key in self.links

    def getValue(self, key):
        return self.links[key]

    def updateValue(self, key, value):
        self.writes += 1
        self.links[key] = value

    def removeKey(self, key):
        self.writes += 1
        del self.links[key]


def whole_log(registered: dict, acked: dict):
    gaps = [c for c, n in registered.items() if acked.get(c, 0) < n]
    return max((c for c in registered if acked.get(c, 0) >= registered[c] and (not gaps or c < min(gaps))), default=None)


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_safe_cursor_equals_that_of_the_whole_log_after_every_batch(data):
    stored, registered, acked, next_cursor = Stored(), {}, {}, 10
    for _ in range(data.draw(st.integers(1, 6))):
        chain = safe_cursors._Chain(stored)
        for step in data.draw(st.lists(st.integers(0, 3), max_size=6)):
            next_cursor += step  # 0: registered again
            if registered and next_cursor in registered and acked.get(next_cursor, 0) >= registered[next_cursor]:
                next_cursor += 1
            registered[next_cursor] = registered.get(next_cursor, 0) + 1
            chain.register(next_cursor)
        left = [c for c, n in registered.items() for _ in range(n - acked.get(c, 0))]
        for c in data.draw(st.permutations(left))[: data.draw(st.integers(0, len(left)))]:
            acked[c] = acked.get(c, 0) + 1
            chain.ack(c)
        chain.ack(3)  # never registered
        safe = chain.head()[3]
        chain.save()
        assert safe == whole_log(registered, acked)
        assert len(stored.links) == 1 + sum(acked.get(c, 0) < n for c, n in registered.items())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 12)), max_size=40))
def test_late_registrations_never_put_the_cursor_past_a_gap_it_had_not_passed(events):
    stored, registered, acked, safe = Stored(), {}, {}, None
    for is_ack, cursor in events:
        chain = safe_cursors._Chain(stored)
        if is_ack:
            if cursor in registered:
                acked[cursor] = registered[cursor]
            for _ in range(registered.get(cursor, 0)):
                chain.ack(cursor)
        elif cursor not in registered:
            if safe is None or cursor > safe:
                registered[cursor] = 1
            chain.register(cursor)
        before, safe = safe, chain.head()[3]
        chain.save()
        right = whole_log(registered, acked)
        assert safe is None or (right is not None and safe <= right)
        assert before is None or safe >= before


def test_an_acknowledgement_costs_its_own_size():
    stored = Stored()
    chain = safe_cursors._Chain(stored)
    for cursor in range(100_000):
        chain.register(cursor)
    chain.save()
    stored.reads = stored.writes = 0
    chain = safe_cursors._Chain(stored)
    chain.ack(50_000)
    chain.save()
    assert stored.reads <= 4 and stored.writes <= 3


class Kept:
    """State of one key, as a processor is given it."""

    def __init__(self):
        self.value, self.map = None, {}

    def getMapState(self, *_):
        stored = Stored()
        stored.links = self.map
        return stored

    def getValueState(self, *_, **__):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


@pytest.mark.parametrize("block", [1, 3, 1 << 16])
@settings(max_examples=150, deadline=None)
@given(batches=st.lists(st.lists(st.tuples(st.booleans(), st.integers(0, 14)), max_size=25), max_size=5))
def test_a_batch_at_once_equals_one_report_after_the_other(block, batches):
    stored, kept = Stored(), Kept()
    with pytest.MonkeyPatch.context() as m:
        m.setattr(safe_cursors, "BLOCK", block)
        for batch in batches:
            chain, safe = safe_cursors._Chain(stored), safe_cursors._Safe()
            registered, acked = ([c for is_ack, c in batch if is_ack == kind] for kind in (False, True))
            for c in sorted(registered):
                chain.register(c)
            for c in acked:
                chain.ack(c)
            head = chain.head()
            chain.save()
            safe.init(kept)
            assert safe._advance(np.array(registered, np.int64), np.array(acked, np.int64)) == (head[3], head[1])
            blocks = [np.frombuffer(kept.map[b][0], np.int64).reshape(3, -1) for b in sorted(kept.map)]
            links = {int(c): (int(n), None if a < 0 else int(a)) for part in blocks for c, n, a in part.T}
            assert links == {c: (k[2], k[3]) for (c,), k in stored.links.items() if c >= 0}


def test_late_registrations_of_a_long_log_take_no_walk():
    import time

    safe, kept, n = safe_cursors._Safe(), Kept(), 200_000
    safe.init(kept)
    none, began = np.empty(0, np.int64), time.monotonic()
    assert safe._advance(np.arange(n, 2 * n), none) == (None, n)
    assert safe._advance(np.arange(n), none) == (None, 0)
    assert safe._advance(none, np.arange(2 * n - 1)) == (2 * n - 2, 2 * n - 1)
    assert time.monotonic() - began < 10 and len(kept.map) == 1


def test_safe_cursors_on_a_stream(spark, tmp_path):
    batches = [
        [("a", 1, "registered"), ("a", 2, "registered"), ("b", 5, "registered"), ("a", 2, "acked"), ("c", None, "acked")],
        [("a", 3, "registered"), ("a", 1, "acked"), ("b", 5, "failed")],
        [("a", 3, "acked"), ("b", 6, "registered"), ("b", 6, "acked"), ("b", 99, "acked")],
    ]
    want = [{"a": None, "b": None, "c": None}, {"a": 2, "b": None, "c": None}, {"a": 3, "b": None, "c": None}]
    shape = "stream string, cursor long, kind string"
    for rows, safe in zip(batches, want, strict=True):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(shape).parquet(f"{tmp_path}/in")
        safe_cursors.safe_cursor_stream(stream, f"{tmp_path}/safe", f"{tmp_path}/checkpoint").awaitTermination()
        got = safe_cursors.read_safe_cursors(spark, f"{tmp_path}/safe").collect()
        assert {r["stream"]: r["safe_cursor"] for r in got} == safe


def test_ledger(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Ledger, "FOLD", 3)
    made, done = Ledger(spark, f"{tmp_path}/a"), Ledger(spark, f"{tmp_path}/b")
    day = datetime(2024, 1, 1).date()
    assert made.pending(done, 10) == [] and made.totals() == (0, None)
    units = [Unit(f"u{i}", day if i % 3 else None, i, 100 - i) for i in range(8)]
    for u in units:
        made.add([u], u.unit)
        made.add([u], u.unit)
    assert made.totals() == (28, 100)
    assert sorted(u.unit for u in made.pending(done, 100)) == [u.unit for u in units]
    first = made.pending(done, 5)
    done.add(first)
    assert len(first) == 5 and {u.unit for u in made.pending(done, 100)} == {u.unit for u in units} - {u.unit for u in first}
    made.fold()
    assert made.totals() == (28, 100) and made._new() == []
    assert len(made._generations()) <= 2


def flat(spark, number, rows):
    body = "'{\"did\":\"d' || id || '\",\"rkey\":\"r\",\"cid\":\"c\",\"created_at\":\"2024-01-01T00:00:00Z\",\"subject_did\":\"s\"}'"
    return spark.range(rows).selectExpr(f"{body} as payload", "0 as kafka_partition", f"id + {number * rows} as kafka_offset")


def landed(spark, root):
    rows = tables.read_archived(spark, f"{root}/landing", C.FOLLOW.bronze)
    return sorted(r["kafka_offset"] for r in rows.select("kafka_offset").collect())


def test_landing_beside_a_running_archive_loses_nothing(spark, tmp_path):
    root, per, count = str(tmp_path), 20, 6
    finished, loaded = Ledger(spark, f"{root}/l/bronze"), Ledger(spark, f"{root}/l/landing")
    flat(spark, 0, per).write.parquet(f"{root}/topic")
    stream = archive.archive_stream(
        topics.stream_topic(spark, f"{root}/topic", max_files=3),
        C.FOLLOW,
        f"{root}/bronze",
        f"{root}/dlq",
        f"{root}/checkpoint",
        ledger=finished,
        drain=False,
        every_seconds=0.2,
    )

    def produce():
        for n in range(1, count):
            flat(spark, n, per).write.mode("append").parquet(f"{root}/topic")

    writer = threading.Thread(target=produce)
    writer.start()
    taken = 0
    try:
        for _ in range(60):
            taken += vertical.load_units(spark, f"{root}/bronze", C.FOLLOW.bronze, finished, f"{root}/landing", loaded, most=2)
            if taken == per * count:
                break
    finally:
        writer.join()
        stream.stop()
    assert landed(spark, root) == list(range(per * count))


def test_a_load_that_died_before_its_record_is_put_right(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    finished, loaded = Ledger(spark, f"{root}/l/bronze"), Ledger(spark, f"{root}/l/landing")

    def run(number, clock):
        flat(spark, number, 10).write.mode("append").parquet(f"{root}/topic")
        archive.archive_stream(
            topics.stream_topic(spark, f"{root}/topic"), C.FOLLOW, f"{root}/bronze", f"{root}/dlq",
            f"{root}/checkpoint", ingest_ts=F.lit(clock), ledger=finished,
        ).awaitTermination()

    def load():
        return vertical.load_units(spark, f"{root}/bronze", C.FOLLOW.bronze, finished, f"{root}/landing", loaded)

    run(0, DAY)
    with monkeypatch.context() as m:
        m.setattr(Ledger, "add", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            load()
    run(1, DAY - timedelta(days=2))  # the clock went back, and the retry finds more than the first try
    assert load() == 20 and load() == 0
    assert landed(spark, root) == list(range(20))
    assert finished.totals()[0] == loaded.totals()[0] == 20


def test_progress_agrees(spark):
    log = spark.createDataFrame([("a", 1, True, True), ("a", 2, True, False)], "stream string, cursor long, registered boolean, acked boolean")
    assert progress.safe_cursor(log).first()["safe_cursor"] == 1
