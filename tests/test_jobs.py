"""Streams and whole jobs: resume, retry, replay, order of arrival, gates."""

from __future__ import annotations

import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventmarts import contracts as C
from eventmarts.functions import times
from eventmarts.operators import checks, dedup, panels
from eventmarts.plans import compaction, vertical
from eventmarts.session import shared_dir
from eventmarts.sources import raw, tables, topics
from eventmarts.sources.cursors import CursorTable
from eventmarts.streaming import archive, batches, ingest, realtime

NOW = datetime(2024, 1, 3, tzinfo=UTC)


def record(n: int, **values) -> dict:
    base = {
        "did": f"did:{n % 5}",
        "rkey": f"r{n}",
        "cid": f"c{n}",
        "created_at": f"2024-01-0{1 + n % 2}T00:00:{n % 60:02d}Z",
        "text": "t",
        "langs": ["en"] if n % 3 else [],
    }
    return base | values


def put(spark, path: str, records: list[tuple[int, dict | None]], event: str = "post") -> None:
    """Add one file of records to a topic folder."""
    rows = [(None if r is None else json.dumps(r), o % 6, o) for o, r in records]
    df = spark.createDataFrame(rows, "payload string, kafka_partition int, kafka_offset long")
    df.coalesce(1).write.mode("append").parquet(path)


def run_archive(spark, root, **options):
    summary: dict = {}
    archive.archive_stream(
        topics.stream_topic(spark, f"{root}/topic", max_files=1),
        C.POST,
        f"{root}/bronze",
        f"{root}/dlq",
        options.pop("checkpoint", f"{root}/checkpoint"),
        summary=summary,
        **options,
    ).awaitTermination()
    return summary


def bronze_of(spark, root):
    return tables.read_archived(spark, f"{root}/bronze", C.POST.bronze)


def test_archive_resumes_and_rerun_adds_nothing(spark, tmp_path):
    root = str(tmp_path)
    put(spark, f"{root}/topic", [(i, record(i)) for i in range(10)] + [(10, {"did": 1}), (11, None)])
    assert run_archive(spark, root) == {"archived_this_run": 10, "dlq_this_run": 2}
    assert run_archive(spark, root) == {"archived_this_run": 0, "dlq_this_run": 0}
    put(spark, f"{root}/topic", [(20, record(20))])
    assert run_archive(spark, root) == {"archived_this_run": 1, "dlq_this_run": 0}
    bronze = bronze_of(spark, root)
    assert bronze.count() == 11
    assert C.schema_mismatches(bronze.select(*C.POST.bronze.names), C.POST.bronze) == []
    dead = tables.read_table(spark, f"{root}/dlq", C.DLQ)
    assert {r["intended_topic"] for r in dead.collect()} == {C.TOPIC_POST}


def test_batch_of_bad_records_only(spark, tmp_path):
    root = str(tmp_path)
    put(spark, f"{root}/topic", [(1, {"did": 1}), (2, None)])
    assert run_archive(spark, root) == {"archived_this_run": 0, "dlq_this_run": 2}
    assert bronze_of(spark, root).count() == 0


def test_one_arrival_time_per_batch(spark, tmp_path):
    root = str(tmp_path)
    for i in range(3):
        put(spark, f"{root}/topic", [(10 * i + j, record(10 * i + j)) for j in range(4)])
    run_archive(spark, root)
    per_batch = spark.read.parquet(f"{root}/bronze").groupBy("batch").agg(
        F.count_distinct("ingest_ts").alias("stamps")
    )
    assert [r["stamps"] for r in per_batch.collect()] == [1, 1, 1]


def test_batch_that_died_after_writing_is_replaced_on_retry(spark, tmp_path):
    """The first try writes bronze and then fails; the retry must not add the rows again."""
    root = str(tmp_path)
    put(spark, f"{root}/topic", [(i, record(i)) for i in range(6)])
    real = archive.rejected

    def failing(*args):
        raise RuntimeError("driver lost")

    # Bronze is written before the dead letters are.
    archive_write = archive.write_unit

    def write_then_fail(rows, path, *args, **kwargs):
        count = archive_write(rows, path, *args, **kwargs)
        if path.endswith("/bronze"):
            raise RuntimeError("driver lost")
        return count

    archive.write_unit = write_then_fail
    try:
        with pytest.raises(Exception, match="driver lost"):
            run_archive(spark, root)
    finally:
        archive.write_unit = archive_write
    assert bronze_of(spark, root).count() == 6
    first_stamp = bronze_of(spark, root).first()["ingest_ts"]
    assert real is archive.rejected
    run_archive(spark, root)
    assert bronze_of(spark, root).count() == 6
    assert bronze_of(spark, root).first()["ingest_ts"] == first_stamp


def test_lost_checkpoint_repeats_rows_but_never_overwrites(spark, tmp_path):
    root = str(tmp_path)
    put(spark, f"{root}/topic", [(i, record(i)) for i in range(6)])
    run_archive(spark, root)
    run_archive(spark, root, checkpoint=f"{root}/checkpoint2")
    bronze = bronze_of(spark, root)
    assert tuple(dedup.raw_vs_deduped(bronze).first()) == (12, 6)


def vertical_run(spark, root, now=NOW, event=C.POST):
    paths = vertical.Paths(f"{root}/tables")
    topic = topics.stream_topic(spark, f"{root}/topic")
    summary = vertical.run_vertical(spark, event, topic, paths, now)
    mart = tables.read_mart(spark, paths.table("mart", event), event.mart)
    rows = sorted(tuple(str(v) for v in r) for r in mart.collect())
    return summary, rows


def test_vertical_and_rerun(spark, tmp_path):
    root = str(tmp_path)
    put(spark, f"{root}/topic", [(i, record(i)) for i in range(12)])
    summary, mart = vertical_run(spark, root)
    assert summary["landed_this_run"] == summary["staged_this_run"] == summary["bronze_total"] == 12
    assert all(r["passed"] for r in summary["checks"])
    again, mart_again = vertical_run(spark, root)
    assert again["archived_this_run"] == again["landed_this_run"] == again["staged_this_run"] == 0
    assert mart_again == mart
    assert again["landing_total"] == 12


def test_replayed_records_do_not_inflate_the_mart(spark, tmp_path):
    root = str(tmp_path)
    records = [(i, record(i)) for i in range(12)]
    put(spark, f"{root}/topic", records)
    _, mart = vertical_run(spark, root)
    put(spark, f"{root}/topic", records[:6])
    summary, mart_again = vertical_run(spark, root)
    assert summary["landing_total"] == 18 and mart_again == mart
    staged = vertical.read_staging(spark, vertical.Paths(f"{root}/tables"), C.POST)
    assert C.schema_mismatches(staged, C.POST.staging) == []
    landing = vertical.read_landing(spark, vertical.Paths(f"{root}/tables"), C.POST)
    assert checks.reconcile_staging(staged, landing).first()["passed"]


def test_order_of_files_does_not_matter(spark, tmp_path):
    """The same records in one file or in several, in either order, give the same mart."""
    records = [(i, record(i)) for i in range(12)] + [(30, record(3, langs=["ja"]))]
    marts = []
    for name, split in (("a", [records]), ("b", [records[:5], records[5:]]), ("c", [records[::-1]])):
        root = str(tmp_path / name)
        for part in split:
            put(spark, f"{root}/topic", part)
        marts.append(vertical_run(spark, root)[1])
    assert marts[0] == marts[1] == marts[2]


def test_blocking_check_stops_before_the_mart(spark, tmp_path):
    root = str(tmp_path)
    put(spark, f"{root}/topic", [(1, record(1)), (2, record(2, cid=""))])
    with pytest.raises(checks.CheckFailed, match="null_rate"):
        vertical_run(spark, root)
    paths = vertical.Paths(f"{root}/tables")
    assert not tables.exists(spark, paths.table("mart", C.POST))
    # A corrected version of the record clears the check.
    put(spark, f"{root}/topic", [(3, record(2))])
    _, mart = vertical_run(spark, root)
    assert len(mart) > 0


def test_stale_bronze_only_warns(spark, tmp_path):
    root = str(tmp_path)
    put(spark, f"{root}/topic", [(1, record(1))])
    summary, mart = vertical_run(spark, root, now=NOW + timedelta(days=30))
    verdicts = {r["check_name"]: r["passed"] for r in summary["checks"]}
    assert verdicts["freshness"] is False and len(mart) == 1


@pytest.mark.parametrize("name", ["like", "follow"])
def test_other_verticals(spark, tmp_path, name):
    event = C.EVENT_TYPES[name]
    root = str(tmp_path)
    own = {"subject_uri": "at://x", "subject_cid": "cx"} if name == "like" else {"subject_did": "did:x"}
    rows = []
    for i in range(4):
        r = {k: v for k, v in record(i).items() if k not in ("text", "langs")} | own
        rows.append((i, r))
    put(spark, f"{root}/topic", rows)
    _, mart = vertical_run(spark, root, event=event)
    assert [r[2:] for r in mart] == [("2", "2"), ("2", "2")]


def test_load_that_died_before_saving_its_mark_is_replaced(spark, tmp_path):
    root = str(tmp_path)
    state = CursorTable(spark, f"{root}/state")
    rows = tables.with_day_columns(
        spark.range(5).select(
            F.col("id"), times.instant(NOW).alias("ingest_ts"), times.instant(NOW).alias("created_at")
        )
    )
    tables.write_unit(rows, f"{root}/t", "load", "0", tables.DAY_COLUMNS)  # died here
    assert vertical.load_newer(rows, f"{root}/t", state, "x", NOW) == 5
    assert spark.read.parquet(f"{root}/t").count() == 5
    assert vertical.load_newer(rows, f"{root}/t", state, "x", NOW) == 0


def test_block_rows_bound_file_size(spark, tmp_path):
    rows = spark.range(100).coalesce(1)
    tables.write_unit(rows, str(tmp_path), "load", "0", block_rows=30)
    per_file = spark.read.parquet(str(tmp_path)).groupBy(F.input_file_name()).count()
    assert sorted(r["count"] for r in per_file.collect()) == [10, 30, 30, 30]


def test_landing_scan_skips_earlier_days(spark, tmp_path):
    root = str(tmp_path)
    put(spark, f"{root}/topic", [(1, record(1))])
    run_archive(spark, root)
    from eventmarts.operators.incremental import newer_than

    plan = newer_than(bronze_of(spark, root), NOW)._jdf.queryExecution().executedPlan().toString()
    assert "ingest_day" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_ingest_stream_routes_everything(spark, tmp_path, sf):
    from eventmarts.plans import event_views

    root = str(tmp_path)
    lines = event_views.raw_lines(spark, sf)
    lines.select("value").repartition(3).write.text(f"{root}/raw")
    paths = {name: f"{root}/topics/{name}" for name in C.EVENT_TYPES}
    ingest.ingest_stream(
        raw.stream_lines(spark, f"{root}/raw", max_files=1),
        paths,
        f"{root}/dlq",
        f"{root}/counters",
        f"{root}/checkpoint",
    ).awaitTermination()
    counted = spark.read.parquet(f"{root}/counters").groupBy("route").agg(F.sum("events").alias("n"))
    n = {r["route"]: r["n"] for r in counted.collect()}
    topic_rows = sum(topics.read_topic(spark, p).count() for p in paths.values())
    assert topic_rows == n["valid"]
    assert tables.read_table(spark, f"{root}/dlq", C.DLQ).count() == n["dlq"]
    posts = topics.read_topic(spark, paths["post"])
    from eventmarts.operators.validation import validate_flat

    assert validate_flat(posts, C.POST).where("error is not null").count() == 0
    spread = posts.groupBy(F.get_json_object("payload", "$.did").alias("did")).agg(
        F.count_distinct("kafka_partition").alias("n")
    )
    assert spread.where("n > 1").count() == 0


def test_realtime_latest_version_wins_within_and_across_batches(spark, tmp_path):
    root = str(tmp_path)
    schema = (
        "did string, rkey string, cid string, created_at long, text string, langs array<string>, "
        "reply_parent string, reply_root string, kafka_partition int, kafka_offset long"
    )

    def add(*versions):
        rows = [("a", k, f"c{o}", 1_704_067_200_000_001, t, None, None, None, 0, o) for k, t, o in versions]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/topic")

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{root}/topic")
        realtime.realtime_stream(stream, f"{root}/mart", f"{root}/cp").awaitTermination()
        return {r["rkey"]: r for r in realtime.realtime_latest(spark, f"{root}/mart").collect()}

    add(("1", "first", 1), ("1", "second", 2), ("2", "only", 3))
    got = run()
    assert got["1"]["text"] == "second" and got["2"]["langs"] == []
    add(("1", "replayed", 1))
    got = run()
    assert got["1"]["text"] == "replayed"
    latest = realtime.realtime_latest(spark, f"{root}/mart")
    assert C.schema_mismatches(latest, C.REALTIME) == []
    assert panels.total(latest).first()["total"] == 2
    assert got["1"]["created_at"].microsecond == 1


def test_minutes_count_late_and_future_events(spark, tmp_path):
    root = str(tmp_path)
    stamps = [0, 60, 61, 10**9, -(10**9), 62]
    for second in stamps:  # a batch each
        spark.createDataFrame([(second,)], "s long").select(
            F.timestamp_seconds(F.lit(1_704_067_200) + F.col("s")).alias("created_at")
        ).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema("created_at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    realtime.minute_stream(stream, f"{root}/out", f"{root}/cp").awaitTermination()
    assert sorted(r["posts"] for r in realtime.minute_counts(spark, f"{root}/out").collect()) == [1, 1, 1, 3]


def test_replays_are_dropped_and_nothing_else(spark, tmp_path):
    root = str(tmp_path)
    moments = {"a": "2024-01-01 00:00:00", "b": "2031-01-01 00:00:00", "c": "2024-01-01 00:01:00", "d": "1999-01-01 00:00:00"}
    for key in "abcadb":  # a batch each; one is dated far ahead, one far back
        spark.createDataFrame([("did", key, moments[key])], "did string, rkey string, t string").select(
            "did", "rkey", F.to_timestamp("t").alias("created_at")
        ).coalesce(1).write.mode("append").parquet(f"{root}/in")
    schema = "did string, rkey string, created_at timestamp"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")

    def keep(batch, batch_id):
        tables.write_unit(batch, f"{root}/out", "batch", str(batch_id))

    batches.start(realtime.first_seen(stream), keep, f"{root}/cp").awaitTermination()
    assert sorted(r["rkey"] for r in spark.read.parquet(f"{root}/out").collect()) == ["a", "b", "c", "d"]


def _lines(spark, root, numbers):
    rows = [
        json.dumps(
            {
                "did": f"did:{n}", "time_us": 1_704_067_200_000_000 + n, "kind": "commit",
                "commit": {"operation": "create", "collection": C.COLLECTION_POST, "rkey": f"r{n}", "cid": f"c{n}",
                           "record": {"createdAt": f"2024-01-01T00:00:00.{123456 + n:06d}Z", "text": "t"}},
            }
        )
        for n in numbers
    ]
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(f"{root}/raw")


def _ingest(spark, root, **options):
    return ingest.ingest_stream(
        raw.stream_lines(spark, f"{root}/raw", max_files=1),
        {name: f"{root}/topics/{name}" for name in C.EVENT_TYPES},
        f"{root}/dead", f"{root}/counters", f"{root}/ingested", **options,
    )


def test_subscription_from_a_cursor(spark, tmp_path):
    root = str(tmp_path)
    _lines(spark, root, range(8))
    _ingest(spark, root, cursor=1_704_067_200_000_004, collections=[C.COLLECTION_POST]).awaitTermination()
    posts = topics.read_topic(spark, f"{root}/topics/post")
    assert sorted(r["kafka_offset"] - 1_704_067_200_000_000 for r in posts.collect()) == [5, 6, 7]
    _lines(spark, root, [9, 2])
    _ingest(spark, root, cursor=1_704_067_200_000_004, collections=[C.COLLECTION_LIKE]).awaitTermination()
    assert topics.read_topic(spark, f"{root}/topics/post").count() == 3


def _archive_ingested(spark, root):
    archive.archive_stream(
        topics.stream_topic(spark, f"{root}/topics/post"), C.POST, f"{root}/bronze", f"{root}/dlq", f"{root}/archived"
    ).awaitTermination()
    return bronze_of(spark, root)


def test_retried_ingest_batch_is_not_archived_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    _lines(spark, root, range(8))
    real = ingest.write_unit

    def fail_at_the_counters(rows, path, *args, **kwargs):
        if path.endswith("/counters"):
            raise RuntimeError("driver lost")
        return real(rows, path, *args, **kwargs)

    monkeypatch.setattr(ingest, "write_unit", fail_at_the_counters)
    with pytest.raises(Exception, match="driver lost"):
        _ingest(spark, root).awaitTermination()
    assert _archive_ingested(spark, root).count() == 8
    monkeypatch.setattr(ingest, "write_unit", real)
    _ingest(spark, root).awaitTermination()
    bronze = _archive_ingested(spark, root)
    assert bronze.count() == 8 and spark.read.parquet(f"{root}/counters").count() > 0
    assert {r["created_at"].microsecond for r in bronze.collect()} == {123456 + n for n in range(8)}


def test_missing_tables_raise_and_reading_writes_nothing(spark, tmp_path):
    for read in (
        lambda path: tables.read_mart(spark, path, C.POST.mart),
        lambda path: tables.read_archived(spark, path, C.POST.bronze),
    ):
        with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
            read(f"{tmp_path}/nothing").count()
    assert tables.read_mart(spark, f"{tmp_path}/nothing", C.POST.mart, missing_ok=True).count() == 0
    assert CursorTable(spark, f"{tmp_path}/nothing").load("x") is None
    assert not list(tmp_path.iterdir())


def test_one_folder_per_day_and_few_files_per_batch(spark, tmp_path):
    root = str(tmp_path)
    put(spark, f"{root}/topic", [(i, record(i, created_at=f"2024-01-{1 + i % 28:02d}T00:00:00Z")) for i in range(56)])
    run_archive(spark, root)
    files = list((tmp_path / "bronze").rglob("*.parquet"))
    assert len(files) == 1
    assert [p.split("=")[0] for p in files[0].relative_to(tmp_path / "bronze").parts[:-1]] == ["ingest_day", "batch"]


def test_staging_load_prunes_landing(spark, tmp_path):
    from eventmarts.operators.incremental import newer_than

    root = str(tmp_path)
    put(spark, f"{root}/topic", [(1, record(1))])
    vertical_run(spark, root)
    landing = vertical.read_landing(spark, vertical.Paths(f"{root}/tables"), C.POST)
    stored = landing.select(*vertical._staged_shape(C.POST).names, *tables.STORED_DAYS)
    plan = newer_than(stored, NOW)._jdf.queryExecution().executedPlan().toString()
    assert "ingest_day" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_a_day_dated_ahead_does_not_freeze_the_mart(spark, tmp_path):
    root = str(tmp_path)
    paths = vertical.Paths(f"{root}/tables")

    def run(**options):
        topic = topics.stream_topic(spark, f"{root}/topic")
        vertical.run_vertical(spark, C.POST, topic, paths, NOW, **options)
        mart = tables.read_mart(spark, paths.table("mart", C.POST), C.POST.mart)
        return {str(r["day"]): r["n"] for r in mart.groupBy("day").agg(F.sum("posts").alias("n")).collect()}

    put(spark, f"{root}/topic", [(i, record(i, langs=["en"], created_at="2024-01-02T00:00:00Z")) for i in range(4)])
    put(spark, f"{root}/topic", [(9, record(9, langs=["en"], created_at="2031-01-01T00:00:00Z"))])
    assert run() == {"2024-01-02": 4, "2031-01-01": 1}
    put(spark, f"{root}/topic", [(i, record(i, langs=["en"], created_at="2024-01-02T00:00:00Z")) for i in (10, 11)])
    assert run()["2024-01-02"] == 4  # the window lies ahead
    assert run(max_event_time=NOW)["2024-01-02"] == 6


def test_clamped_window_reads_little_history(spark):
    from eventmarts.operators.incremental import latest_in_window

    rows = spark.range(200).select(
        F.lit("d").alias("did"), F.col("id").cast("string").alias("rkey"), F.lit("c").alias("cid"),
        F.when(F.col("id") == 0, F.lit(datetime(2031, 1, 1))).otherwise(
            F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 3600)).alias("created_at"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 3600).alias("ingest_ts"),
        F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset"),
    )
    start, until = datetime(2024, 1, 8).date(), datetime(2024, 1, 20, tzinfo=UTC)
    got = latest_in_window(rows, start, until=until)
    want = dedup.latest_per_key(rows).where((F.col("created_at") >= F.lit(start)) & (F.col("created_at") <= F.lit(until)))
    assert sorted(r["kafka_offset"] for r in got.collect()) == sorted(r["kafka_offset"] for r in want.collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-01-08" in plan


def test_running_stream_flushes_by_interval(spark, tmp_path):
    import time

    root = str(tmp_path)
    put(spark, f"{root}/topic", [(i, record(i)) for i in range(3)])
    query = archive.archive_stream(
        topics.stream_topic(spark, f"{root}/topic", max_files=1), C.POST, f"{root}/bronze", f"{root}/dlq",
        f"{root}/checkpoint", drain=False, every_seconds=0.5,
    )
    try:
        put(spark, f"{root}/topic", [(i, record(i)) for i in range(10, 14)])
        waited = time.time() + 60
        while time.time() < waited and (
            not tables.exists(spark, f"{root}/bronze") or bronze_of(spark, root).count() < 7
        ):
            time.sleep(0.5)
        assert query.isActive
    finally:
        query.stop()
    per_batch = spark.read.parquet(f"{root}/bronze").groupBy("batch").count()
    assert sorted(r["count"] for r in per_batch.collect()) == [3, 4]


def test_generations_follow_their_numbers(spark, tmp_path):
    root = f"{tmp_path}/table"
    state = CursorTable(spark, f"{tmp_path}/state")
    rows = spark.createDataFrame([("a", "1", 1)], "did string, rkey string, v int")
    compaction.compact(rows, root, state, NOW, ["v"])
    second = compaction.compact(rows, root, state, NOW - timedelta(hours=1), ["v"])
    assert compaction.current_generation(root, state) == second
    assert compaction.compact(rows, root, state, NOW, ["v"]).endswith("generation=3")


def test_compaction_switches_generations(spark, tmp_path):
    root = f"{tmp_path}/table"
    state = CursorTable(spark, f"{tmp_path}/state")
    assert compaction.current_generation(root, state) is None
    rows = spark.createDataFrame([("a", "1", 1), ("a", "1", 2)], "did string, rkey string, v int")
    first = compaction.compact(rows, root, state, NOW, ["v"])
    assert spark.read.parquet(first).count() == 1
    second = compaction.compact(spark.read.parquet(first), root, state, NOW + timedelta(1), ["v"])
    assert compaction.current_generation(root, state) == second != first
    assert spark.read.parquet(first).count() == 1


class _Session:
    """Just enough of a session to ask where its shared folder is."""

    def __init__(self, master: str, folder: str | None) -> None:
        self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}
        self.sparkContext = self
        self.master = master


def test_shared_dir_is_the_clusters(tmp_path):
    on_cluster = _Session("spark://host:7077", str(tmp_path))
    assert shared_dir(on_cluster, "x").startswith(f"{tmp_path}/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Session("spark://host:7077", None), "x")
    assert shared_dir(_Session("local[2]", None), "x").startswith("/")
