"""The registered queries: each operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmarts import contracts as C
from eventmarts.functions import json_fields as J
from eventmarts.functions import times
from eventmarts.operators import checks, dedup, distinct, incremental, marts, panels, progress, routing
from eventmarts.operators import validation
from eventmarts.plans import audited, compaction, vertical
from eventmarts.plans import event_views as views
from eventmarts.session import configure, shared_dir
from eventmarts.sources import bounded, ledger, published, raw, tables, topics
from eventmarts.sources.cursors import CursorTable
from eventmarts.streaming import archive, batches, changes, ingest, realtime, safe_cursors

Query = Callable[[SparkSession, str], DataFrame]

NOW = datetime(2024, 1, 31, 12, tzinfo=UTC)
HALFWAY = datetime(2024, 1, 15, 12, tzinfo=UTC)
RECENT = date(2024, 1, 28)
START_MICROS = 1_705_000_000_000_000

_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name, with the session options results depend on."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    _REGISTRY[fn.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _plain(name: str) -> Column:
    """A timestamp column without zone, as the test tables have it."""
    return F.col(name).cast("timestamp_ntz").alias(name)


def _tags(name: str = "langs") -> Column:
    """A list as text, for comparing results."""
    return F.concat_ws("|", name).alias(name)


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.latest_per_key(views.archived(spark, sf_dir))


_DEDUP_COLUMNS = ["did", "rkey", "cid", "created_at", "kafka_partition", "kafka_offset", "ingest_ts"]

# --- deduplication -----------------------------------------------------------------------


@query
def dedup_latest(spark, sf_dir):
    return _latest(spark, sf_dir).select(*_DEDUP_COLUMNS, _tags())


@query
def dedup_unversioned(spark, sf_dir):
    """Mart groups written by three runs; the last run's row wins."""
    runs = views.archived(spark, sf_dir).withColumn("run_seq", F.col("kafka_offset") % 3)
    written = runs.groupBy(
        times.day_of("created_at").alias("day"), F.col("text").alias("tag"), "run_seq"
    ).agg(F.count(F.lit(1)).alias("posts"))
    return dedup.latest_insert(written, ("day", "tag"))


@query
def duplicate_keys(spark, sf_dir):
    return dedup.duplicate_keys(views.archived(spark, sf_dir))


@query
def raw_vs_deduped(spark, sf_dir):
    return dedup.raw_vs_deduped(views.archived(spark, sf_dir))


@query
def staging_reconciliation(spark, sf_dir):
    return checks.reconcile_staging(_latest(spark, sf_dir), views.archived(spark, sf_dir))


@query
def compact_table(spark, sf_dir):
    """Compact the archive twice, the second time after appending everything again."""
    root = shared_dir(spark, "compact")
    state = CursorTable(spark, f"{root}/state")
    rows = views.archived(spark, sf_dir)
    version = ["ingest_ts", "kafka_partition", "kafka_offset", "cid"]
    table = f"{root}/table"
    first = compaction.compact(rows, table, state, HALFWAY, version)
    again = spark.read.parquet(first).unionByName(rows)
    compaction.compact(again, table, state, NOW, version)
    current = spark.read.parquet(compaction.current_generation(table, state))
    return current.select(*_DEDUP_COLUMNS)


@query
def dedup_bucketed(spark, sf_dir):
    """The newest version of every record of a table stored by author, without a shuffle."""
    path = shared_dir(spark, "by-author")
    name = "by_author_" + path.rsplit("-", 1)[1]
    stored = dedup.write_by_author(views.archived(spark, sf_dir), path, name, buckets=8)
    return dedup.latest_per_key(stored).select(*_DEDUP_COLUMNS, _tags())


@query
def compact_by_day(spark, sf_dir):
    """An archive compacted day by day: first its early days, then the rest and a day that changed."""
    root = shared_dir(spark, "days")
    rows = tables.with_day_columns(views.archived(spark, sf_dir).select(*_DEDUP_COLUMNS, "langs"))
    shape = T.StructType([f for f in rows.schema.fields if f.name not in tables.STORED_DAYS])
    finished, compacted = ledger.Ledger(spark, f"{root}/finished"), ledger.Ledger(spark, f"{root}/compacted")
    table = audited.archive_table(spark, f"{root}/table", shape)

    def arrive(part: DataFrame, key: str) -> None:
        seen = tables.write_unit(part, f"{root}/in", "batch", key, tables.DAY_COLUMNS, days=F.collect_set("ingest_day"))
        finished.add([ledger.Unit(key, day, 0) for day in seen["days"]], key)

    def compact(before: date) -> list[date]:
        return audited.compact_days(spark, f"{root}/in", shape, finished, compacted, table, before)

    number, early = F.col("kafka_offset"), F.col("ingest_day") < F.lit(HALFWAY.date())
    arrive(rows.where(early | (number % 2 == 0)), "a")
    compact(HALFWAY.date())
    arrive(rows.where(~early & (number % 2 == 1)), "b")
    compact(date.max)
    if compact(date.max):
        raise AssertionError("a day without new rows was written again")
    return dedup.latest_per_key(table.read()).select(*_DEDUP_COLUMNS, _tags())


# --- marts -------------------------------------------------------------------------------


@query
def mart_by_tag_daily(spark, sf_dir):
    return marts.posts_by_lang(_latest(spark, sf_dir))


@query
def mart_by_subject_daily_likes(spark, sf_dir):
    likes = dedup.latest_per_key(views.subjects(spark, sf_dir, "click", "subject_uri"))
    return marts.events_by_subject(likes, "subject_uri", "likes", "likers")


@query
def mart_by_subject_daily_follows(spark, sf_dir):
    follows = dedup.latest_per_key(views.subjects(spark, sf_dir, "signup", "subject_did"))
    return marts.events_by_subject(follows, "subject_did", "follows", "followers")


@query
def mart_rollup(spark, sf_dir):
    return marts.rollup(marts.posts_by_lang(_latest(spark, sf_dir)), "posts")


def _in_batches(spark: SparkSession, records: DataFrame, rows, group: str) -> distinct.DistinctMart:
    """A mart of day sets built from three batches of records, each of which touches every day."""
    mart = distinct.DistinctMart(spark, shared_dir(spark, "day-sets"), group)
    for part in range(3):
        mart.add(rows(records.where(F.pmod(F.xxhash64(*C.KEY), F.lit(3)) == part)), f"{part:04d}")
    return mart


@query
def mart_by_tag_mergeable(spark, sf_dir):
    """The daily mart from batches that add to its days without reading them."""
    return _in_batches(spark, _latest(spark, sf_dir), marts.lang_rows, "lang").totals("posts", "authors")


@query
def mart_by_subject_mergeable(spark, sf_dir):
    likes = dedup.latest_per_key(views.subjects(spark, sf_dir, "click", "subject_uri"))
    mart = _in_batches(spark, likes, lambda r: marts.subject_rows(r, "subject_uri"), "subject_uri")
    return mart.totals("likes", "likers")


@query
def mart_rewindow(spark, sf_dir):
    """Trailing days of the mart recomputed over rows that arrive late or are dated ahead."""
    rows = views.archived_late(spark, sf_dir)
    start = incremental.rewindow_start(RECENT)
    return marts.posts_by_lang(incremental.latest_in_window(rows, start))


@query
def mart_rewindow_clamped(spark, sf_dir):
    """The same with rows dated after now left out of the window."""
    rows = views.archived_late(spark, sf_dir)
    start = incremental.rewindow_start(RECENT)
    return marts.posts_by_lang(incremental.latest_in_window(rows, start, until=NOW))


@query
def mart_incremental_upsert(spark, sf_dir):
    """Build from the first half, then recompute the trailing days from everything."""
    path = shared_dir(spark, "mart")
    rows = views.archived_late(spark, sf_dir)
    for arrived in (rows.where(F.col("ingest_ts") <= times.instant(HALFWAY, "timestamp_ntz")), rows):
        latest_day = incremental.high_water(tables.read_mart(spark, path, C.POST.mart, missing_ok=True), "day")
        start = incremental.rewindow_start(latest_day)
        recomputed = marts.posts_by_lang(incremental.latest_in_window(arrived, start))
        tables.replace_days(recomputed, path, start, C.POST.mart)
    return tables.read_mart(spark, path, C.POST.mart)


@query
def mart_audited(spark, sf_dir):
    """As above, each version checked as it is written; one that fails is never seen."""
    table = published.PublishedTable(spark, shared_dir(spark, "audited"), C.POST.mart)
    rows = views.archived_late(spark, sf_dir)

    def refresh(arrived: DataFrame, lang: Column) -> None:
        def recompute(start):
            return marts.posts_by_lang(incremental.latest_in_window(arrived, start)).withColumn("lang", lang)

        audited.refresh_audited(table, C.POST, recompute, C.REWINDOW_DAYS)

    refresh(rows.where(F.col("ingest_ts") <= times.instant(HALFWAY, "timestamp_ntz")), F.col("lang"))
    before = table.days()
    try:
        refresh(rows, F.nullif("lang", F.lit(C.UNDETERMINED_LANG)))
    except checks.CheckFailed:
        if table.days() != before:
            raise AssertionError("a failed check changed the table") from None
    else:
        raise AssertionError("nulls passed the checks")
    refresh(rows, F.col("lang"))
    return table.read()


# --- incremental loads -------------------------------------------------------------------

_BRONZE_NTZ = T.StructType(
    [
        T.StructField(
            f.name, T.TimestampNTZType() if f.dataType == T.TimestampType() else f.dataType, True
        )
        for f in C.POST.bronze.fields
    ]
)


def _load_in_two(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Load the first half, then everything above the mark, then once more with nothing new."""
    root = shared_dir(spark, "load")
    state = CursorTable(spark, f"{root}/state")
    rows = tables.with_day_columns(
        views.archived(spark, sf_dir)
        .withColumn("reply_parent", F.lit(None).cast("string"))
        .withColumn("reply_root", F.lit(None).cast("string"))
        .select(*columns)
    )
    first = rows.where(F.col("ingest_ts") <= times.instant(HALFWAY, "timestamp_ntz"))
    for source in (first, rows, rows):
        vertical.load_newer(source, f"{root}/table", state, "load", NOW)
    schema = T.StructType([f for f in _BRONZE_NTZ.fields if f.name in columns])
    return tables.read_archived(spark, f"{root}/table", schema)


@query
def landing_incremental(spark, sf_dir):
    return _load_in_two(spark, sf_dir, _BRONZE_NTZ.names).select(*_DEDUP_COLUMNS, "text", _tags())


@query
def landing_units(spark, sf_dir):
    """Landing by finished units beside an archive whose clock is set back between its batches."""
    root = shared_dir(spark, "units")
    finished, loaded = ledger.Ledger(spark, f"{root}/ledger/bronze"), ledger.Ledger(spark, f"{root}/ledger/landing")

    def land() -> int:
        return vertical.load_units(spark, f"{root}/bronze", C.POST.bronze, finished, f"{root}/landing", loaded)

    for part, clock in enumerate((NOW, HALFWAY)):
        records = views.topic_records(spark, sf_dir, "post").where(F.col("kafka_offset") % 2 == part)
        records.write.mode("append").parquet(f"{root}/topic")
        archive.archive_stream(
            topics.stream_topic(spark, f"{root}/topic", max_files=_half(spark, f"{root}/topic")),
            C.POST,
            f"{root}/bronze",
            f"{root}/dlq",
            f"{root}/checkpoint",
            ingest_ts=times.instant(clock, "timestamp"),
            ledger=finished,
        ).awaitTermination()
        land()
    if land():
        raise AssertionError("a load with nothing new took rows")
    landing = tables.read_archived(spark, f"{root}/landing", C.POST.bronze)
    return landing.select(
        "did", "rkey", "cid", _plain("created_at"), "text", _tags(), "kafka_partition", "kafka_offset",
        "created_day",
    )


@query
def staging_incremental(spark, sf_dir):
    staged = _load_in_two(spark, sf_dir, C.POST.staging.names)
    return dedup.latest_per_key(staged, ("ingest_ts", "cid")).select(
        "did", "rkey", "cid", "created_at", "text", _tags(), "ingest_ts"
    )


@query
def newer_than_mark(spark, sf_dir):
    """Rows above the largest arrival time of the first half; equal times are not read again."""
    rows = views.archived(spark, sf_dir)
    landed = rows.where(F.col("ingest_ts") <= times.instant(HALFWAY, "timestamp_ntz"))
    mark = incremental.high_water(landed)
    return incremental.newer_than(rows, mark).select("did", "rkey", "cid", "ingest_ts")


# --- dashboard ---------------------------------------------------------------------------


@query
def total_deduped(spark, sf_dir):
    return panels.total_of_versions(views.archived(spark, sf_dir))


@query
def events_per_minute(spark, sf_dir):
    return panels.per_minute(_latest(spark, sf_dir)).select(_plain("time"), "posts")


@query
def top_tags(spark, sf_dir):
    return panels.top_tags(_latest(spark, sf_dir))


@query
def top_document_langs(spark, sf_dir):
    documents = views.table(spark, sf_dir, "documents")
    return panels.top_tags(documents.select(F.array("lang").alias("langs")))


@query
def latest_n(spark, sf_dir):
    rows = panels.latest_n(views.archived(spark, sf_dir), arrival="ingest_ts", ties=("cid",))
    return rows.select("did", "rkey", "created_at", _tags())


# --- routing and validation --------------------------------------------------------------


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.route_events(views.raw_lines(spark, sf_dir))


@query
def route_events(spark, sf_dir):
    return _routed(spark, sf_dir).select(
        "event_id", "route", "reason", "event_type", "intended_topic", "cursor"
    )


@query
def read_from_cursor(spark, sf_dir):
    """Subscription: wanted collections, events after the cursor."""
    lines = raw.select_events(views.raw_lines(spark, sf_dir), START_MICROS)
    return lines.select("event_id")


@query
def project_posts(spark, sf_dir):
    rows = routing.valid_rows(_routed(spark, sf_dir), C.POST)
    return rows.select(
        "did", "rkey", "cid", _plain("created_at"), "text", _tags(), "reply_parent", "reply_root",
        "cursor",
    )


@query
def project_likes(spark, sf_dir):
    rows = routing.valid_rows(_routed(spark, sf_dir), C.LIKE)
    return rows.select("did", "rkey", "cid", _plain("created_at"), "subject_uri", "subject_cid")


@query
def project_follows(spark, sf_dir):
    rows = routing.valid_rows(_routed(spark, sf_dir), C.FOLLOW)
    return rows.select("did", "rkey", "cid", _plain("created_at"), "subject_did")


@query
def project_documents(spark, sf_dir):
    """Whole document texts through the router."""
    rows = routing.valid_rows(routing.route_events(views.document_lines(spark, sf_dir)), C.POST)
    return rows.select(
        F.col("cursor").alias("doc_id"),
        "did",
        F.md5("text").alias("text_md5"),
        F.length("text").cast("bigint").alias("n_chars"),
        (F.md5("text") == F.col("cid")).alias("intact"),
        _tags(),
    )


def _dead(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.dead_letters(_routed(spark, sf_dir), times.instant(NOW))


@query
def dlq_rows(spark, sf_dir):
    rows = _dead(spark, sf_dir)
    return rows.select("error", "intended_topic", "raw_payload", _plain("received_at"))


@query
def dlq_rate(spark, sf_dir):
    return progress.dead_letter_rate(_dead(spark, sf_dir))


def _validated(spark: SparkSession, sf_dir: str, event: C.EventType) -> DataFrame:
    return validation.validate_flat(views.flat_records(spark, sf_dir, event.name), event)


@query
def validate_flat_posts(spark, sf_dir):
    rows = _validated(spark, sf_dir, C.POST)
    good = F.col("error").isNull()
    return rows.select(
        "kafka_offset",
        "error",
        F.when(good, F.col("did")).alias("did"),
        F.when(good, F.concat_ws("|", "langs")).alias("langs"),
        F.when(good, F.col("created_at").cast("timestamp_ntz")).alias("created_at"),
    )


@query
def validate_flat_likes(spark, sf_dir):
    rows = _validated(spark, sf_dir, C.LIKE).withColumn("ingest_ts", times.instant(NOW))
    return validation.accepted(rows, C.LIKE).select(
        "did", "rkey", "cid", _plain("created_at"), "subject_uri", "subject_cid",
        "kafka_partition", "kafka_offset", _plain("ingest_ts"),
    )


@query
def validate_flat_follows(spark, sf_dir):
    rows = _validated(spark, sf_dir, C.FOLLOW)
    dead = validation.rejected(rows, C.FOLLOW, times.instant(NOW))
    return progress.dead_letter_rate(dead)


@query
def canonical_json(spark, sf_dir):
    text = F.concat(F.lit('{ "z" : 1, "a": {"k": '), F.col("event_id"), F.lit(', "b": ["x", null]} }'))
    rows = views.table(spark, sf_dir, "events").select("event_id", text.alias("line"))
    return rows.select("event_id", J.canonical_json(J.parse("line")).alias("payload"))


# --- scalar functions --------------------------------------------------------------------


@query
def micros_to_ts(spark, sf_dir):
    rows = views.table(spark, sf_dir, "events").select(
        "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros")
    )
    return rows.select(
        "event_id", times.micros_to_timestamp("micros").cast("timestamp_ntz").alias("created_at")
    )


@query
def text_to_ts(spark, sf_dir):
    """Creation times in eight spellings, one of them invalid."""
    ts = F.col("ts")
    seconds = F.unix_seconds(ts.cast("timestamp"))
    slot = F.col("event_id") % 8
    text = (
        F.when(slot == 0, views.iso(ts))
        .when(slot == 1, F.date_format(ts + F.expr("interval 330 minutes"), "yyyy-MM-dd HH:mm:ss+0530"))
        .when(slot == 2, F.date_format(ts, "yyyy-MM-dd"))
        .when(slot == 3, seconds.cast("string"))
        .when(slot == 4, F.unix_millis(ts.cast("timestamp")).cast("string"))
        .when(slot == 5, F.date_format(ts, "yyyy-MM-dd HH:mm:ss,SSS"))
        .when(slot == 6, F.date_format(ts - F.expr("interval 20 hours"), "yyyy-MM-dd'T'HH:mm'-20:00'"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'24:mm:ss"))
    )
    rows = views.table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return rows.select(
        "event_id", times.text_to_timestamp(F.col("text")).cast("timestamp_ntz").alias("created_at")
    )


@query
def partition_keys(spark, sf_dir):
    return views.table(spark, sf_dir, "events").select(
        "event_id",
        times.month_number("ts").alias("month_key"),
        times.day_number("ts").alias("day_key"),
        times.day_of("ts").alias("day"),
        _minute("ts"),
    )


def _minute(name: str) -> Column:
    return times.minute_of(name).cast("timestamp_ntz").alias("minute")


# --- progress ----------------------------------------------------------------------------


@query
def offset_high_water(spark, sf_dir):
    return progress.offset_high_water(views.archived(spark, sf_dir))


@query
def safe_cursor(spark, sf_dir):
    return progress.safe_cursor(views.delivery_log(spark, sf_dir))


@query
def cursor_upsert(spark, sf_dir):
    saves = views.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("stream_name"),
        F.col("event_id").alias("cursor"),
        F.col("ts").alias("updated_at"),
    )
    return progress.latest_cursors(saves)


@query
def ingest_counters(spark, sf_dir):
    return progress.ingest_counters(_routed(spark, sf_dir))


@query
def staleness(spark, sf_dir):
    return progress.staleness(views.archived(spark, sf_dir), NOW)


@query
def key_affine(spark, sf_dir):
    """Authors whose records do not share one partition after the layout: none."""
    laid_out = progress.key_affine(views.archived(spark, sf_dir).select("did"))
    spread = laid_out.withColumn("part", F.spark_partition_id()).groupBy("did").agg(
        F.count_distinct("part").alias("parts")
    )
    return spread.agg(
        F.count(F.lit(1)).alias("authors"), F.count_if(F.col("parts") > 1).alias("violations")
    )


# --- checks ------------------------------------------------------------------------------


@query
def check_freshness(spark, sf_dir):
    return checks.freshness(views.archived(spark, sf_dir), NOW)


@query
def check_volume(spark, sf_dir):
    return checks.volume(marts.posts_by_lang(_latest(spark, sf_dir)))


@query
def check_null_rate(spark, sf_dir):
    """A third of the content ids blanked."""
    blank = F.when(F.col("kafka_offset") % 3 == 0, F.lit("")).otherwise(F.col("cid"))
    rows = views.archived(spark, sf_dir).withColumn("cid", blank)
    version = ("ingest_ts", "kafka_partition", "kafka_offset")
    return checks.null_rate_of_versions(rows, version)


@query
def check_not_null(spark, sf_dir):
    rows = views.archived(spark, sf_dir).withColumn(
        "cid", F.when(F.col("kafka_offset") % 5 != 0, F.col("cid"))
    )
    return checks.not_null(rows, ["did", "rkey", "cid", "created_at"])


@query
def check_unique(spark, sf_dir):
    rows = views.archived(spark, sf_dir)
    deduped = checks.unique(_latest(spark, sf_dir), C.KEY, "staging")
    return deduped.unionByName(checks.unique(rows, C.KEY, "landing"))


@query
def check_mart_unique(spark, sf_dir):
    mart = marts.posts_by_lang(_latest(spark, sf_dir))
    return checks.unique(mart, ("day", "lang"), "mart")


@query
def schema_contract(spark, sf_dir):
    """Archived rows against the bronze contract, null rows counted over the whole table."""
    rows = views.archived(spark, sf_dir).select(
        "did",
        "rkey",
        "cid",
        F.col("created_at").cast("timestamp").alias("created_at"),
        "text",
        "langs",
        F.lit(None).cast("string").alias("reply_parent"),
        F.when(F.col("kafka_offset") % 2 == 0, F.col("rkey")).alias("reply_root"),
        "kafka_partition",
        "kafka_offset",
        F.col("ingest_ts").cast("timestamp").alias("ingest_ts"),
    )
    return C.contract_report(rows, C.POST.bronze)


# --- streams -----------------------------------------------------------------------------


def _topic(spark: SparkSession, sf_dir: str, root: str, event: C.EventType, flat=None) -> str:
    """The event type's records written as a topic folder."""
    path = f"{root}/topic/{event.name}"
    records = views.topic_records(spark, sf_dir, event.name) if flat is None else flat
    return _in_two(records, F.col("kafka_offset") % 2 == 0, path)


def _in_two(rows: DataFrame, first: Column, path: str) -> str:
    """Written as two appends, so that a stream over the folder has more than one batch to take."""
    rows.where(first).write.parquet(path)
    rows.where(~first).write.mode("append").parquet(path)
    return path


def _half(spark: SparkSession, path: str) -> int:
    """Files in about half of a folder, for a stream of two batches at any size."""
    return max(1, len(spark.read.parquet(path).inputFiles()) // 2)


@query
def stream_archive(spark, sf_dir):
    """Topic to bronze on a stream, then a second run that finds nothing new."""
    root = shared_dir(spark, "archive")
    path = _topic(spark, sf_dir, root, C.POST)
    for _ in range(2):
        archive.archive_stream(
            topics.stream_topic(spark, path, max_files=_half(spark, path)),
            C.POST,
            f"{root}/bronze",
            f"{root}/dlq",
            f"{root}/checkpoint",
        ).awaitTermination()
    bronze = tables.read_archived(spark, f"{root}/bronze", C.POST.bronze)
    return bronze.select(
        "did", "rkey", "cid", _plain("created_at"), "text", _tags(), "kafka_partition", "kafka_offset",
        "created_day",
    )


@query
def stream_flush(spark, sf_dir):
    """A topic archived in batches of a seventh of its rows, in runs that end at half of them."""
    root = shared_dir(spark, "flush")
    path = _topic(spark, sf_dir, root, C.POST)
    total = topics.read_topic(spark, path).count()
    for _ in range(3):
        rows = bounded.stream_bounded(
            spark, path, f"{root}/log", batch_rows=max(1, total // 7), run_rows=max(1, total // 2), wait_seconds=0.5
        )
        job = archive.archive_stream(
            rows, C.POST, f"{root}/bronze", f"{root}/dlq", f"{root}/checkpoint", drain=False, every_seconds=0
        )
        bounded.drain_bounded(job, idle_seconds=3)
    bronze = spark.read.parquet(f"{root}/bronze")
    counted = bronze.groupBy(F.substring_index("batch", "-", -1).cast("int").alias("batch")).agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("kafka_offset").alias("offsets")
    )
    return counted.withColumn("all_offsets", F.lit(bronze.select("kafka_offset").distinct().count()).cast("long"))


@query
def stream_dlq_split(spark, sf_dir):
    """Good and bad records of a stream counted from what was written to either table."""
    root = shared_dir(spark, "split")
    flat = views.flat_records(spark, sf_dir, "post")
    path = _topic(spark, sf_dir, root, C.POST, flat)
    archive.archive_stream(
        topics.stream_topic(spark, path, max_files=_half(spark, path)),
        C.POST,
        f"{root}/bronze",
        f"{root}/dlq",
        f"{root}/checkpoint",
    ).awaitTermination()
    bronze = tables.read_archived(spark, f"{root}/bronze", C.POST.bronze)
    dead = tables.read_table(spark, f"{root}/dlq", C.DLQ)
    sides = bronze.select(
        F.lit("bronze").alias("side"), F.lit(None).cast("string").alias("error")
    ).unionByName(dead.select(F.lit("dlq").alias("side"), "error"))
    return sides.groupBy("side", "error").agg(F.count(F.lit(1)).alias("records"))


@query
def rerun_noop(spark, sf_dir):
    """Run summaries of two archive runs over the same topic."""
    root = shared_dir(spark, "rerun")
    path = _topic(spark, sf_dir, root, C.LIKE)
    rows = []
    for run in (1, 2):
        summary: dict[str, int] = {}
        archive.archive_stream(
            topics.stream_topic(spark, path),
            C.LIKE,
            f"{root}/bronze",
            f"{root}/dlq",
            f"{root}/checkpoint",
            summary=summary,
        ).awaitTermination()
        total = tables.read_archived(spark, f"{root}/bronze", C.LIKE.bronze).count()
        rows.append((run, summary["archived_this_run"], summary["dlq_this_run"], total))
    return spark.createDataFrame(
        rows, "run int, archived_this_run long, dlq_this_run long, bronze_total_rows long"
    )


def _ingested(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """Raw lines routed on a stream; the topics' folders."""
    lines = views.raw_lines(spark, sf_dir)
    for part in (0, 1):
        lines.where(F.col("event_id") % 2 == part).select("value").write.mode("append").text(f"{root}/raw")
    paths = {name: f"{root}/topics/{name}" for name in C.EVENT_TYPES}
    files = len(spark.read.text(f"{root}/raw").inputFiles())
    ingest.ingest_stream(
        raw.stream_lines(spark, f"{root}/raw", max_files=max(1, files // 2)),
        paths,
        f"{root}/dlq",
        f"{root}/counters",
        f"{root}/checkpoint",
    ).awaitTermination()
    return paths


@query
def stream_ingest(spark, sf_dir):
    """Raw lines routed on a stream; counters as the stream stored them."""
    root = shared_dir(spark, "ingest")
    _ingested(spark, sf_dir, root)
    counters = spark.read.parquet(f"{root}/counters")
    return counters.groupBy("route", "label").agg(F.sum("events").alias("events"))


@query
def chain_bronze(spark, sf_dir):
    """Raw lines through the router's topic to bronze, every stored value with its microseconds."""
    root = shared_dir(spark, "chain")
    path = _ingested(spark, sf_dir, root)["post"]
    archive.archive_stream(
        topics.stream_topic(spark, path), C.POST, f"{root}/bronze", f"{root}/dead", f"{root}/archived"
    ).awaitTermination()
    bronze = tables.read_archived(spark, f"{root}/bronze", C.POST.bronze)
    return bronze.select(
        "did", "rkey", "cid", _plain("created_at"), "text", _tags(), "reply_parent", "reply_root",
        F.col("kafka_offset").alias("cursor"),
    )


def _chain(spark: SparkSession, sf_dir: str, event: C.EventType) -> DataFrame:
    root = shared_dir(spark, "chain")
    path = _ingested(spark, sf_dir, root)[event.name]
    paths = vertical.Paths(f"{root}/tables")
    # The event's own cursor is its arrival time, so that the winner among versions is known.
    arrived = F.timestamp_micros("kafka_offset")
    topic = topics.stream_topic(spark, path)
    vertical.run_vertical(spark, event, topic, paths, NOW, ingest_ts=arrived)
    return tables.read_mart(spark, paths.table("mart", event), event.mart)


@query
def chain_posts(spark, sf_dir):
    """Raw lines to the daily mart: ingest, archive, landing, staging, gates, mart."""
    return _chain(spark, sf_dir, C.POST)


@query
def chain_likes(spark, sf_dir):
    return _chain(spark, sf_dir, C.LIKE)


@query
def chain_follows(spark, sf_dir):
    return _chain(spark, sf_dir, C.FOLLOW)


@query
def realtime_mart(spark, sf_dir):
    """A payload topic straight to the versioned table, read through its deduplicated view."""
    root = shared_dir(spark, "realtime")
    path = f"{root}/topic"
    views.topic_records(spark, sf_dir, "post").write.parquet(path)
    posts = realtime.typed_posts(topics.stream_topic(spark, path))
    realtime.realtime_stream(posts, f"{root}/mart", f"{root}/checkpoint").awaitTermination()
    return realtime.realtime_latest(spark, f"{root}/mart").select(
        "did", "rkey", "cid", _plain("created_at"), "text", _tags()
    )


@query
def stream_minutes(spark, sf_dir):
    """One-minute windows counted on a stream of several batches."""
    root = shared_dir(spark, "minutes")
    events = views.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("created_at"), "event_id")
    path = _in_two(events, F.col("event_id") % 2 == 0, f"{root}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", _half(spark, path)).parquet(path)
    realtime.minute_stream(stream, f"{root}/minutes", f"{root}/checkpoint").awaitTermination()
    return realtime.minute_counts(spark, f"{root}/minutes").select(_plain("time"), "posts")


@query
def stream_dedup(spark, sf_dir):
    """Every event delivered twice, some dated far ahead or far back; replays dropped as they come."""
    root = shared_dir(spark, "dedup")
    number = F.col("kafka_offset")
    far = F.when(number % 97 == 0, F.expr("interval 9 years")).when(number % 89 == 0, F.expr("interval -9 years"))
    rows = views.archived(spark, sf_dir).select(
        "did",
        F.col("cid").alias("rkey"),
        (F.col("created_at") + F.coalesce(far, F.expr("interval 0 years"))).cast("timestamp").alias("created_at"),
        F.col("text"),
        number.alias("number"),
    )
    path = f"{root}/topic"
    for part in (0, 1, 2, 3):  # each half of the events, then each again
        rows.where(F.col("number") % 2 == part % 2).write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", _half(spark, path)).parquet(path)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        tables.write_unit(batch, f"{root}/out", "batch", batches.batch_key(batch, batch_id))

    batches.start(realtime.first_seen(stream), each_batch, f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").select("did", "rkey", _plain("created_at"), "text")


def _replayed(spark: SparkSession, sf_dir: str, root: str) -> tuple[str, str]:
    """All versions of all records in the order in which nobody wants them, some twice: what a
    change stream of several batches made of them, its log and its minutes."""
    rows = views.archived(spark, sf_dir).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("created_at", "ingest_ts")}
    )
    rows = rows.select(*_DEDUP_COLUMNS, "langs")
    path, number = f"{root}/topic", F.col("kafka_offset")
    for part in (number % 2 == 1, number % 2 == 0, number % 3 == 0):
        rows.where(part).write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", _half(spark, path)).parquet(path)
    log, minutes = f"{root}/log", f"{root}/minutes"
    changes.change_stream(stream, log, minutes, f"{root}/checkpoint").awaitTermination()
    return log, minutes


@query
def stream_latest(spark, sf_dir):
    """The newest version of every record by the sums of a stream's changes."""
    log, _ = _replayed(spark, sf_dir, shared_dir(spark, "changes"))
    rows = changes.current_rows(spark.read.parquet(log), [*_DEDUP_COLUMNS, "langs"])
    return rows.select(
        "did", "rkey", "cid", _plain("created_at"), "kafka_partition", "kafka_offset", _plain("ingest_ts"), _tags()
    )


@query
def stream_minutes_latest(spark, sf_dir):
    """Records per minute, each counted once at the minute of its newest version, by a stream's changes."""
    _, minutes = _replayed(spark, sf_dir, shared_dir(spark, "changes"))
    return changes.minutes_of_records(spark, minutes).select(_plain("time"), "posts")


@query
def stream_safe_cursor(spark, sf_dir):
    """Safe cursors kept by a stream of registrations and acknowledgements in several batches."""
    root = shared_dir(spark, "safe")
    log, path = views.delivery_log(spark, sf_dir), f"{root}/reports"
    half = log.agg(F.max("cursor")).first()[0] // 2
    early = F.col("cursor") < half
    made = log.where("registered").withColumn("kind", F.lit(safe_cursors.REGISTERED))
    done = log.where("acked").withColumn("kind", F.lit(safe_cursors.ACKED))
    some = early & (F.col("cursor") % 3 == 0)
    for part in (made.where(early), done.where(some), made.where(~early), done.where(~some)):
        part.select("stream", "cursor", "kind").write.mode("append").parquet(path)
    stream = spark.readStream.schema("stream string, cursor long, kind string")
    stream = stream.option("maxFilesPerTrigger", max(1, _half(spark, path) // 2)).parquet(path)
    safe_cursors.safe_cursor_stream(stream, f"{root}/safe", f"{root}/checkpoint").awaitTermination()
    return safe_cursors.read_safe_cursors(spark, f"{root}/safe")


# --- whole verticals ---------------------------------------------------------------------


def _vertical(spark: SparkSession, sf_dir: str, event: C.EventType) -> DataFrame:
    root = shared_dir(spark, "vertical")
    path = _topic(spark, sf_dir, root, event)
    paths = vertical.Paths(f"{root}/tables")
    vertical.run_vertical(spark, event, topics.stream_topic(spark, path), paths, NOW)
    return tables.read_mart(spark, paths.table("mart", event), event.mart)


@query
def vertical_posts(spark, sf_dir):
    return _vertical(spark, sf_dir, C.POST)


@query
def vertical_likes(spark, sf_dir):
    return _vertical(spark, sf_dir, C.LIKE)


@query
def vertical_follows(spark, sf_dir):
    return _vertical(spark, sf_dir, C.FOLLOW)


@query
def vertical_incremental(spark, sf_dir):
    """The vertical over the first half, over the rest with its late rows, and over nothing new."""
    root = shared_dir(spark, "vertical")
    paths = vertical.Paths(f"{root}/tables")
    rows = views.archived_late(spark, sf_dir)
    early = F.col("ingest_ts") <= times.instant(HALFWAY, "timestamp_ntz")
    for part in (early, ~early, None):
        if part is not None:
            records = views.as_records(rows.where(part), ["did", "rkey", "cid", "created_at", "text", "langs"])
            records.write.mode("append").parquet(f"{root}/topic")
        vertical.run_vertical(spark, C.POST, topics.stream_topic(spark, f"{root}/topic"), paths, NOW)
    return tables.read_mart(spark, paths.table("mart", C.POST), C.POST.mart)


@query
def vertical_checks(spark, sf_dir):
    """Verdicts of the gates of a whole run."""
    root = shared_dir(spark, "vertical")
    path = _topic(spark, sf_dir, root, C.POST)
    paths = vertical.Paths(f"{root}/tables")
    result = vertical.run_vertical(spark, C.POST, topics.stream_topic(spark, path), paths, NOW)
    rows = [(r["check_name"], r["target"], r["passed"], r["blocking"]) for r in result["checks"]]
    return spark.createDataFrame(
        rows, "check_name string, target string, passed boolean, blocking boolean"
    )
