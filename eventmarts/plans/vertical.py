"""One event type from its topic to its checked daily mart."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmarts.contracts import REWINDOW_DAYS, EventType
from eventmarts.functions.times import from_micros
from eventmarts.operators import checks
from eventmarts.operators.dedup import latest_per_key
from eventmarts.operators.incremental import (
    high_water,
    in_window,
    latest_in_window,
    newer_than,
    rewindow_start,
)
from eventmarts.operators.marts import daily_mart
from eventmarts.session import configure
from eventmarts.sources import tables
from eventmarts.sources.cursors import CursorTable
from eventmarts.sources.ledger import Ledger
from eventmarts.sources.tables import (
    DAY_COLUMNS,
    STORED_DAYS,
    read_archived,
    read_mart,
    replace_days,
    write_unit,
)
from eventmarts.streaming.archive import archive_stream

VERSION = ("ingest_ts", "kafka_partition", "kafka_offset", "cid")
#: Units that one pass of a load names.
LOAD_UNITS = 1000


@dataclass(frozen=True)
class Paths:
    """Where the tables of one deployment live, one sub-folder per event type."""

    root: str

    def table(self, layer: str, event: EventType) -> str:
        return f"{self.root}/{layer}/{event.name}"

    @property
    def dlq(self) -> str:
        return f"{self.root}/dlq"

    @property
    def state(self) -> str:
        return f"{self.root}/state"

    def ledger(self, layer: str, event: EventType) -> str:
        return f"{self.root}/ledger/{layer}/{event.name}"


def _staged_shape(event: EventType) -> T.StructType:
    """Stored staging columns: the contract's, and the topic position that settles ties."""
    position = [f for f in event.bronze.fields if f.name in ("kafka_partition", "kafka_offset")]
    return T.StructType(event.staging.fields + position)


def read_bronze(
    spark: SparkSession, paths: Paths, event: EventType, missing_ok: bool = False
) -> DataFrame:
    return read_archived(spark, paths.table("bronze", event), event.bronze, missing_ok)


def read_landing(spark: SparkSession, paths: Paths, event: EventType) -> DataFrame:
    return read_archived(spark, paths.table("landing", event), event.bronze)


def read_staged_versions(spark: SparkSession, paths: Paths, event: EventType) -> DataFrame:
    return read_archived(spark, paths.table("staging", event), _staged_shape(event))


def read_staging(spark: SparkSession, paths: Paths, event: EventType) -> DataFrame:
    """Deduplicated staging, in its contract's columns."""
    return latest_per_key(read_staged_versions(spark, paths, event), VERSION).select(
        *event.staging.names
    )


def load_newer(
    source: DataFrame,
    path: str,
    state: CursorTable,
    name: str,
    now: datetime,
    block_rows: int | None = None,
) -> int:
    """Append the source rows above the saved mark, then save the new mark.

    The new mark is the highest arrival time among the rows that were written.  Their folders
    are named by the mark the load started from, so a load that died before saving is
    overwritten by its retry.  A mark is saved only after its rows are written.  Marks are
    arrival times, so the stream that writes the source must be stopped meanwhile: a batch
    stamped before the mark and written after the load would never be loaded.
    """
    saved = state.highest(name)
    fresh = newer_than(source, from_micros(saved))
    top = F.max(F.unix_micros(F.col("ingest_ts").cast("timestamp")))
    seen = write_unit(fresh, path, "load", str(saved or 0), DAY_COLUMNS, block_rows, top=top)
    if seen["top"] is not None:
        state.save(name, seen["top"], now)
    return seen["rows"]


def load_units(
    spark: SparkSession,
    source: str,
    shape: T.StructType,
    finished: Ledger,
    target: str,
    loaded: Ledger,
    columns: Sequence[str] | None = None,
    block_rows: int | None = None,
    most: int = LOAD_UNITS,
) -> int:
    """Copy the units that ``finished`` has and ``loaded`` has not, then record them; gives the rows.

    Each unit keeps its folder's name in the target, so a load that died is put right by the next,
    also if more units are finished by then.  No clock is asked: a unit counts once it is
    recorded, whatever its arrival time, so the writer of the source may run meanwhile, and any
    unit it finishes too late for this load is in the next.  At most ``most`` units are named at a
    time, and only their folders are listed.
    """
    rows = 0
    while units := finished.pending(loaded, most):
        named = [(u.unit, u.day) for u in units if u.day is not None]
        if named:
            fresh = tables.read_units(spark, source, shape, named)
            if columns is not None:
                fresh = fresh.select(*columns, *STORED_DAYS, "batch")
            rows += tables.copy_units(fresh, target, block_rows=block_rows)
        loaded.add(units)
    return rows


def refresh_mart(
    spark: SparkSession,
    paths: Paths,
    event: EventType,
    rewindow_days: int | None = REWINDOW_DAYS,
    max_event_time: datetime | None = None,
) -> None:
    """Recompute the trailing days of the mart, or all of it when it is empty.

    Late rows older than the window stay out, as the window is what is recomputed; pass
    ``rewindow_days=None`` to rebuild everything.  ``max_event_time`` leaves out rows dated
    after it, whose clock is the client's, and days after it do not move the window, so a day
    dated ahead that is in the mart already cannot freeze it.
    """
    target = paths.table("mart", event)
    start = mart_window(spark, paths, event, rewindow_days, max_event_time)
    versions = read_staged_versions(spark, paths, event)
    rows = latest_in_window(versions, start, VERSION, until=max_event_time)
    replace_days(daily_mart(rows, event), target, start, event.mart)


def mart_window(
    spark: SparkSession,
    paths: Paths,
    event: EventType,
    rewindow_days: int | None = REWINDOW_DAYS,
    max_event_time: datetime | None = None,
) -> date | None:
    """First day that a refresh recomputes, None for all."""
    if rewindow_days is None:
        return None
    mart = read_mart(spark, paths.table("mart", event), event.mart, missing_ok=True)
    if max_event_time is not None:
        mart = mart.where(F.col("day") <= F.lit(max_event_time.date()))
    return rewindow_start(high_water(mart, "day"), rewindow_days)


def land_and_stage(
    spark: SparkSession,
    event: EventType,
    paths: Paths,
    ledgers: dict[str, Ledger],
    block_rows: int | None = None,
) -> dict:
    """Load what bronze has finished into landing, and that into staging; totals come from the ledgers."""
    bronze, landing, staging = (paths.table(layer, event) for layer in ("bronze", "landing", "staging"))
    landed = load_units(
        spark, bronze, event.bronze, ledgers["bronze"], landing, ledgers["landing"], block_rows=block_rows
    )
    columns = _staged_shape(event).names
    staged = load_units(
        spark, landing, event.bronze, ledgers["landing"], staging, ledgers["staging"], columns
    )
    return {
        "bronze_total": ledgers["bronze"].totals()[0],
        "landed_this_run": landed,
        "landing_total": ledgers["landing"].totals()[0],
        "staged_this_run": staged,
    }


def run_vertical(
    spark: SparkSession,
    event: EventType,
    topic: DataFrame,
    paths: Paths,
    now: datetime,
    *,
    ingest_ts: Column | None = None,
    rewindow_days: int | None = REWINDOW_DAYS,
    landing_block_rows: int | None = None,
    max_event_time: datetime | None = None,
) -> dict:
    """Archive, land, stage, gate, refresh the mart, gate again.

    ``topic`` is a streaming read of the event's topic; what it holds now is drained.  A
    failed blocking check raises and leaves the steps after it undone.
    """
    configure(spark)
    ledgers = {layer: Ledger(spark, paths.ledger(layer, event)) for layer in ("bronze", "landing", "staging")}
    summary: dict = {}
    checkpoint = f"{paths.root}/checkpoints/archive-{event.name}"
    archive_stream(
        topic,
        event,
        paths.table("bronze", event),
        paths.dlq,
        checkpoint,
        ingest_ts=ingest_ts,
        summary=summary,
        ledger=ledgers["bronze"],
    ).awaitTermination()
    summary |= land_and_stage(spark, event, paths, ledgers, landing_block_rows)

    staged = read_staged_versions(spark, paths, event)
    required = ["did", "rkey", "cid", "created_at"]
    required += [] if event.name == "post" else [event.dimension]
    results = checks.gate(
        [
            checks.null_rate_of_versions(staged, VERSION, f"staging-{event.name}"),
            checks.not_null_result(staged, required, f"staging-{event.name}"),
            checks.freshness_of(spark, ledgers["bronze"].totals()[1], now, f"bronze-{event.name}"),
        ]
    )

    mart_path = paths.table("mart", event)
    start = mart_window(spark, paths, event, rewindow_days, max_event_time)
    refresh_mart(spark, paths, event, rewindow_days, max_event_time)
    mart = read_mart(spark, mart_path, event.mart)
    fresh = in_window(mart, start, "day")
    name = f"mart-{event.name}"
    results += checks.gate(
        [
            checks.not_null_result(fresh, event.mart.names, name),
            checks.unique(fresh, ["day", event.dimension], name),
            checks.volume(mart, name),
        ]
    )
    summary["checks"] = results
    return summary
