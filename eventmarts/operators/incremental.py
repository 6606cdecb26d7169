"""Watermarks, newer-than filters and the trailing recompute window."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmarts.contracts import REWINDOW_DAYS
from eventmarts.functions.times import from_micros, instant
from eventmarts.operators.dedup import latest_per_key


def high_water(target: DataFrame, column: str = "ingest_ts"):
    """Largest value already in the target, or None if it is empty.  One row is fetched.

    A timestamp comes back as a moment in UTC.
    """
    return _one(target, F.max(column), column)


def _one(rows: DataFrame, aggregate, column: str):
    if isinstance(rows.schema[column].dataType, (T.TimestampType, T.TimestampNTZType)):
        micros = F.unix_micros(aggregate.cast("timestamp"))
        return from_micros(rows.agg(micros.alias("mark")).first()["mark"])
    return rows.agg(aggregate.alias("mark")).first()["mark"]


def _constant(rows: DataFrame, column: str, value):
    """The value as a constant of the column's own type, so the comparison is pushed down."""
    dtype = rows.schema[column].dataType
    if isinstance(value, datetime):
        return instant(value, dtype.simpleString())
    return F.lit(value).cast(dtype)


def newer_than(rows: DataFrame, mark: datetime | int | None, column: str = "ingest_ts") -> DataFrame:
    """Rows strictly above the mark; all rows when there is no mark.

    The mark goes in as a literal so the comparison is pushed to the file statistics.  If the
    table is laid out by ingest day, the files of whole days below the mark are never opened.
    """
    if mark is None:
        return rows
    newer = rows.where(F.col(column) > _constant(rows, column, mark))
    if column == "ingest_ts" and "ingest_day" in rows.columns:
        newer = newer.where(F.col("ingest_day") >= F.lit(mark.date()))
    return newer


def rewindow_start(latest_day: date | None, days: int = REWINDOW_DAYS) -> date | None:
    """First day to recompute; None means everything."""
    return None if latest_day is None else latest_day - timedelta(days=days)


def in_window(rows: DataFrame, start: date | None, column: str = "created_at") -> DataFrame:
    """Rows of the recompute window, by a plain comparison that file statistics can use."""
    if start is None:
        return rows
    return rows.where(F.col(column) >= _constant(rows, column, start))


def latest_in_window(
    rows: DataFrame,
    start: date | None,
    version: Sequence[str] = ("ingest_ts", "kafka_partition", "kafka_offset", "cid"),
    created: str = "created_at",
    until: datetime | None = None,
) -> DataFrame:
    """``in_window(latest_per_key(rows), start)`` without deduplicating all of history.

    A row outside the window matters only if it replaces one inside, so only if its version
    is at least the lowest version inside the window.  Everything else cannot change the
    answer and is left out by a filter on two plain columns.  With ``until`` the window ends
    there; one old row dated far ahead then doesn't bring all of history back.
    """

    def inside(some: DataFrame) -> DataFrame:
        some = in_window(some, start, created)
        return some if until is None else some.where(F.col(created) <= _constant(rows, created, until))

    if start is None:
        return inside(latest_per_key(rows, version))
    lowest = _one(inside(rows), F.min(version[0]), version[0])
    if lowest is None:
        return inside(rows)
    since = F.col(created) >= _constant(rows, created, start)
    if until is not None:
        since = since & (F.col(created) <= _constant(rows, created, until))
    wanted = rows.where(since | (F.col(version[0]) >= _constant(rows, version[0], lowest)))
    return inside(latest_per_key(wanted, version))
