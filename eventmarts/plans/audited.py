"""Marts that are checked before anybody sees them, and archives compacted day by day."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmarts.contracts import VOLUME_MIN_FRACTION, EventType
from eventmarts.operators.checks import CheckFailed
from eventmarts.operators.dedup import latest_per_key
from eventmarts.operators.incremental import rewindow_start
from eventmarts.sources.ledger import Ledger
from eventmarts.sources.published import PublishedTable, Staged
from eventmarts.sources.tables import STORED_DAYS, read_units


def mart_marks(event: EventType) -> dict[str, Column]:
    """What is measured while a mart is written: nulls by column, and counts that make no sense."""
    marks = {f"null_{c}": F.count(F.when(F.col(c).isNull(), 1)) for c in event.mart.names}
    marks["more_authors_than_events"] = F.count(F.when(F.col(event.distinct_name) > F.col(event.count_name), 1))
    marks["not_positive"] = F.count(F.when(F.col(event.distinct_name) < 1, 1))
    return marks


def verdicts(staged: Staged, table: PublishedTable, target: str) -> list[dict]:
    """One verdict a mark, which must be zero, and one on the volume of the newest day.

    The volume is held against the mean of the earlier days that will be published with it; both
    are known without a scan, from the staged files' footers and the current record.
    """
    found = [
        {"check_name": name, "target": target, "passed": count == 0, "blocking": True, "value": count}
        for name, count in sorted(staged.marks.items())
    ]
    rows = {d: v.rows for d, v in table.days().items()} | staged.days
    newest = max(rows, default=None)
    earlier = [n for d, n in rows.items() if d != newest]
    enough = not earlier or rows[newest] >= VOLUME_MIN_FRACTION * sum(earlier) / len(earlier)
    return [*found, {"check_name": "volume", "target": target, "passed": enough, "blocking": False, "value": rows.get(newest, 0)}]


def refresh_audited(
    table: PublishedTable,
    event: EventType,
    recompute: Callable[[date | None], DataFrame],
    rewindow_days: int | None,
    target: str = "mart",
) -> list[dict]:
    """Recompute the trailing days of a mart, check them as they are written, then publish them.

    ``recompute`` gives the mart's rows from a day on, all of them for None.  A blocking verdict
    against the new days raises, and readers keep the table they have.
    """
    days = table.days()
    start = None if rewindow_days is None else rewindow_start(max(days, default=None), rewindow_days)
    staged = table.stage(recompute(start), (event.dimension,), **mart_marks(event))
    results = verdicts(staged, table, target)
    failed = [r for r in results if r["blocking"] and not r["passed"]]
    if failed:
        raise CheckFailed("; ".join(f"{r['check_name']} on {target}: {r['value']}" for r in failed))
    table.publish(staged, replaces=lambda day: start is None or day >= start)
    return results


def archive_table(spark: SparkSession, path: str, shape: T.StructType) -> PublishedTable:
    """A compacted archive: whole archived rows by day of arrival."""
    stored = [f for f in shape.fields if f.name not in STORED_DAYS]
    days = [T.StructField("created_day", T.DateType()), T.StructField("ingest_day", T.DateType())]
    return PublishedTable(spark, path, T.StructType([*stored, *days]), day="ingest_day")


def compact_days(
    spark: SparkSession,
    source: str,
    shape: T.StructType,
    finished: Ledger,
    compacted: Ledger,
    table: PublishedTable,
    closed_before: date,
    version: Sequence[str] = ("ingest_ts", "kafka_partition", "kafka_offset", "cid"),
    keys: Sequence[str] = ("did", "rkey"),
    most_days: int = 31,
) -> list[date]:
    """Rewrite the closed days that have new units: each key's newest version of the day; gives the days.

    A day is closed before ``closed_before``.  Its units are read, many small files, and written
    back as few, sorted by event time; days without new units stay as they are, and so do readers
    that started before.  The newest version of all days is still picked when the table is read.
    Dropping a version here never changes that: the day keeps a newer one of the same key.
    """
    pending = finished.pending(compacted, 1 << 20)
    changed = sorted({u.day for u in pending if u.day is not None and u.day < closed_before})
    everything = finished.units()
    for at in range(0, len(changed), most_days):
        days = changed[at : at + most_days]
        units = everything.where(F.col("day").isin(days)).select("unit", "day").collect()  # the units of a month
        rows = read_units(spark, source, shape, [(u["unit"], u["day"]) for u in units])
        newest = latest_per_key(rows, version, ("ingest_day", *keys))
        staged = table.stage(newest, ("created_at",))
        table.publish(staged, replaces=set(days).__contains__)
        compacted.add([u for u in pending if u.day in set(days)])
    compacted.add([u for u in pending if u.day is None])
    table.remove_old()
    return changed


def closed(now: datetime) -> date:
    """Days before today get no more arrivals."""
    return now.date()
