"""Timestamp and date expressions."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The spellings of a creation time that count as valid, and the size
# above which a bare number means milliseconds instead of seconds.
ISO_PATTERN = (
    r"^(\d{4}-\d{2}-\d{2})"
    r"(?:[Tt _](\d{2}:\d{2})(:\d{2}(?:[.,]\d{1,9})?)?"
    r"([Zz]|[+\-−](?:[01]\d|2[0-3]):?[0-5]\d)?)?$"
)
USUAL_PATTERN = r"^[1-9]\d{3}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,9})?Z$"
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)$"
SECONDS_LIMIT = 20_000_000_000
MIN_EPOCH_SECONDS = -62_135_596_800  # 0001-01-01
MAX_EPOCH_SECONDS = 253_402_300_800  # 10000-01-01, first instant out of range
# ---------------------------------------------------------------------------


_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def to_micros(moment: datetime) -> int:
    """Microseconds since the epoch; a clock without a zone is UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=UTC)
    return (aware - _EPOCH) // timedelta(microseconds=1)


def from_micros(micros: int | None) -> datetime | None:
    return None if micros is None else _EPOCH + timedelta(microseconds=micros)


def instant(moment: datetime, like: str = "timestamp") -> Column:
    """A moment as a constant of the given timestamp type, whatever the machine's own zone."""
    return F.timestamp_micros(F.lit(to_micros(moment))).cast(like)


def micros_to_timestamp(micros: Column | str) -> Column:
    return F.timestamp_micros(micros)


def number_text_to_timestamp(text: Column) -> Column:
    """Epoch number as text: seconds, or milliseconds when large.  Null when out of range."""
    number = text.try_cast("decimal(38,9)")
    seconds = F.when(F.abs(number) > SECONDS_LIMIT, number / 1000).otherwise(number)
    inside = (seconds >= MIN_EPOCH_SECONDS) & (seconds < MAX_EPOCH_SECONDS)
    return F.when(inside, F.timestamp_micros(F.round(seconds * 1_000_000).cast("bigint")))


def iso_text_to_timestamp(text: Column) -> Column:
    """ISO date or date-time with optional zone offset; no offset means UTC.

    The local part is read as UTC and the offset taken off by arithmetic, because the
    built-in reader stops at 18 hours.  Null where the text is not a valid date-time.
    """
    date = F.regexp_extract(text, ISO_PATTERN, 1)
    minutes = F.regexp_extract(text, ISO_PATTERN, 2)
    seconds = F.regexp_extract(text, ISO_PATTERN, 3)
    zone = F.regexp_replace(F.regexp_extract(text, ISO_PATTERN, 4), ":", "")
    clock = F.concat(
        F.when(minutes == "", F.lit("00:00")).otherwise(minutes),
        F.when(seconds == "", F.lit(":00")).otherwise(F.translate(seconds, ",", ".")),
    )
    local = F.concat(date, F.lit("T"), clock, F.lit("Z")).try_cast("timestamp")
    offset = (
        F.substring(zone, 2, 2).try_cast("bigint") * 3600
        + F.substring(zone, 4, 2).try_cast("bigint") * 60
    )
    ahead = F.when(F.substring(zone, 1, 1) == "+", offset).otherwise(-offset)
    shift = F.when(zone.isin("", "Z", "z"), F.lit(0)).otherwise(ahead)
    valid = text.rlike(ISO_PATTERN) & ~text.startswith("0000")
    return F.when(valid, F.timestamp_micros(F.unix_micros(local) - shift * 1_000_000))


def text_to_timestamp(text: Column) -> Column:
    """Creation time written as text: an epoch number or an ISO date-time.

    The usual spelling is tried first and read directly.
    """
    return (
        F.when(text.rlike(USUAL_PATTERN), text.try_cast("timestamp"))
        .when(text.rlike(NUMBER_PATTERN), number_text_to_timestamp(text))
        .otherwise(iso_text_to_timestamp(text))
    )


def value_to_timestamp(kind: Column, text: Column) -> Column:
    """Creation time from a JSON value, given its kind and its text.

    Strings and numbers are read, a timestamp passes through, anything else is null.
    """
    numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return (
        F.when(kind == "STRING", text_to_timestamp(text))
        .when(numeric, number_text_to_timestamp(text))
        .when(kind.startswith("TIMESTAMP"), text.try_cast("timestamp"))
    )


def day_of(ts: Column | str) -> Column:
    return F.to_date(ts)


def minute_of(ts: Column | str) -> Column:
    return F.date_trunc("minute", ts)


def month_number(ts: Column | str) -> Column:
    """Year and month as one number, 202401."""
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def day_number(ts: Column | str) -> Column:
    """Year, month and day as one number, 20240131."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def arrival_millis() -> Column:
    """Arrival stamp to the millisecond; one value per batch or micro-batch."""
    return F.date_trunc("millisecond", F.current_timestamp())
