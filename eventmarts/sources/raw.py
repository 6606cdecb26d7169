"""Raw firehose lines, one JSON event per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmarts.contracts import EVENT_TYPES
from eventmarts.functions import json_fields as J

_SHAPE = "struct<time_us:variant,commit:struct<collection:variant>>"
WANTED = tuple(e.collection for e in EVENT_TYPES.values())


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines as a batch, in one column ``value``."""
    return spark.read.text(path)


def stream_lines(
    spark: SparkSession,
    path: str,
    *,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Lines of files as they arrive; the stream's checkpoint is the resume point.

    ``max_files`` or ``max_bytes`` bounds one micro-batch.
    """
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.text(path)


def select_events(
    lines: DataFrame,
    cursor: int | None = None,
    collections: Sequence[str] = WANTED,
    line: str = "value",
) -> DataFrame:
    """Subscribe: events of the wanted collections from the cursor on.

    An event of another kind has no collection and always passes, as does one whose cursor
    cannot be read: the router decides about those.  Without a cursor, reading starts at the
    beginning.
    """
    parsed = lines.withColumn("_e", J.fields(J.parse(line), _SHAPE))
    seen = J.hold(
        parsed,
        _collection=J.text_if_string("_e.commit.collection"),
        _at=J.integer("_e.time_us"),
    )
    wanted = seen.where(F.coalesce(F.col("_collection").isin(*collections), F.lit(True)))
    if cursor is not None:
        wanted = wanted.where(F.coalesce(F.col("_at") > cursor, F.lit(True)))
    return wanted.select(*lines.columns)
