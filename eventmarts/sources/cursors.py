"""Small keyed state: one position per stream or load, saved after the data it covers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmarts.contracts import CURSORS
from eventmarts.operators.progress import latest_cursors
from eventmarts.sources.tables import exists


class CursorTable:
    """Append-only log of saves; the newest per stream is the current position."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark = spark
        self._path = path

    def entries(self) -> DataFrame:
        if not exists(self._spark, self._path):
            return self._spark.createDataFrame([], CURSORS)
        return self._spark.read.schema(CURSORS).json(self._path)

    def current(self) -> DataFrame:
        return latest_cursors(self.entries())

    def load(self, stream_name: str) -> int | None:
        """Saved position, or None for a fresh stream."""
        ours = self.entries().where(F.col("stream_name") == stream_name)
        newest = ours.agg(F.max(F.struct("updated_at", "cursor")).alias("newest")).first()["newest"]
        return None if newest is None else newest["cursor"]

    def highest(self, stream_name: str) -> int | None:
        """Highest position ever saved: for marks that only grow, whatever the writers' clocks."""
        return self.entries().where(F.col("stream_name") == stream_name).agg(F.max("cursor")).first()[0]

    def save(self, stream_name: str, cursor: int, updated_at: datetime) -> None:
        """Record a position.  Call only once the data up to it is written."""
        row = self._spark.createDataFrame([(stream_name, cursor, updated_at)], CURSORS)
        row.coalesce(1).write.mode("append").json(self._path)
