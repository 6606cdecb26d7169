"""Tables by day whose readers see a new version only once it has been checked and published.

Rows are written aside, as the next numbered version, and measured while they are written.  What is
current is one small record: which version holds each day, and how many rows it has.  Publishing
writes the next record in one step, so readers have the old days or the new ones, never some of
each, and a version that fails its checks is never seen.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmarts.sources.tables import _located


@dataclass(frozen=True)
class Day:
    version: int
    rows: int


@dataclass(frozen=True)
class Staged:
    """A version that is written but not yet published, with what was measured in it."""

    version: int
    days: dict[date, int]  # rows of each day
    marks: dict[str, object]


class PublishedTable:
    """Days below ``path``, by the day column ``day``.  One writer; any number of readers."""

    #: Records that keep their versions' files, for readers that started with them.
    KEEP = 2

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, day: str = "day") -> None:
        self._spark, self._path, self._day = spark, path, day
        self._schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        files, at = _located(self._spark, f"{self._path}/{folder}" if folder else self._path)
        names = [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []
        return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))

    def _record(self, number: int) -> dict[date, Day]:
        text = self._spark.read.text(f"{self._path}/records/at-{number:09d}", wholetext=True).first()[0]
        return {date.fromisoformat(d): Day(**v) for d, v in json.loads(text).items()}

    def days(self) -> dict[date, Day]:
        """The current version and rows of each day; empty before the first publication."""
        numbers = self._numbers("records", "at-")
        return self._record(numbers[-1]) if numbers else {}

    def read(self, where: Callable[[date], bool] = lambda day: True) -> DataFrame:
        """The published rows; days that ``where`` turns down are not even listed."""
        chosen = {d: v for d, v in self.days().items() if where(d)}
        if not chosen:
            return self._spark.createDataFrame([], self._schema)
        parts = []
        for version in sorted({v.version for v in chosen.values()}):
            base = f"{self._path}/version={version}"
            folders = [f"{base}/{self._day}={d.isoformat()}" for d, v in sorted(chosen.items()) if v.version == version]
            parts.append(self._spark.read.schema(self._schema).option("basePath", base).parquet(*folders))
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows.select(*self._schema.names)

    def stage(self, rows: DataFrame, order: Sequence[str] = (), **marks: Column) -> Staged:
        """Write the next version aside and take ``marks``, aggregates over its rows, meanwhile.

        A lost executor may have some rows counted twice, so a mark should be one that this cannot
        spoil: a largest value, a set, or a count that must be zero.  Rows of each day are counted
        from the written files' footers.
        """
        version = max([0, *self._numbers("", "version=")]) + 1
        path, seen = f"{self._path}/version={version}", Observation()
        named = [m.alias(n) for n, m in marks.items()] or [F.lit(0).alias("nothing")]
        out = rows.select(*self._schema.names).hint("rebalance", self._day).observe(seen, F.max(F.lit(1)).alias("any"), *named)
        if order:
            out = out.sortWithinPartitions(self._day, *order)
        out.write.partitionBy(self._day).parquet(path)
        counted = []
        if seen.get["any"] is not None:
            stored = self._spark.read.schema(self._schema).parquet(path)
            counted = stored.groupBy(self._day).agg(F.count(F.lit(1)).alias("n")).collect()  # a row a day
        return Staged(version, {r[self._day]: r["n"] for r in counted}, {n: seen.get[n] for n in marks})

    def publish(self, staged: Staged, replaces: Callable[[date], bool] = lambda day: False) -> None:
        """Make a version's days current, and drop the days that ``replaces`` says it stands for."""
        kept = {d: v for d, v in self.days().items() if not replaces(d)}
        current = kept | {d: Day(staged.version, n) for d, n in staged.days.items()}
        number = max([0, *self._numbers("records", "at-")]) + 1
        text = json.dumps({d.isoformat(): v.__dict__ for d, v in sorted(current.items())})
        files, aside = _located(self._spark, f"{self._path}/records/.at-{number:09d}")
        out = files.create(aside, True)
        out.write(bytearray(text.encode()))
        out.close()
        _, at = _located(self._spark, f"{self._path}/records/at-{number:09d}")
        if not files.rename(aside, at):
            raise RuntimeError(f"record {number} of {self._path} is there already: two writers")

    def remove_old(self) -> list[int]:
        """Delete versions that none of the last ``KEEP`` records names; gives their numbers.

        For the one writer, between a publication and the next staging: a version that is staged
        and not published counts as old.
        """
        numbers = self._numbers("records", "at-")
        used = {v.version for n in numbers[-self.KEEP :] for v in self._record(n).values()}
        old = [v for v in self._numbers("", "version=") if v not in used]
        for version in old:
            files, at = _located(self._spark, f"{self._path}/version={version}")
            files.delete(at, True)
        return old

