"""Which units of work of a table are finished: what a load still has to take.

A writer adds a unit after its rows are complete, so a reader that goes by the ledger sees whole
units only, and sees each whatever any clock said when it was written.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmarts.sources.tables import _located, exists

ENTRIES = T.StructType(
    [
        T.StructField("unit", T.StringType()),
        T.StructField("day", T.DateType()),  # folder of the unit; null if it has no rows
        T.StructField("rows", T.LongType()),
        T.StructField("newest", T.LongType()),  # latest event time in it, in microseconds
    ]
)


@dataclass(frozen=True)
class Unit:
    unit: str
    day: date | None
    rows: int
    newest: int | None = None


class Ledger:
    """Append-only list of finished units, one small file per addition, folded now and then.

    One writer adds; any number of readers look.  Adding a unit again changes nothing.
    """

    #: Additions after which they are put together in one table.
    FOLD = 256

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path

    def _names(self, folder: str) -> list[str]:
        files, at = _located(self._spark, f"{self._path}/{folder}")
        return sorted(f.getPath().getName() for f in files.listStatus(at)) if files.exists(at) else []

    def _generations(self) -> list[int]:
        """Complete ones, oldest first."""
        numbers = sorted(int(n.split("=")[1]) for n in self._names("folded") if "=" in n)
        return [n for n in numbers if exists(self._spark, f"{self._path}/folded/generation={n}/_SUCCESS")]

    def _new(self) -> list[str]:
        return [n for n in self._names("new") if exists(self._spark, f"{self._path}/new/{n}/_SUCCESS")]

    def _read(self, new: Sequence[str], generations: Sequence[int]) -> DataFrame:
        paths = [f"{self._path}/new/{n}" for n in new]
        paths += [f"{self._path}/folded/generation={g}" for g in generations[-1:]]
        if not paths:
            return self._spark.createDataFrame([], ENTRIES)
        # A unit may stand in a fold and in the addition that the fold has not removed yet.
        return self._spark.read.schema(ENTRIES).parquet(*paths).dropDuplicates(["unit", "day"])

    def units(self) -> DataFrame:
        """(unit, day, rows, newest) of every finished unit; a unit has a row for each of its days."""
        new = self._new()  # before the folds: what is folded meanwhile is then seen twice, not missed
        return self._read(new, self._generations())

    def add(self, units: Sequence[Unit], name: str | None = None) -> None:
        """Record finished units.  A retry under the same name replaces the first try."""
        if not units:
            return
        rows = [(u.unit, u.day, u.rows, u.newest) for u in units]
        added = self._spark.createDataFrame(rows, ENTRIES).coalesce(1)
        added.write.mode("overwrite").parquet(f"{self._path}/new/{name or uuid.uuid4().hex}")
        if len(self._names("new")) >= self.FOLD:
            self.fold()

    def fold(self) -> None:
        """Put all additions into the next numbered table, then remove them.

        A reader keeps the table it has listed: the last two stay.
        """
        new, generations = self._new(), self._generations()
        number = (generations[-1] if generations else 0) + 1
        folded = self._read(new, generations)
        folded.coalesce(1).write.mode("overwrite").parquet(f"{self._path}/folded/generation={number}")
        for old in [f"new/{n}" for n in new] + [f"folded/generation={g}" for g in generations[:-1]]:
            files, at = _located(self._spark, f"{self._path}/{old}")
            files.delete(at, True)

    def pending(self, done: Ledger, most: int) -> list[Unit]:
        """The first ``most`` units of this ledger, by day and name, that ``done`` doesn't have."""
        same = F.col("a.unit").eqNullSafe(F.col("b.unit")) & F.col("a.day").eqNullSafe(F.col("b.day"))
        left = self.units().alias("a").join(done.units().alias("b"), same, "left_anti")
        return [Unit(**r.asDict()) for r in left.orderBy("day", "unit").limit(most).collect()]

    def totals(self) -> tuple[int, int | None]:
        """Rows of all units, and the latest event time in them."""
        rows, newest = self.units().agg(F.coalesce(F.sum("rows"), F.lit(0)), F.max("newest")).first()
        return rows, newest
