"""Exact positions of rows in a global order, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmarts.llm.common import small_side, written

#: Low bits of ``monotonically_increasing_id`` that count within a partition.
_ROW_BITS = 33


def _bytes(columns: Sequence[str]) -> Column:
    """Bytes of a row of these columns, as they are."""
    return sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns), F.lit(64))


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], label: str) -> DataFrame:
    """``df`` with ``position``, from 0 within its group by ``order``, and ``group_rows``.

    One range shuffle sorts by group and order, so a group of any size is spread over many tasks;
    the sorted rows are written, each with its task and its place there.  A group is one run of
    rows in each task, so a position is the place in the run and the sizes of the runs before: a
    table of at most tasks plus groups rows.  Nulls make a group of their own and come first.
    Rows that are equal in ``order`` are put in an arbitrary order, which the written table fixes;
    a group that holds many of these needs a last column that tells them apart.  Columns ``_at``,
    ``_part``, ``_first`` and ``_before`` of ``df`` are replaced.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    at = F.monotonically_increasing_id()
    rows = written(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", at), label)
    rows = rows.withColumn("_part", F.shiftright("_at", _ROW_BITS))
    runs = rows.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(*group)
    runs = runs.select(
        *group,
        "_part",
        "_first",
        (F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"),
        F.sum("_n").over(whole).alias("group_rows"),
    )
    runs = small_side(written(runs, f"{label}-runs"), _bytes(group))
    named = runs.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_part").alias("_p"), "_first", "_before", "group_rows")
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return rows.join(named, same).select(
        *df.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("position"), "group_rows"
    )
