"""Daily counts and exact distinct counts that batches add to without reading what is there.

Every author has a number of their own, and a batch stores, for each day and group it touches, the
set of its authors as bitmaps of numbers.  Sets are merged by OR when they are read, so a late batch
adds a few rows to an old day and the counts stay exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmarts.sources.tables import exists, read_table, write_unit

#: Authors are numbered in so many series side by side, each in a task of its own.
SERIES = 1024

_NUMBERS = T.StructType([T.StructField("did", T.StringType()), T.StructField("number", T.LongType())])


class DistinctMart:
    """Counts and distinct authors per day and group, as folders of batches below ``path``.

    ``group`` names the column that authors are counted by, beside the day.  One writer adds
    batches in turn; a batch that is added again under its key replaces its first try.  Rows are
    counted as they come: give a batch the newest version of each record, and each record once.
    """

    def __init__(self, spark: SparkSession, path: str, group: str) -> None:
        self._spark, self._path, self._group = spark, path, group

    def numbers(self) -> DataFrame:
        """Every author's number, with the batch that met them first."""
        return read_table(self._spark, f"{self._path}/authors", _NUMBERS, [("batch", "string")], missing_ok=True)

    def _numbered(self, rows: DataFrame, key: str) -> DataFrame:
        """``did, number`` of the authors of a batch, new ones numbered on from where their series ends."""
        known = self.numbers().where(F.col("batch") != key).select("did", "number")
        series = F.pmod(F.xxhash64("did"), F.lit(SERIES))
        ends = known.groupBy((F.col("number") % SERIES).alias("series")).agg(
            (F.max(F.floor(F.col("number") / SERIES)) + 1).alias("end")
        )
        fresh = rows.select("did").distinct().join(known, "did", "left_anti").withColumn("series", series)
        at = F.row_number().over(Window.partitionBy("series").orderBy("did")) - 1 + F.coalesce("end", F.lit(0))
        # At most SERIES rows of ends.
        numbered = fresh.join(F.broadcast(ends), "series", "left").withColumn("number", at * SERIES + F.col("series"))
        write_unit(numbered.select("did", F.col("number").cast("long").alias("number")), f"{self._path}/authors", "batch", key)
        return self.numbers().select("did", "number")

    def add(self, rows: DataFrame, key: str) -> None:
        """Add a batch of rows (day, group, did).  Rows without an author count, but add no author."""
        numbers = self._numbered(rows.where(F.col("did").isNotNull()), key)
        # One row per author first, so that neither an author nor a group with most rows is one task's.
        per_author = rows.groupBy("day", self._group, "did").agg(F.count(F.lit(1)).alias("events"))
        sets = (
            per_author.join(numbers, "did", "left")
            .groupBy("day", self._group, F.bitmap_bucket_number("number").alias("bucket"))
            .agg(F.sum("events").alias("events"), F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("authors"))
        )
        write_unit(sets, f"{self._path}/sets", "batch", key, ("day",))

    def totals(self, count_name: str, distinct_name: str) -> DataFrame:
        """The mart: (day, group) with its events and its distinct authors over all batches."""
        if not exists(self._spark, f"{self._path}/sets"):
            raise FileNotFoundError(f"no batch has been added to {self._path}")
        merged = (
            self._spark.read.parquet(f"{self._path}/sets")
            .groupBy("day", self._group, "bucket")
            .agg(F.sum("events").alias("events"), F.bitmap_or_agg("authors").alias("authors"))
        )
        return merged.groupBy("day", self._group).agg(
            F.sum("events").alias(count_name),
            F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("authors")).otherwise(0)).alias(distinct_name),
        )
