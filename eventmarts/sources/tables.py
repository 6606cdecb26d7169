"""Tables as folders of parquet files, written so that a repeated write changes nothing.

Every append goes to folders named by the unit of work (a stream's micro-batch, a load's
starting mark), below the day of arrival where the table has one, and overwrites them.  A
retry after a lost driver therefore replaces what its first try left behind, whole or
half-written, and never adds to it.  Only writers create tables; reading one that is not
there fails.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folders of an archived table, above those of the units.
DAY_COLUMNS = ("ingest_day",)
#: Days that are stored with archived rows.
STORED_DAYS = ("ingest_day", "created_day")


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partitions: Sequence[tuple[str, str]] = (),
    missing_ok: bool = False,
) -> DataFrame:
    """A table by its declared schema.

    A missing table raises, unless ``missing_ok`` says that it may not be built yet; then it
    is empty.  Nothing is written.
    """
    full = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in schema.fields]
        + [T.StructField(n, T._parse_datatype_string(t), True) for n, t in partitions]
    )
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def _located(spark: SparkSession, path: str):
    """A path and its file system, whatever store it is in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _located(spark, path)
    return files.exists(at)


def write_unit(
    rows: DataFrame,
    path: str,
    unit: str,
    key: str,
    partition_by: Sequence[str] = (),
    block_rows: int | None = None,
    once: bool = False,
    **measures: Column,
) -> dict:
    """Write the rows of one unit of work; gives ``rows`` and measures.

    They go to ``path/unit=key``, or with partition columns to ``path/day=.../unit=key``, the
    day first, so that a table keeps one folder per day to list and to prune.  Rows are first
    gathered by the partition columns with a rebalance, which splits a day that holds most of
    the rows over several tasks and merges the small ones, so each folder gets files of a good
    size; inside a file rows stand by event time, so its statistics prune row groups.

    With ``once`` a unit that is already complete is left alone, and no rows are counted:
    readers that follow the folder file by file would take a second writing for new records.

    The row count and any further aggregates are taken while writing.  When a lost executor
    makes tasks run twice the count may come out too high, so it only serves reports; a
    largest value or a set of values does not change.
    """
    spark = rows.sparkSession
    if once and exists(spark, f"{path}/{unit}={key}/_SUCCESS"):
        return {"rows": 0, **dict.fromkeys(measures)}
    seen = Observation()
    named = [m.alias(name) for name, m in measures.items()]
    out = rows.hint("rebalance", *partition_by) if partition_by else rows
    # Above the rebalance: below it, an empty shuffle would take the measuring step with it.
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"), *named)
    folders = (*partition_by, unit) if partition_by else ()
    if folders:
        by_time = ["created_at"] if "created_at" in rows.columns else []
        out = out.withColumn(unit, F.lit(key)).sortWithinPartitions(*folders, *by_time)
    writer = out.write.mode("overwrite")
    if block_rows is not None:
        writer = writer.option("maxRecordsPerFile", block_rows)
    if folders:
        # Replaces the folders that get rows, each in one step; those of other units stay.
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)
    else:
        writer.parquet(f"{path}/{unit}={key}")
    return seen.get


def copy_units(
    rows: DataFrame,
    path: str,
    unit: str = "batch",
    partition_by: Sequence[str] = DAY_COLUMNS,
    block_rows: int | None = None,
) -> int:
    """Write rows into the folders of the units they come from; gives their count, for reports.

    ``rows`` has the unit's name in a column.  The folders are replaced whole, so units that a
    lost driver left half copied are right after a retry, whatever other units the retry takes.
    """
    seen, folders = Observation(), (*partition_by, unit)
    by_time = ["created_at"] if "created_at" in rows.columns else []
    out = rows.hint("rebalance", *folders).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = out.sortWithinPartitions(*folders, *by_time).write.mode("overwrite")
    if block_rows is not None:
        writer = writer.option("maxRecordsPerFile", block_rows)
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)
    return seen.get["rows"]


def read_units(
    spark: SparkSession, path: str, schema: T.StructType, units: Sequence[tuple[str, date]], unit: str = "batch"
) -> DataFrame:
    """Whole units of an archived table, with their names; no other folder is listed."""
    full = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in schema.fields]
        + [T.StructField(c, T.DateType(), True) for c in STORED_DAYS]
        + [T.StructField(unit, T.StringType(), True)]
    )
    folders = [f"{path}/ingest_day={day.isoformat()}/{unit}={name}" for name, day in units]
    return spark.read.schema(full).option("basePath", path).parquet(*folders)


def with_day_columns(rows: DataFrame) -> DataFrame:
    """Add the day of arrival, by which tables are laid out, and the day of the event."""
    return rows.withColumn("ingest_day", F.to_date("ingest_ts")).withColumn(
        "created_day", F.to_date("created_at")
    )


def read_archived(
    spark: SparkSession, path: str, schema: T.StructType, missing_ok: bool = False
) -> DataFrame:
    """An archived table with its days; a filter on ``ingest_day`` prunes whole folders."""
    return read_table(spark, path, schema, [(c, "date") for c in STORED_DAYS], missing_ok)


def replace_days(recomputed: DataFrame, path: str, start: date | None, schema: T.StructType) -> None:
    """Replace every day of the mart from ``start`` on, or all days, by the recomputed rows.

    Days with rows are swapped together at the end of the write by dynamic partition
    overwrite, so a failed run leaves the mart as it was.  A day that had rows and has none
    now is emptied, so no stale group survives.
    """
    spark = recomputed.sparkSession
    before = read_mart(spark, path, schema, missing_ok=True).select("day").distinct()
    if start is not None:
        before = before.where(F.col("day") >= F.lit(start))
    days_before = {r["day"] for r in before.collect()}  # one value per day
    written = Observation()
    (
        recomputed.hint("rebalance", "day")
        .observe(written, F.collect_set("day").alias("days"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )
    for day in days_before.difference(written.get["days"]):
        files, at = _located(spark, f"{path}/day={day.isoformat()}")
        files.delete(at, True)


def read_mart(
    spark: SparkSession, path: str, schema: T.StructType, missing_ok: bool = False
) -> DataFrame:
    stored = T.StructType([f for f in schema.fields if f.name != "day"])
    return read_table(spark, path, stored, [("day", "date")], missing_ok).select(*schema.names)
