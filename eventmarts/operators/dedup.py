"""Latest version per key, and audits of how many versions there are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmarts.contracts import KEY


def latest_per_key(
    rows: DataFrame,
    version: Sequence[str] = ("ingest_ts", "kafka_partition", "kafka_offset", "cid"),
    keys: Sequence[str] = KEY,
) -> DataFrame:
    """One row per key: the one with the highest ``version``, compared column by column.

    ``version`` should end in tie-breakers that make the order total.  The rank filter is
    pushed below the shuffle, so each task sends at most one row per key, and a key that
    holds a large share of all rows arrives as one row per task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in version])
    return (
        rows.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")
    )


def write_by_author(
    rows: DataFrame, path: str, name: str, buckets: int, key: str = KEY[0], order: Sequence[str] = KEY[1:]
) -> DataFrame:
    """Store rows in ``buckets`` by author, sorted by key; gives the stored table.

    All versions of a record then lie in one bucket, so ``latest_per_key``, audits of keys and
    joins on the author run over it without a shuffle.  The buckets are written down in the
    catalog under ``name``; the files are below ``path``.  One task writes each bucket, whole: a
    bucket needs room for an author's rows, so choose many.
    """
    spread = rows.repartition(buckets, key).sortWithinPartitions(key, *order)
    writer = spread.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key, *order)
    writer.saveAsTable(name)
    return rows.sparkSession.table(name)


def latest_insert(rows: DataFrame, keys: Sequence[str], run: str = "run_seq") -> DataFrame:
    """For tables without a version column: the row written by the latest run wins."""
    return latest_per_key(rows, version=(run,), keys=keys).drop(run)


def distinct_keys(rows: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """One row per key with its number of versions; a hash aggregate with map-side partials."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


def duplicate_keys(rows: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Keys with more than one version, and how many."""
    return distinct_keys(rows, keys).where(F.col("copies") > 1)


def raw_vs_deduped(rows: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Raw and deduplicated row counts in one pass and one shuffle."""
    return distinct_keys(rows, keys).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw"), F.count(F.lit(1)).alias("deduped")
    )
