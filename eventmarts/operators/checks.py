"""Data-quality checks and the gate that acts on them.

A check gives one row:
``check_name, target, passed, blocking, severity, observed, threshold``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmarts.contracts import FRESHNESS_MAX_LAG_SECONDS, KEY, VOLUME_MIN_FRACTION
from eventmarts.functions.times import to_micros
from eventmarts.operators.dedup import distinct_keys, duplicate_keys, latest_per_key

IDENTITY = ("did", "rkey", "cid")
WARN, ERROR = "WARN", "ERROR"


def _result(
    counted: DataFrame,
    name: str,
    target: str,
    passed: Column,
    observed: Column,
    threshold: Column,
    blocking: bool,
    severity: Column | str = ERROR,
) -> DataFrame:
    level = F.lit(severity) if isinstance(severity, str) else severity
    return counted.select(
        F.lit(name).alias("check_name"),
        F.lit(target).alias("target"),
        passed.alias("passed"),
        F.lit(blocking).alias("blocking"),
        level.alias("severity"),
        observed.cast("double").alias("observed"),
        threshold.cast("double").alias("threshold"),
    )


def freshness(
    bronze: DataFrame,
    now: datetime,
    target: str = "bronze",
    max_lag: int = FRESHNESS_MAX_LAG_SECONDS,
    column: str = "created_at",
) -> DataFrame:
    """Is the newest event at most ``max_lag`` seconds old?  An empty table fails, and only
    then is the severity the default one instead of a warning.

    Reads the one column; laid out by created day, only the last day's files.
    """
    rows = bronze
    if column == "created_at" and "created_day" in bronze.columns:
        last_day = bronze.select("created_day").agg(F.max("created_day")).scalar()
        rows = bronze.where(F.col("created_day") == last_day)
    newest = rows.agg(F.max(column).cast("timestamp").alias("newest"))
    return _freshness(newest, now, target, max_lag)


def freshness_of(
    spark: SparkSession,
    newest: int | None,
    now: datetime,
    target: str = "bronze",
    max_lag: int = FRESHNESS_MAX_LAG_SECONDS,
) -> DataFrame:
    """The same check of a newest event time that is known already, in microseconds; reads no table."""
    at = F.timestamp_micros(F.lit(newest).cast("long"))
    return _freshness(spark.range(1).select(at.alias("newest")), now, target, max_lag)


def _freshness(newest: DataFrame, now: datetime, target: str, max_lag: int) -> DataFrame:
    lag = F.round((F.lit(to_micros(now)) - F.unix_micros("newest")) / 1e6, 6)
    return _result(
        newest,
        "freshness",
        target,
        F.coalesce(lag <= max_lag, F.lit(False)),
        lag,
        F.lit(max_lag),
        blocking=False,
        severity=F.when(lag.isNull(), F.lit(ERROR)).otherwise(F.lit(WARN)),
    )


def volume(mart: DataFrame, target: str = "mart", fraction: float = VOLUME_MIN_FRACTION) -> DataFrame:
    """Does the latest day have at least ``fraction`` of the mean row count of earlier days?

    With no earlier day there is nothing to compare with, and the check passes.
    """
    per_day = mart.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    days = per_day.agg(
        F.max_by("n", "day").alias("latest"),
        F.sum("n").alias("all_rows"),
        F.count(F.lit(1)).alias("all_days"),
    )
    earlier = F.when(
        F.col("all_days") > 1, (F.col("all_rows") - F.col("latest")) / (F.col("all_days") - 1)
    )
    floor = F.lit(fraction) * earlier
    latest = F.coalesce("latest", F.lit(0))
    return _result(
        days,
        "volume",
        target,
        F.coalesce(latest >= floor, F.lit(True)),
        latest,
        F.round(floor, 6),
        blocking=False,
        severity=F.when(floor.isNull(), F.lit(ERROR)).otherwise(F.lit(WARN)),
    )


def _empty(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() | (F.col(c) == "") for c in columns])


def null_rate(deduped: DataFrame, target: str = "staging", columns: Sequence[str] = IDENTITY) -> DataFrame:
    """No row may have an empty or null identity column."""
    counted = deduped.where(_empty(columns)).agg(F.count(F.lit(1)).alias("bad"))
    return _result(
        counted, "null_rate", target, F.col("bad") == 0, F.col("bad"), F.lit(0), blocking=True
    )


def null_rate_of_versions(
    rows: DataFrame,
    version: Sequence[str],
    target: str = "staging",
    columns: Sequence[str] = IDENTITY,
) -> DataFrame:
    """``null_rate(latest_per_key(rows))`` without deduplicating every key.

    Only a key with an empty row in some version can have one in its latest, and normally
    there is none: then one filtered scan, which file statistics cut short, is all.
    """
    bad = rows.where(_empty(columns))
    if bad.isEmpty():
        return null_rate(bad, target, columns)
    suspects = bad.select(*KEY).distinct()
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in KEY]
    versions = rows.alias("r").join(suspects.alias("s"), reduce(lambda a, b: a & b, same), "left_semi")
    return null_rate(latest_per_key(versions, version), target, columns)


def not_null(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null rows per listed column, from one pass."""
    counted = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "null_rows").withColumn(
        "passed", F.col("null_rows") == 0
    )


def not_null_result(rows: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """The same as one check row, by a filter: null counts in the files rule out most of them."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    counted = rows.where(any_null).agg(F.count(F.lit(1)).alias("bad"))
    return _result(
        counted, "not_null", target, F.col("bad") == 0, F.col("bad"), F.lit(0), blocking=True
    )


def unique(rows: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """No key may occur twice."""
    counted = duplicate_keys(rows, keys).agg(F.count(F.lit(1)).alias("bad"))
    return _result(counted, "unique", target, F.col("bad") == 0, F.col("bad"), F.lit(0), blocking=True)


def reconcile_staging(staged: DataFrame, landing: DataFrame) -> DataFrame:
    """Deduplicated staging rows against distinct keys in landing."""
    landed_keys = distinct_keys(landing).agg(F.count(F.lit(1))).scalar()
    return (
        staged.agg(F.count(F.lit(1)).alias("staged"))
        .withColumn("landed_keys", landed_keys)
        .withColumn("passed", F.col("staged") == F.col("landed_keys"))
    )


class CheckFailed(RuntimeError):
    """A blocking check did not pass."""


def gate(results: Sequence[DataFrame]) -> list:
    """Run the checks; raise if a blocking one failed, and give all result rows back.

    Each check is one row, so what reaches the driver is as long as the list of checks.
    """
    rows = reduce(DataFrame.unionByName, results).collect()
    failed = [r for r in rows if r["blocking"] and not r["passed"]]
    if failed:
        raise CheckFailed(
            "; ".join(f"{r['check_name']} on {r['target']}: {r['observed']}" for r in failed)
        )
    return rows
