"""Dashboard queries over deduplicated posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmarts.contracts import TOP_TAGS
from eventmarts.functions.times import minute_of
from eventmarts.operators.dedup import distinct_keys


def total(deduped: DataFrame) -> DataFrame:
    return deduped.agg(F.count(F.lit(1)).alias("total"))


def total_of_versions(rows: DataFrame) -> DataFrame:
    """The same number from undeduplicated rows: distinct keys, without sorting versions."""
    return total(distinct_keys(rows))


def per_minute(deduped: DataFrame) -> DataFrame:
    """Posts per minute of event time, in time order."""
    return (
        deduped.groupBy(minute_of("created_at").alias("time"))
        .agg(F.count(F.lit(1)).alias("posts"))
        .orderBy("time")
    )


def top_tags(deduped: DataFrame, k: int = TOP_TAGS, tags: str = "langs") -> DataFrame:
    """Most frequent tags; rows without tags do not count.  Ties go by tag."""
    return (
        deduped.select(F.explode(tags).alias("lang"))
        .groupBy("lang")
        .agg(F.count(F.lit(1)).alias("posts"))
        .orderBy(F.desc("posts"), F.asc("lang"))
        .limit(k)
    )


def latest_n(rows: DataFrame, n: int = 5, arrival: str = "ingested_at", ties: tuple = ()) -> DataFrame:
    """The most recently arrived rows."""
    return rows.orderBy(*[F.col(c).desc() for c in (arrival, *ties)]).limit(n)
