"""Daily aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmarts.contracts import UNDETERMINED_LANG, EventType
from eventmarts.functions.times import day_of


def posts_by_lang(posts: DataFrame) -> DataFrame:
    """Posts and distinct authors per day and language.

    A post without languages counts under the undetermined tag; a tag listed twice counts
    twice in ``posts`` and once in ``authors``.  The exact distinct count shuffles first on
    (day, lang, did), so a language with most of the rows is spread over all tasks.
    """
    return (
        lang_rows(posts)
        .groupBy("day", "lang")
        .agg(F.count(F.lit(1)).alias("posts"), F.count_distinct("did").alias("authors"))
    )


def lang_rows(posts: DataFrame) -> DataFrame:
    """Day, language and author, a row for each of a post's tags."""
    tags = F.when(F.size("langs") == 0, F.array(F.lit(UNDETERMINED_LANG))).otherwise(F.col("langs"))
    return posts.select(day_of("created_at").alias("day"), F.explode(tags).alias("lang"), "did")


def events_by_subject(
    events: DataFrame, subject: str, count_name: str, distinct_name: str
) -> DataFrame:
    """Events and distinct actors per day and subject; a viral subject spreads as above."""
    return (
        subject_rows(events, subject)
        .groupBy("day", subject)
        .agg(F.count(F.lit(1)).alias(count_name), F.count_distinct("did").alias(distinct_name))
    )


def subject_rows(events: DataFrame, subject: str) -> DataFrame:
    """Day, subject and actor of every event."""
    return events.select(day_of("created_at").alias("day"), subject, "did")


def daily_mart(events: DataFrame, event: EventType) -> DataFrame:
    """The mart of one event type from its deduplicated rows."""
    if event.name == "post":
        return posts_by_lang(events)
    return events_by_subject(events, event.dimension, event.count_name, event.distinct_name)


def rollup(mart: DataFrame, count_name: str) -> DataFrame:
    """Sum of one count over the whole mart."""
    return mart.agg(F.coalesce(F.sum(count_name), F.lit(0)).alias(count_name))
