"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate: its target share of the output divided by its size.  A
document's number of copies is the Poisson distribution of that mean, inverted at a uniform number
hashed from the seed, the document's id and its text, so it depends on nothing else: not on the
partitioning, not on a retry.  Every document is exploded by its count and the copies are dealt out
at random.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmarts.llm.common import DOCUMENT_COLUMNS, small_side, written

SEED = 42
#: Target shares are sizes to this power where no weights are given.
EXPONENT = 0.5


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) of 52 bits, hashed from the seed and the parts (null reads as ``null``)."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, size: float = 1.0) -> DataFrame:
    """(source, chars, rate): the mean number of copies of each source's documents.

    ``weights`` are target shares by source, a source that is not named gets 0; without weights
    the share is the source's size to the power ``EXPONENT``.  The output has about ``size`` times
    the characters of the input.  A source without any character has rate 1.
    """
    sized = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(
        F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("double").alias("chars")
    )
    if weights is None:
        share = F.pow("chars", F.lit(EXPONENT))
    else:
        share = F.lit(0.0)
        for name, value in weights.items():
            share = F.when(F.col("source") == name, float(value)).otherwise(share)
    whole = Window.partitionBy()
    # One row per source has been summed before this window.
    return sized.withColumn("share", share).select(
        "source",
        "chars",
        F.when(F.col("chars") == 0, 1.0)
        .otherwise(size * F.sum("chars").over(whole) * F.col("share") / F.sum("share").over(whole) / F.col("chars"))
        .alias("rate"),
    )


def with_steps(rates: DataFrame) -> DataFrame:
    """Adds ``steps``: the cumulative probabilities of 0, 1, 2, ... copies, far into the tail."""
    counts = rates.filter(F.col("rate") > 0).select(
        "source",
        "rate",
        F.explode(F.sequence(F.lit(0), F.ceil(F.col("rate") + 10 * F.sqrt("rate") + 20).cast("int"))).alias("k"),
    )
    upto = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    log_factorial = F.sum(F.when(F.col("k") > 0, F.log(F.col("k").cast("double"))).otherwise(0.0)).over(upto)
    chance = F.exp(-F.col("rate") + F.col("k") * F.log("rate") - F.col("log_factorial"))
    steps = (
        counts.withColumn("log_factorial", log_factorial)
        .withColumn("step", F.sum(chance).over(upto))
        .groupBy("source")
        .agg(F.array_sort(F.collect_list("step")).alias("steps"))
    )
    return rates.join(steps, "source", "left")


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    size: float = 1.0,
    seed: int = SEED,
) -> DataFrame:
    """Copies of the documents in random order, so that sources have their target shares.

    Returns the document columns with ``source_rate``, ``copies`` and ``copy`` (from 1).  A null
    source counts as the source ``''``; null and empty texts are copied like any other of their
    source; rows that repeat an id and a text get the same number of copies each, rows that share
    only the id, or only a null id, are drawn each for itself; an empty table gives an empty
    result.  Other columns of ``docs`` are left out.
    """
    # Equal rows have equal order keys; by where they were read they still go to many tasks.
    docs = docs.select(*DOCUMENT_COLUMNS, F.spark_partition_id().alias("salt"))
    text_hash = F.md5(F.coalesce("text", F.lit("")))
    rates = written(with_steps(source_rates(docs, weights, size)), "mix-rates").select(
        F.col("source").alias("rate_source"), F.col("rate").alias("source_rate"), "steps"
    )
    drawn = uniform(seed, F.lit("copies"), F.col("doc_id"), text_hash)
    counted = (
        docs.join(small_side(rates, 4096), F.coalesce("source", F.lit("")) == F.col("rate_source"))
        .withColumn("draw", drawn)
        .withColumn("copies", F.coalesce(F.size(F.filter("steps", lambda c: c <= F.col("draw"))), F.lit(0)))
        .filter(F.col("copies") > 0)
    )
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("order"), id_text, text_hash, "copy"))
    return (
        counted.select(*DOCUMENT_COLUMNS, "salt", "source_rate", "copies", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
        .withColumn("order_key", order)
        .repartition("order_key", "salt")
        .sortWithinPartitions("order_key")
        .drop("order_key", "salt")
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).withColumn("source_rate", F.round("source_rate", 6))


ORACLE = f"""
with sized as (
  select coalesce(source, '') as source, cast(coalesce(sum(length(text)), 0) as double) as chars
  from documents group by 1),
rates as (
  select source, case when chars = 0 then 1.0
    else (sum(chars) over ()) * pow(chars, {EXPONENT}) / (sum(pow(chars, {EXPONENT})) over ()) / chars end as rate
  from sized),
counts as (
  select source, rate, unnest(range(0, cast(ceil(rate + 10 * sqrt(rate) + 20) as bigint) + 1)) as k
  from rates where rate > 0),
logs as (
  select *, sum(case when k > 0 then ln(k) else 0 end) over (partition by source order by k
    rows unbounded preceding) as log_factorial from counts),
steps as (
  select source, k, sum(exp(-rate + k * ln(rate) - log_factorial)) over (partition by source order by k
    rows unbounded preceding) as step from logs),
drawn as (
  select d.*, r.rate, (('0x' || substr(md5('{SEED}:copies:' || coalesce(cast(doc_id as varchar), 'null') || ':' || md5(coalesce(text, ''))), 1, 13))
    ::bigint) / pow(2.0, 52) as draw
  from documents d join rates r on coalesce(d.source, '') = r.source),
counted as (
  select d.*, (select count(*) from steps s where s.source = coalesce(d.source, '') and s.step <= d.draw) as copies
  from drawn d)
select doc_id, text, lang, source, n_chars, round(rate, 6) as source_rate, cast(copies as integer) as copies,
  cast(unnest(range(1, copies + 1)) as integer) as copy
from counted where copies > 0
"""
