"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source and ranked there; a row's fractional rank,
its rank as a share of its source, says how far along the output it stands.  Sorting by it mixes
the sources in proportion all along, so cutting the order into equal counts gives every shard each
source's share, to within a row at either cut.  Ranks and the final order are exact positions in
range-sorted tables, so neither a hot source nor a shard is ever in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmarts.llm.common import DOCUMENT_COLUMNS, written
from eventmarts.llm.numbering import numbered

SEED = 42
SHARDS = 8
#: The law that the shards keep: their counts differ by one at most.
LAW = "rows"


def _narrow(docs: DataFrame, seed: int) -> DataFrame:
    """What the order is made of, beside the id, the text's size and its checksum."""
    text = F.coalesce("text", F.lit(""))
    parts = [F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(text)]
    return docs.select(
        "doc_id",
        "source",
        (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(F.concat_ws(":", *parts)).alias("shuffle"),
        "row",
    )


def _placed(rows: DataFrame, shards: int) -> DataFrame:
    """Rows of ``source, shuffle, row`` and more, with ``shard`` and ``slot``."""
    ranked = numbered(rows, ["source"], ["shuffle", "row"], "shard-ranks")
    share = (F.col("position") + F.lit(0.5)) / F.col("group_rows")
    mixed = ranked.withColumn("share", share).withColumn("all", F.lit(0)).drop("position", "group_rows")
    ordered = numbered(mixed, ["all"], ["share", "source", "shuffle", "row"], "shard-order")
    # In whole numbers: shard s begins at the first position p with p * shards >= s * rows.
    return (
        ordered.withColumn("shard", F.expr(f"position * {shards} div group_rows").cast("int"))
        .withColumn("slot", F.expr(f"position - (shard * group_rows + {shards - 1}) div {shards}"))
        .drop("share", "all", "position", "group_rows")
    )


def place(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, text_crc32, row, shard and slot of every document; texts stay where they are.

    ``size`` is the text's UTF-8 bytes and one more, ``slot`` counts from 0 without gaps in each
    shard.  A null source is a source of its own; a null text has size 1 and the checksum of an
    empty one; rows of null or shared ids are ordered by their texts, equal rows by where they
    were read, each in its own slot.  Copies of a text aren't kept together: a text with more
    copies than a shard has rows could not be.  An empty table gives an empty result; with fewer
    rows than shards some shards stay empty.  Columns of ``docs`` beyond doc_id, text and source
    are not read.
    """
    rows = docs.select("doc_id", "text", "source", F.monotonically_increasing_id().alias("row"))
    return _placed(written(_narrow(rows, seed), "shard-rows"), shards).drop("shuffle")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The documents as one folder per shard, ``path/shard=0`` and on; returns them with their slots.

    Files of a folder follow each other by slot, each sorted by it.  The order is found on narrow
    rows; texts are copied once, to have fixed row numbers, and shuffled twice.
    """
    kept = written(docs.select(*DOCUMENT_COLUMNS, F.monotonically_increasing_id().alias("row")), "shard-texts")
    slots = _placed(written(_narrow(kept, seed), "shard-rows"), shards).select("row", "shard", "slot")
    sized = kept.join(slots, "row").drop("row")
    (
        sized.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
    return docs.sparkSession.read.schema(sized.schema).parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return place(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


_BYTE = "list_reduce(list_prepend(xor(crc, b), range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)"
ORACLE = f"""
with sized as (
  select doc_id, source, encode(coalesce(text, '')) as bytes,
    md5('{SEED}:' || coalesce(cast(doc_id as varchar), 'null') || ':' || md5(coalesce(text, ''))) as shuffle
  from documents),
summed as (
  select doc_id, source, shuffle, octet_length(bytes) + 1 as size,
    xor(list_reduce(list_prepend(4294967295,
      list_transform(regexp_extract_all(hex(bytes), '..'), lambda h: cast('0x' || h as bigint))),
      lambda crc, b: {_BYTE}), 4294967295) as text_crc32
  from sized),
ranked as (
  select *, (row_number() over (partition by source order by shuffle) - 0.5::double)
    / count(*) over (partition by source) as share
  from summed),
placed as (
  select *, row_number() over (order by share, source nulls first, shuffle) - 1 as position, count(*) over () as n
  from ranked)
select doc_id, size, text_crc32, '{LAW}' as law, cast(position * {SHARDS} // n as integer) as shard,
  position - ((position * {SHARDS} // n) * n + {SHARDS - 1}) // {SHARDS} as slot,
  cast(null as integer) as grown_shard, source
from placed
"""
