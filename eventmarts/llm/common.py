"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmarts.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: White space of the word contracts, as a Java character class.
SPACE = r"\x20\x09-\x0D"
#: Columns of the documents table; pipeline stages return exactly these.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared folder.

    Cuts the lineage: what is read back survives the loss of any executor, is computed once, and
    its size is known to the planner.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    # Executors keep a finished shuffle's files until the driver's JVM collects its plan.
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, row_bytes: int | Column, limit_bytes: int = 32 << 20) -> DataFrame:
    """A written table, marked for broadcast only if its counted rows prove that it is small.

    ``row_bytes`` is the most that a row can take, or a column of what each row does take.
    Beyond the limit the plain table comes back and the join is a shuffle, whose hot keys
    adaptive execution splits.
    """
    if isinstance(row_bytes, Column):
        size = df.agg(F.sum(row_bytes)).first()[0] or 0
    else:
        size = df.count() * row_bytes
    return F.broadcast(df) if size <= limit_bytes else df


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
