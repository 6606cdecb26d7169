"""The corpus pipeline: stages of the training-data operators, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventmarts.llm.common import DOCUMENT_COLUMNS, written
from eventmarts.llm.poisson_mix import mix
from eventmarts.llm.secret_forest import mask_secrets
from eventmarts.llm.simhash_vp import keep_one
from eventmarts.llm.weak_quality import keep_good
from eventmarts.llm.window_packing import pack


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier doesn't reject."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    return mask_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents, so that sources have their target shares, in random order."""
    return mix(docs).select(*DOCUMENT_COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in sequences of at most 2048 tokens."""
    return pack(docs, added_tokens=True)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources", mixing),
    ("packing", packing),
]

#: Trained stages and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
