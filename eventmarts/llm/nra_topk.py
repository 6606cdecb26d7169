"""Exact top-k by inner product, by no-random-access aggregation over sorted lists.

Candidates are dealt into shards and queries into blocks of bounded size; every block meets every
shard once, in a task of its own.  There each dimension is a sorted list, read from its best end
(the largest values for a positive query weight, the smallest for a negative one) to a common
depth.  What has been read gives each candidate a lower and an upper bound; candidates whose upper
bound is below the k-th lower bound can no longer qualify.  Reading goes on, for the queries still
open, until few outsiders are left; then their final scores are resolved.  The best k of all shards
are merged by rank.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 8192
BLOCK_ROWS = 512
#: Depths of reading, as shares of the lists.
DEPTHS = (0.25, 0.5, 0.75, 1.0)
#: Final scores are resolved once at most this share of a shard's candidates can still qualify.
OPEN_SHARE = 0.1

_SCHEMA = "query_row bigint, query_id bigint, vec_id bigint, score bigint"


def quantised(embedding: Column) -> Column:
    """floor(256 x) of every component, in doubles; null for a vector that takes no part."""
    bad = F.exists(
        embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    return F.when(embedding.isNotNull() & ~bad, F.transform(embedding, lambda x: F.floor(x.cast("double") * 256)))


def nra(queries: np.ndarray, vectors: np.ndarray, skip: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, vector index, score) that hold every query's k best vectors, ties at the k-th included.

    ``skip`` is a boolean matrix of pairs that don't count.
    """
    n, d = vectors.shape
    largest = max(np.abs(queries).max(initial=0), np.abs(vectors).max(initial=0))
    margin = 0.0 if float(largest) ** 2 * d < 2**53 else float(largest) ** 2 * d * d * 2.0**-50
    values = vectors.astype(np.float64)
    lists = np.sort(values, axis=0)
    low, high = (lists[0], lists[-1]) if n else (np.zeros(d), np.zeros(d))
    open_rows, found = np.arange(len(queries)), []
    for share in DEPTHS:
        if not len(open_rows) or not n:
            break
        depth = max(1, int(np.ceil(n * share)))
        top, bottom = lists[n - depth], lists[depth - 1]
        plus = np.maximum(queries[open_rows], 0).astype(np.float64)
        minus = np.minimum(queries[open_rows], 0).astype(np.float64)
        upper = plus @ np.maximum(values, top).T + minus @ np.minimum(values, bottom).T
        upper[skip[open_rows]] = -np.inf
        if depth == n or n <= k:
            lower = upper
        else:
            lower = plus @ np.where(values >= top, values, low).T + minus @ np.where(values <= bottom, values, high).T
            lower[skip[open_rows]] = -np.inf
        if n > k:
            limit = np.partition(lower, n - k, axis=1)[:, n - k] - 2 * margin
            can = (upper >= limit[:, None]) & (upper > -np.inf)
        else:
            can = upper > -np.inf
        done = can.sum(axis=1) <= max(4 * k, OPEN_SHARE * n)
        if share == DEPTHS[-1]:
            done[:] = True
        q, v = np.nonzero(can & done[:, None])
        found.append((open_rows[q], v))
        open_rows = open_rows[~done]
    q = np.concatenate([x[0] for x in found]) if found else np.empty(0, np.int64)
    v = np.concatenate([x[1] for x in found]) if found else np.empty(0, np.int64)
    scores = np.empty(len(q), np.int64)
    for at in range(0, len(q), 1 << 17):
        part = slice(at, at + (1 << 17))
        scores[part] = np.einsum("ij,ij->i", queries[q[part]], vectors[v[part]])
    return q, v, scores


def _best(k: int):
    def block_by_shard(left: pa.Table, right: pa.Table) -> pa.Table:
        def matrix(t: pa.Table) -> np.ndarray:
            d = t["dims"][0].as_py() if t.num_rows else 0
            return t["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, d)

        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("query_row", "query_id", "vec_id", "score")})
        rows, own = left["row"].to_numpy(), left["vec_id"].to_numpy()
        ids = right["vec_id"].to_numpy()
        q, v, scores = nra(matrix(left), matrix(right), own[:, None] == ids[None, :], k)
        order = np.lexsort((ids[v], -scores, q))
        q, v, scores = q[order], v[order], scores[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
        q, v, scores = q[rank < k], v[rank < k], scores[rank < k]
        return pa.table({"query_row": rows[q], "query_id": own[q], "vec_id": ids[v], "score": scores})

    return block_by_shard


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """Each query's k best vectors: query_id, rank from 1, vec_id, score; ties to the smaller vec_id.

    Both tables have (vec_id, embedding); other columns are not read.  Vectors that are null or
    hold a null or non-finite component, and rows without an id, take no part.  A vector with the
    query's id is the query's own and is not returned.  Vectors of other lengths than the query's
    are no candidates.  Repeated rows are candidates, or queries, each for itself; a query with
    fewer candidates returns all of them; an empty table on either side gives an empty result.
    """

    def valid(df: DataFrame) -> DataFrame:
        v = quantised(F.col("embedding"))
        return (
            df.select("vec_id", v.alias("vector"))
            .filter(F.col("vector").isNotNull() & F.col("vec_id").isNotNull())
            .select("vec_id", "vector", F.size("vector").alias("dims"), F.monotonically_increasing_id().alias("row"))
        )

    candidates, asked = valid(vectors), valid(queries)
    shards = max(1, -(-vectors.count() // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // BLOCK_ROWS))
    # A row's number grows within its partition, so its hash deals rows out evenly whatever they hold.
    left = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    right = candidates.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    keys = ["dims", "block", "shard"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_best(k), _SCHEMA)
    by_score = Window.partitionBy("query_row", "query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(by_score))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


ORACLE = """
with valid as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from valid q join valid c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5
"""
