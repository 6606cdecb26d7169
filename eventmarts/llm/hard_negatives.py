"""Hard-negative mining with segment summaries as the filter.

Every vector stores, for each of its segments, the mean of its components and the deviation from
it (the length of what is left once the mean is taken off).  For two vectors the product of a
segment is its length times the product of the means, give or take the product of the deviations,
so summaries bound a score without the components.  Anchors in blocks meet candidates in shards;
a pair's bounds are first taken from a few long segments, then, for pairs still open, from more
and shorter ones, and only what is open after that is scored exactly.

Two passes: the first finds each anchor's positives, its best rows of the same label; the second
the rows of other labels whose scores lie in a band below a positive's.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmarts.llm.common import written
from eventmarts.llm.nra_topk import quantised

#: Candidates of a shard and anchors of a block; a task holds one of each.
SHARD_ROWS = 16384
BLOCK_ROWS = 4096
#: Anchors compared at a time within a task.
STEP_ROWS = 64
#: Numbers of segments, coarse to fine.  A level that costs as much as exact scores is left out.
SEGMENTS = (4, 16)
POSITIVES = 5
NEGATIVES = 5
#: A negative has at least this share of the positive's score, in hundredths.
LEAST_SHARE = 80
#: Pairs are gathered one by one while they are at most this share of a step's, or else multiplied whole.
GATHER_SHARE = 0.1
#: Finer segments are tried only where the coarser ones settled this share of the open pairs.
WORTH_SHARE = 0.05

_EXACT = float(2**53)


def _cuts(dims: int, segments: int) -> np.ndarray:
    """Starts of so many segments of about the same length."""
    return np.arange(segments) * dims // segments


def levels(dims: int) -> list[int]:
    """Numbers of segments that are worth a look for vectors of so many components."""
    return [s for s in SEGMENTS if 2 * s < dims]


def summaries(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means, times the root of the segment's length, and deviations: (rows, segments) each."""
    starts = _cuts(vectors.shape[1], segments)
    lengths = np.diff(np.append(starts, vectors.shape[1]))
    values = vectors.astype(np.float64)
    means = np.add.reduceat(values, starts, axis=1) / lengths
    rest = values - np.repeat(means, lengths, axis=1)
    return means * np.sqrt(lengths), np.sqrt(np.add.reduceat(rest * rest, starts, axis=1))


def _products(a: np.ndarray, c: np.ndarray, open_pairs: np.ndarray, left: list, right: list) -> list[np.ndarray]:
    """Inner products of ``left`` with ``right`` rows at the open pairs, in the order of ``nonzero``."""
    if open_pairs.mean() <= GATHER_SHARE:
        return [np.einsum("ij,ij->i", x[a], y[c]) for x, y in zip(left, right, strict=True)]
    return [(x @ y.T)[open_pairs] for x, y in zip(left, right, strict=True)]


class Side:
    """Vectors of one side of a task and their stored summaries, by number of segments."""

    def __init__(self, vectors: np.ndarray, stored: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        self.vectors, self.stored = vectors, stored
        norm = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        #: More than any product of two rows can be off by rounding, per unit of the other's length.
        self.norm = norm
        self.values = vectors.astype(np.float64)

    def part(self, rows: slice) -> Side:
        return Side(self.vectors[rows], {s: (m[rows], d[rows]) for s, (m, d) in self.stored.items()})


def scored(anchors: Side, candidates: Side, wanted: np.ndarray, narrow, work: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor index, candidate index, score) of the wanted pairs that ``narrow`` leaves open.

    ``narrow(open_pairs, a, c, lower, upper)`` says which of the open pairs (a, c) could still
    count, by the bounds of their scores.  ``work`` adds up multiplications.
    """
    open_pairs = wanted.copy()
    dims = anchors.vectors.shape[1]
    margin = 1e-9 * (1.0 + anchors.norm.max(initial=0) * candidates.norm.max(initial=0))
    for s in levels(dims):
        a, c = np.nonzero(open_pairs)
        if not len(a):
            break
        (am, ad), (cm, cd) = anchors.stored[s], candidates.stored[s]
        work["madds"] = work.get("madds", 0) + 2 * s * (len(a) if open_pairs.mean() <= GATHER_SHARE else open_pairs.size)
        middle, spread = _products(a, c, open_pairs, [am, ad], [cm, cd])
        keep = narrow(open_pairs, a, c, middle - spread - margin, middle + spread + margin)
        open_pairs[a[~keep], c[~keep]] = False
        if (~keep).mean() < WORTH_SHARE:
            break
    a, c = np.nonzero(open_pairs)
    if not len(a):
        return a, c, np.empty(0, np.int64)
    work["madds"] = work.get("madds", 0) + dims * (len(a) if open_pairs.mean() <= GATHER_SHARE else open_pairs.size)
    if anchors.norm.max(initial=0) * candidates.norm.max(initial=0) < _EXACT:
        (scores,) = _products(a, c, open_pairs, [anchors.values], [candidates.values])
        return a, c, np.rint(scores).astype(np.int64)
    (scores,) = _products(a, c, open_pairs, [anchors.vectors], [candidates.vectors])
    return a, c, scores


def _kth_best(open_pairs: np.ndarray, a: np.ndarray, c: np.ndarray, low: np.ndarray, k: int) -> np.ndarray:
    """The k-th highest of ``low`` at each anchor's open pairs, minus infinity where there are fewer."""
    table = np.full(open_pairs.shape, -np.inf)
    table[a, c] = low
    if table.shape[1] < k:
        return np.full(len(table), -np.inf)
    return np.partition(table, table.shape[1] - k, axis=1)[:, -k]


def _first(group: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each group's k first: highest scores, then smallest ids."""
    order = np.lexsort((ids, -scores, group))
    rank = np.arange(len(order)) - np.searchsorted(group[order], group[order], "left")
    return order[rank < k]


def best_positives(anchors: Side, candidates: Side, same: np.ndarray, ids: np.ndarray, k: int, work: dict):
    """(anchor index, candidate index, score) of each anchor's k best of the ``same`` pairs."""

    def narrow(open_pairs, a, c, lower, upper):
        return upper >= _kth_best(open_pairs, a, c, lower, k)[a]

    a, c, scores = scored(anchors, candidates, same, narrow, work)
    keep = _first(a, scores, ids[c], k)
    return a[keep], c[keep], scores[keep]


def best_negatives(anchors: Side, candidates: Side, other: np.ndarray, ids: np.ndarray, tops: list[np.ndarray], k: int, work: dict):
    """(anchor index, which of its ``tops``, candidate index, score): the k best at most a top, at least its share."""
    most = np.array([t.max(initial=-1) for t in tops], np.float64)
    least = np.array([-(-LEAST_SHARE * t[t >= 0].min(initial=2**53) // 100) for t in tops], np.float64)

    def narrow(open_pairs, a, c, lower, upper):
        return (upper >= least[a]) & (lower <= most[a])

    a, c, scores = scored(anchors, candidates, other & (most >= 0)[:, None], narrow, work)
    found = []
    ends = np.searchsorted(a, np.arange(len(tops) + 1))
    for i, of in enumerate(tops):
        at = slice(ends[i], ends[i + 1])
        near, which = scores[at], c[at]
        for j, top in enumerate(of):
            fits = np.nonzero((100 * near <= 100 * top) & (LEAST_SHARE * top <= 100 * near))[0]
            if len(fits):
                fits = fits[_first(np.zeros(len(fits), np.int64), near[fits], ids[which[fits]], k)]
                found.append(np.stack([np.full(len(fits), i), np.full(len(fits), j), which[fits], near[fits]]))
    return np.concatenate(found, axis=1) if found else np.empty((4, 0), np.int64)


def _matrix(column: pa.ChunkedArray, rows: int, dtype) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1).astype(dtype, copy=False)


def _side(t: pa.Table) -> Side:
    vectors = _matrix(t["vector"], t.num_rows, np.int64)
    summary = _matrix(t["summary"], t.num_rows, np.float64)
    stored, at = {}, 0
    for s in levels(vectors.shape[1]):
        stored[s] = (summary[:, at : at + s], summary[:, at + s : at + 2 * s])
        at += 2 * s
    return Side(vectors, stored)


def _with_summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each vector's means and deviations, level after level; vectors of one length together."""
    for batch in batches:
        vectors = batch["vector"]
        ends = vectors.offsets.to_numpy()
        lengths, values = np.diff(ends), vectors.values.to_numpy(zero_copy_only=False)
        sizes = np.array([2 * sum(levels(d)) for d in lengths], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.empty(offsets[-1])
        for dims in np.unique(lengths[sizes > 0]):
            rows = np.nonzero(lengths == dims)[0]
            x = values[ends[rows][:, None] + np.arange(dims)]
            parts = np.concatenate([part for s in levels(dims) for part in summaries(x, s)], axis=1)
            flat[offsets[rows][:, None] + np.arange(parts.shape[1])] = parts
        summary = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.float64()))
        yield pa.RecordBatch.from_arrays([*batch.columns, summary], [*batch.schema.names, "summary"])


_FOUND = "anchor_row bigint, anchor_id bigint, label int, other_id bigint, score bigint, top_at int, top_id bigint, top_score bigint"


def _found(**columns) -> pa.Table:
    names = ["anchor_row", "anchor_id", "label", "other_id", "score", "top_at", "top_id", "top_score"]
    types = {"label": pa.int32(), "top_at": pa.int32()}
    size = len(next(iter(columns.values()))) if columns else 0
    return pa.table({n: pa.array(columns.get(n, [None] * size), types.get(n, pa.int64())) for n in names})


def _search(k: int, negatives: bool):
    """Candidates of a shard for the anchors of a block, by either pass."""

    def block_by_shard(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _found()
        anchors, candidates = _side(left), _side(right)
        rows, own, labels = (left[c].to_numpy() for c in ("row", "vec_id", "label"))
        ids, others = right["vec_id"].to_numpy(), right["label"].to_numpy()
        tops = [np.array([t["score"] for t in ts], np.int64) for ts in left["tops"].to_pylist()] if negatives else []
        top_ids = [[t["id"] for t in ts] for ts in left["tops"].to_pylist()] if negatives else []
        out, work = [], {}
        for start in range(0, len(rows), STEP_ROWS):
            step = slice(start, start + STEP_ROWS)
            part = anchors.part(step)
            same = labels[step, None] == others[None, :]
            if negatives:
                a, j, c, score = best_negatives(part, candidates, ~same & (own[step, None] != ids[None, :]), ids, tops[step], k, work)
            else:
                a, c, score = best_positives(part, candidates, same & (own[step, None] != ids[None, :]), ids, k, work)
            found = {"anchor_row": rows[step][a], "anchor_id": own[step][a], "label": labels[step][a], "other_id": ids[c], "score": score}
            if negatives:
                found["top_at"] = j
                found["top_id"] = [top_ids[start + x][y] for x, y in zip(a, j, strict=True)]
                found["top_score"] = [int(tops[start + x][y]) for x, y in zip(a, j, strict=True)]
            out.append(_found(**found))
        return pa.concat_tables(out)

    return block_by_shard


def _valid(vectors: DataFrame) -> DataFrame:
    """Rows that take part, with integer components and their summaries."""
    kept = vectors.select("vec_id", F.col("label").cast("int").alias("label"), quantised(F.col("embedding")).alias("vector"))
    kept = kept.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    kept = kept.select("vec_id", "label", "vector", F.size("vector").alias("dims"), F.monotonically_increasing_id().alias("row"))
    schema = "vec_id bigint, label int, vector array<bigint>, dims int, row bigint, summary array<double>"
    return kept.withColumn("vec_id", F.col("vec_id").cast("bigint")).mapInArrow(_with_summaries, schema)


def mine(vectors: DataFrame, anchors: str, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vectors`` has vec_id, label and embedding, other columns are not read; ``anchors`` is a SQL
    condition on vec_id and label.  A score is the integer inner product of floor(256 x); higher
    ones come first, ties by the smaller id.  An anchor's positives are its first rows of the same
    label; for each, the first rows of other labels that have at most its score and at least
    ``LEAST_SHARE`` hundredths of it are returned.  Below a positive of negative score no row fits.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part.
    Rows with the anchor's id are the anchor's own, never its positives or negatives.  Vectors are
    compared with those of their own length, also empty ones, whose scores are all zero.  Repeated
    rows are anchors and candidates each for itself; an anchor with fewer positives or negatives
    returns what there is; an empty table gives an empty result.  Scores must fit 64 bits.
    """
    valid = written(_valid(vectors), "negatives-vectors")
    asked = valid.filter(anchors)
    total, queries = valid.count(), asked.count()
    shards, blocks = max(1, -(-total // SHARD_ROWS)), max(1, -(-queries // BLOCK_ROWS))
    keys = ["dims", "block", "shard"]

    def dealt(df: DataFrame, mine_: str, parts: int, all_: str, every: int) -> DataFrame:
        # A row's number grows within its partition, so its hash deals rows out evenly whatever they hold.
        own = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
        return df.withColumn(mine_, own).withColumn(all_, F.explode(F.sequence(F.lit(0), F.lit(every - 1))))

    # Columns of their own: both sides of a cogroup come from one table.
    right = dealt(valid.toDF(*valid.columns), "shard", shards, "block", blocks).groupBy(*keys)

    def searched(df: DataFrame, k: int, bands: bool) -> DataFrame:
        left = dealt(df, "block", blocks, "shard", shards).groupBy(*keys)
        return left.cogroup(right).applyInArrow(_search(k, bands), _FOUND)

    by_score = [F.desc("score"), "other_id"]
    rank = F.row_number().over(Window.partitionBy("anchor_row").orderBy(*by_score))
    best = searched(asked, positives, False).withColumn("rank", rank).filter(F.col("rank") <= positives)
    tops = best.groupBy(F.col("anchor_row").alias("row")).agg(
        F.array_sort(F.collect_list(F.struct("rank", F.col("other_id").alias("id"), "score"))).alias("tops")
    )
    with_tops = written(asked.join(tops, "row"), "negatives-anchors")
    near = searched(with_tops, negatives, True)
    rank = F.row_number().over(Window.partitionBy("anchor_row", "top_at").orderBy(*by_score))
    return (
        near.withColumn("rank", rank)
        .filter(F.col("rank") <= negatives)
        .select(
            "anchor_id",
            F.col("top_id").alias("positive_id"),
            F.col("rank").cast("int").alias("rank"),
            F.col("other_id").alias("negative_id"),
            F.col("top_score").alias("positive_score"),
            F.col("score").alias("negative_score"),
        )
    )


def relabelled(vectors: DataFrame) -> DataFrame:
    """One label in seven is moved on by one, so that every label has strangers among its rows."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.withColumn("label", moved)


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return mine(relabelled(vectors), "vec_id % 100 = 0")


ORACLE = """
with valid as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, c.vec_id as other_id, a.label = c.label as same,
    cast(coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])), 0) as bigint) as score
  from valid a join valid c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id and len(a.v) = len(c.v)),
positives as (
  select *, row_number() over (partition by anchor_id order by score desc, other_id) as r from scored where same
  qualify r <= 5),
ranked as (
  select p.anchor_id, p.other_id as positive_id, n.other_id as negative_id, p.score as positive_score,
    n.score as negative_score,
    row_number() over (partition by p.anchor_id, p.other_id order by n.score desc, n.other_id) as rank
  from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
    and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from ranked where rank <= 5
"""
