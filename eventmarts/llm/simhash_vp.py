"""SimHash near-duplicates, linked through vantage-point trees.

Distinct fingerprints are partitioned by their Hamming distances to vantage points: a tree, whose
shape is fitted to a bounded sample, sends a fingerprint inside or outside of each vantage point's
ball.  Two fingerprints at distance r have a point half-way between them, so it is enough that each
is present in every shard that its own ball of half the radius may touch: by the triangle
inequality d - r/2 <= mu means inside and d + r/2 > mu outside, and a fingerprint near the boundary
goes both ways.  Each shard is searched by the same kind of tree down to small leaves, compared
exactly, and reduced at once to one edge per linked fingerprint, so no group is ever spelled out as
pairs.  The edges of all shards are joined to components.

``keep_one`` adds the links of similar shingle sets, which fingerprints are too coarse to find.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmarts.llm.common import DOCUMENT_COLUMNS, written
from eventmarts.llm.components import stars
from eventmarts.llm.shingle_links import band_keys, set_id, shingle_hashes, shingle_set, similar

MAX_BITS = 2
#: Fingerprints to which the tree's shape is fitted; all fingerprints are then put in and searched.
SAMPLE = 16_384
#: Fingerprints that a shard should have, and a leaf of the search inside a shard.
SHARD = 2048
LEAF = 512
#: Vantage points tried for a node.
TRIES = 8
#: A split whose two sides would cost more than this share of the whole is not made.
WORTH = 0.9


def _bits(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint(text: str) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included."""
    return _bits(shingle_hashes(text)[0])


def _distances(fps: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(fps ^ point)


def _split(fps: np.ndarray, half: int, tries: int = TRIES) -> tuple[np.uint64, int] | None:
    """The vantage point and radius that leave least to compare, None if no split is worth it."""
    best, least = None, WORTH
    for point in fps[np.linspace(0, len(fps) - 1, tries).astype(int)]:
        shares = np.bincount(_distances(fps, point), minlength=66 + 2 * half).cumsum() / len(fps)
        radii = np.arange(64)
        inside = shares[np.minimum(radii + half, len(shares) - 1)]
        below = radii - half
        outside = 1 - np.where(below >= 0, shares[np.maximum(below, 0)], 0.0)
        cost = inside**2 + outside**2
        if cost.min() < least:
            best, least = (point, int(cost.argmin())), cost.min()
    return best


def _sides(fps: np.ndarray, rows: np.ndarray, point: np.uint64, radius: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    d = _distances(fps[rows], point).astype(np.int64)
    return rows[d - half <= radius], rows[d + half > radius]


class Tree:
    """Splits of a sample; ``shards`` tells in which leaves fingerprints are present."""

    def __init__(self, sample: np.ndarray, leaf: int, half: int):
        self.half = half
        self.nodes: list[tuple | None] = []
        self._grow(sample, leaf)

    def _grow(self, fps: np.ndarray, leaf: int) -> int:
        at = len(self.nodes)
        self.nodes.append(None)
        found = _split(fps, self.half) if len(fps) > leaf else None
        if found is not None:
            rows = np.arange(len(fps))
            inside, outside = _sides(fps, rows, *found, self.half)
            self.nodes[at] = (*found, self._grow(fps[inside], leaf), self._grow(fps[outside], leaf))
        return at

    def shards(self, fps: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        waiting = [(0, np.arange(len(fps)))]
        while waiting:
            at, rows = waiting.pop()
            if not len(rows):
                continue
            node = self.nodes[at]
            if node is None:
                yield at, rows
            else:
                inside, outside = _sides(fps, rows, node[0], node[1], self.half)
                waiting += [(node[2], inside), (node[3], outside)]


def _merge(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the sets of i and j; ``parent`` names each element's least member before and after."""
    while True:
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]


def linked(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """For each distinct fingerprint the index of the first that it is linked to, directly or not."""
    parent, half = np.arange(len(fps)), -(-max_bits // 2)
    waiting = [np.arange(len(fps))]
    while waiting:
        rows = waiting.pop()
        found = _split(fps[rows], half, 4) if len(rows) > LEAF else None
        if found is not None:
            waiting += _sides(fps, rows, *found, half)
            continue
        values = fps[rows]
        step = max(1, (1 << 21) // max(1, len(rows)))
        for at in range(0, len(rows), step):
            block = values[at : at + step]
            near = np.bitwise_count(block[:, None] ^ values[None, at:]) <= max_bits
            i, j = np.nonzero(near)
            if len(i) > len(block):
                _merge(parent, rows[i + at], rows[j + at])
    return parent


def _prints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of each row."""

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py() or "") for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return written(docs.select("doc_id", "text").mapInArrow(fingerprints, "doc_id bigint, fp bigint"), "simhash")


def _row_prints(docs: DataFrame) -> DataFrame:
    """(doc_id, row_hash, fp, sid, bands) of each row of (doc_id, row_hash, text)."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, sids, bands = np.empty(batch.num_rows, np.uint64), np.empty(batch.num_rows, np.int64), []
            for n, text in enumerate(batch.column(2)):
                hashes, words = shingle_hashes(text.as_py() or "")
                shingles = shingle_set(hashes, words)
                fps[n], sids[n] = _bits(hashes), set_id(shingles)
                bands.append(band_keys(shingles))
            columns = [pa.array(fps.view(np.int64)), pa.array(sids), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns], ["doc_id", "row_hash", "fp", "sid", "bands"]
            )

    schema = "doc_id bigint, row_hash bigint, fp bigint, sid bigint, bands array<bigint>"
    return written(docs.select("doc_id", "row_hash", "text").mapInArrow(prints, schema), "row-prints")


def _classes(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root, component_id) of each fingerprint of ``prints`` (doc_id, fp)."""
    firsts = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    n = firsts.count()
    sample = firsts.select("fp").orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()
    values = np.array([r["fp"] for r in sample], np.int64).view(np.uint64)
    tree = Tree(values, max(16, SHARD * len(values) // max(n, 1)), -(-max_bits // 2))

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for shard, rows in tree.shards(fps.view(np.uint64)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), shard, np.int32)), pa.array(fps[rows])], ["shard", "fp"]
                )

    def search(shard: pa.Table) -> pa.Table:
        fps = np.sort(shard["fp"].to_numpy())
        parent = linked(fps.view(np.uint64), max_bits)
        moved = parent != np.arange(len(fps))
        return pa.table({"a": fps[moved], "b": fps[parent[moved]]})

    edges = (
        firsts.select("fp").mapInArrow(present, "shard int, fp bigint").groupBy("shard").applyInArrow(search, "a bigint, b bigint")
    )
    roots = stars(edges).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    rooted = firsts.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first_id")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return written(rooted.join(least, "root").select("fp", "root", "component_id"), "simhash-classes")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (signed 64 bits) and component_id, one row per row of ``docs``.

    component_id is the smallest doc_id of all documents reachable through links.  A null or empty
    text, or one of white space, has fingerprint zero and is linked like any other; a null doc_id
    is kept and is never a component's id unless all its ids are null; repeated rows are returned
    as often; columns other than doc_id and text are not read; an empty table gives an empty result.
    """
    prints = _prints(docs)
    return prints.join(_classes(prints, max_bits), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The document columns of exactly one row of each near-duplicate group.

    Two texts are linked by fingerprints that differ in ``max_bits`` or less, or by sets of
    five-word shingles with a Jaccard similarity of 0.8 or more (``shingle_links``); texts without
    words are one group.  What is kept is the row of the smallest doc_id, null ids last, and among
    rows of that id the one of the smallest hash of all document columns; so a group of null ids
    keeps one row too, and rows that share an id but not a group are told apart by their hashes.
    """
    docs = docs.select(*DOCUMENT_COLUMNS, F.xxhash64(*DOCUMENT_COLUMNS).alias("row_hash"))
    prints = _row_prints(docs)
    rooted = prints.select("fp", "sid").distinct().join(_classes(prints, max_bits).select("fp", "root"), "fp")
    rooted = written(rooted.select("root", "sid").distinct(), "simhash-sets")
    least = rooted.groupBy("root").agg(F.min("sid").alias("b"), F.max("sid").alias("most")).filter("b <> most")
    by_bits = rooted.join(least, "root").filter("sid <> b").select(F.col("sid").alias("a"), "b")
    roots = stars(by_bits.unionByName(similar(docs.select("row_hash", "text"), prints)))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash")).alias("first")
    firsts = prints.groupBy("sid").agg(first).join(roots.withColumnRenamed("a", "sid"), "sid", "left")
    firsts = firsts.groupBy(F.coalesce("b", "sid").alias("root")).agg(F.min("first").alias("first"))
    kept = written(firsts.select(F.col("first.doc_id").alias("kept"), F.col("first.row_hash").alias("kept_hash")), "simhash-kept")
    own = F.col("doc_id").eqNullSafe(F.col("kept")) & (F.col("row_hash") == F.col("kept_hash"))
    # Only equal rows are left with the same id and hash.
    return docs.join(kept, own, "left_semi").dropDuplicates(["doc_id", "row_hash"]).drop("row_hash")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
