"""Links between texts whose sets of five-word shingles are alike: Jaccard similarity of 0.8 or more.

Fingerprints of 64 bits are too coarse for that similarity (such texts differ in about ten bits, a
radius at which a metric tree prunes nothing), so candidates meet in the buckets of banded minimum
hashes and every link is checked on the whole sets.  A bucket's members are first compared with one
of them, the leader, then with several, and what the links found join is not compared again.  Buckets
that still hold several components are then searched whole, in blocks, so no pair of a bucket is left
out.  Before sets are compared, a pair must pass its sizes and its parities: 1024 bits, each telling
whether an odd number of the set's shingles fall on it, differ in no more bits than the sets differ in
shingles, so a pair that differs in too many is no link.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmarts.llm.common import small_side, written
from eventmarts.llm.components import stars

#: Words of the shingles that are hashed, and the seed; two of these spell one of WORDS words.
SHINGLE = 3
SEED = 42
WORDS = 5
#: Similarity as a fraction, so that the check is one of whole numbers.
ALIKE = (4, 5)
#: Two texts of similarity s share a bucket with probability 1 - (1 - s**ROWS)**BANDS, 0.998 at 0.8.
BANDS, ROWS = 16, 5
#: Leaders that a bucket draws in each round but the first.
DRAWS = 16
#: Rounds go on while the last one found more than this share of the sets; the search of whole buckets does the rest.
WORTH = 0.01
#: Longs of a set's parities.
PARITIES = 16
#: Members of a bucket that are compared with as many others at a time.
MEMBERS = 4096
#: Shingles whose minimum hashes are taken at a time.
BLOCK = 1024
_MIX = np.uint64(0x9E3779B97F4A7C15)


@cache
def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(42)
    factors = rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64) << np.uint64(1) | np.uint64(1)
    return factors[:, None], rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64)[:, None]


def shingle_hashes(text: str) -> tuple[np.ndarray, int]:
    """XXH64 of each of a text's word shingles, repeats included, and the number of its words."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # of bytes: lower-cases A-Z, splits at ASCII white space
    if not words:
        return np.empty(0, np.uint64), 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    if len(words) > SHINGLE:
        starts, ends = starts[: 1 - SHINGLE], ends[SHINGLE - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hashes = np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), 1 << 14):
        part = slice(at, at + (1 << 14))
        cut = [joined[a:b] for a, b in zip(starts[part].tolist(), ends[part].tolist(), strict=True)]
        hashes[part] = np.fromiter(map(xxh64_intdigest, cut, repeat(SEED)), np.uint64, len(cut))
    return hashes, len(words)


def shingle_set(hashes: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's five-word shingles, from those of its three-word shingles.

    The three-word shingles at i and i + 2 spell the five words from i on.  A text of fewer than
    five words is one shingle; a text without words has none.
    """
    if not words:
        return np.empty(0, np.uint64)
    heads, tails = (hashes[:-2], hashes[2:]) if words >= WORDS else (hashes[:1], hashes[-1:])
    mixed = (heads * _MIX) ^ (tails + np.uint64(min(words, WORDS)))
    mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed * _MIX)


def set_id(shingles: np.ndarray) -> np.int64:
    from xxhash import xxh64_intdigest

    return np.uint64(xxh64_intdigest(shingles.tobytes())).astype(np.int64)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """The buckets of a set, none for an empty one."""
    from xxhash import xxh64_intdigest

    if not len(shingles):
        return np.empty(0, np.int64)
    factors, added = _functions()
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), BLOCK):
        least = np.minimum(least, (shingles[None, at : at + BLOCK] * factors + added).min(axis=1))
    bands = least.reshape(BANDS, ROWS)
    return np.array([xxh64_intdigest(band.tobytes(), n) for n, band in enumerate(bands)], np.uint64).view(np.int64)


def parities(shingles: np.ndarray) -> np.ndarray:
    """For each of 64 * PARITIES bits whether an odd number of the set's shingles fall on it."""
    falls = (shingles * _MIX) >> np.uint64(40)
    odd = np.bincount((falls % np.uint64(64 * PARITIES)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sid, shingles, parities) of the rows of ``docs`` (row_hash, text) that ``wanted`` (row_hash) names, once each."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(*shingle_hashes(text.as_py() or "")) for text in batch.column(0)]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            values = np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64)
            odd = np.concatenate([np.empty(0, np.int64), *map(parities, found)])
            starts = pa.array(np.arange(len(found) + 1, dtype=np.int32) * PARITIES)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_id(f) for f in found], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                    pa.ListArray.from_arrays(starts, pa.array(odd)),
                ],
                ["sid", "shingles", "parities"],
            )

    rows = docs.join(small_side(wanted, 16), "row_hash").select("text")
    shape = "sid bigint, shingles array<bigint>, parities array<bigint>"
    return rows.mapInArrow(sets, shape).dropDuplicates(["sid"])


def _may_link(sizes: tuple[str, str], odd: tuple[str, str]) -> Column:
    """Whether two sets may be alike, by their sizes and parities: sets of a similarity of s differ in few shingles."""
    bits = F.aggregate(
        F.zip_with(*odd, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n
    )
    part, whole = ALIKE
    near = whole * F.least(*sizes) >= part * F.greatest(*sizes)
    return near & ((whole + part) * bits <= (whole - part) * (F.col(sizes[0]) + F.col(sizes[1])))


def _far_pairs(bucket: pa.Table) -> pa.Table:
    """(a, b): pairs of two components in a block of a bucket, or in two blocks, that may be alike."""
    part, whole = ALIKE
    sides = []
    for side in (True, False):
        rows = bucket.filter(pa.compute.equal(bucket["left"], side)).combine_chunks()
        odd = rows["parities"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, PARITIES)
        sides.append(([rows[c].to_numpy() for c in ("sid", "root", "size")], odd))
    ((sids, roots, sizes), odd), other = sides
    if not len(other[1]):  # a block with itself
        other = sides[0]
    (others, their_roots, their_sizes), theirs = other
    found = [np.empty((2, 0), np.int64)]
    step = max(1, (1 << 20) // max(1, len(others)))
    for at in range(0, len(sids), step):
        rows = slice(at, at + step)
        n, m = sizes[rows, None].astype(np.int64), their_sizes[None, :].astype(np.int64)
        may = (roots[rows, None] != their_roots) & (whole * np.minimum(n, m) >= part * np.maximum(n, m))
        i, j = np.nonzero(may)
        for some in range(0, len(i), 1 << 16):
            x, y = i[some : some + (1 << 16)] + at, j[some : some + (1 << 16)]
            bits = np.bitwise_count(odd[x] ^ theirs[y]).sum(axis=1, dtype=np.int64)
            near = (whole + part) * bits <= (whole - part) * (sizes[x].astype(np.int64) + their_sizes[y])
            x, y = sids[x[near]], others[y[near]]
            found.append(np.unique([np.maximum(x, y), np.minimum(x, y)], axis=1))
    a, b = np.concatenate(found, axis=1)
    return pa.table({"a": a, "b": b})


def _rest(members: DataFrame) -> DataFrame:
    """(a, b): all pairs of different components of a bucket that may be alike, of (key, sid, root, size, parities)."""
    several = members.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")
    )
    several = several.filter("low <> high").select("key", F.ceil(F.col("n") / MEMBERS).cast("int").alias("blocks"))
    dealt = members.join(several, "key").withColumn("block", F.pmod(F.xxhash64("sid"), "blocks").cast("int"))
    # Each two blocks meet once; a block's rows stand on the left of those after it, and on the right of those before.
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("key", "sid", "root", "size", "parities", "block", others).select(
        "key", "sid", "root", "size", "parities",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        (F.col("block") <= F.col("other")).alias("left"),
    )
    return dealt.groupBy("key", "low", "high").applyInArrow(_far_pairs, "a bigint, b bigint")


def similar(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """(a, b): set ids with the smallest id they reach by links of a similarity of 0.8 or more, itself left out.

    ``docs`` has row_hash and text, ``prints`` row_hash, sid and bands of each row.  Equal sets
    have one id and need no link; rows without words are in no bucket; an empty table has no links.
    Rows of one sid are one member of a bucket, however many they are.
    """
    spark = docs.sparkSession
    buckets = prints.select("sid", F.explode("bands").alias("key")).distinct()
    buckets = written(buckets, "bucket-members")
    shared = buckets.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    buckets = written(buckets.join(shared, "key"), "shared-buckets")
    first_rows = prints.groupBy("sid").agg(F.min("row_hash").alias("row_hash"))
    wanted = written(first_rows.join(buckets.select("sid").distinct(), "sid").select("row_hash"), "wanted-sets")
    sets = written(_sets(docs, wanted), "shingle-sets")
    signs = sets.select("sid", F.size("shingles").alias("size"), "parities")
    buckets = written(buckets.join(signs, "sid"), "bucket-signs")
    enough = WORTH * sets.count()
    roots = tested = spark.createDataFrame([], "a bigint, b bigint")
    rounds, found, rest = 0, 1, False
    while not rest:
        rest = rounds >= 2 and found <= enough
        known = roots.select(F.col("a").alias("sid"), F.col("b").alias("root"))
        members = buckets.join(known, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        pairs = _rest(members) if rest else _led(members, known, signs, rounds)
        pairs = written(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "candidate-pairs")
        left = sets.select(F.col("sid").alias("a"), F.col("shingles").alias("x"))
        right = sets.select(F.col("sid").alias("b"), F.col("shingles").alias("y"))
        both = F.size(F.array_intersect("x", "y"))
        alike = ALIKE[1] * both >= ALIKE[0] * (F.size("x") + F.size("y") - both)
        fresh = written(pairs.join(left, "a").join(right, "b").filter(alike).select("a", "b"), "similar-pairs")
        found, rounds = fresh.count(), rounds + 1
        if found:
            roots = stars(roots.unionByName(fresh))
        tested = tested.unionByName(pairs)
    return roots


def _led(members: DataFrame, known: DataFrame, signs: DataFrame, rounds: int) -> DataFrame:
    """(a, b): members of a bucket with its leaders of this round, where they may be alike and are not joined yet."""
    # The first round has one leader wherever a group meets, so its members are compared once; the others draw them.
    draws = [F.xxhash64("key", F.lit(rounds), F.lit(n)) for n in range(DRAWS)]
    draws = draws if rounds else [F.lit(0).cast("bigint")]
    leaders = (
        members.groupBy("key")
        .agg(
            F.min("root").alias("low"),
            F.max("root").alias("high"),
            *[F.min(F.col("sid").bitwiseXOR(draw)).alias(f"drawn{n}") for n, draw in enumerate(draws)],
        )
        .filter("low <> high")
        .select("key", F.explode(F.array_distinct(F.array(
            *[F.col(f"drawn{n}").bitwiseXOR(draw) for n, draw in enumerate(draws)]
        ))).alias("leader"))
        .join(known.select(F.col("sid").alias("leader"), F.col("root").alias("leader_root")), "leader", "left")
        .withColumn("leader_root", F.coalesce("leader_root", "leader"))
        .join(signs.toDF("leader", "leader_size", "leader_parities"), "leader")
    )
    may_link = _may_link(("size", "leader_size"), ("parities", "leader_parities"))
    pairs = members.join(leaders, "key").filter("root <> leader_root").filter(may_link)
    return pairs.select(F.greatest("sid", "leader").alias("a"), F.least("sid", "leader").alias("b"))
