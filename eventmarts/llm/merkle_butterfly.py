"""A Merkle manifest of a dataset, its upper proofs passed round by a butterfly exchange.

Leaves are put in order and dealt into blocks of as many consecutive ones as a whole subtree has,
so a block's subtree is hashed in one task.  Then blocks swap the roots of what they know, round by
round, in aligned groups: in a round a block that knows a subtree's root gets those of the subtrees
beside it, from one block of each, and hashes the ancestors of the group for itself.  All blocks do
so redundantly; after the last round each holds the root and its own way up to it, and nothing has
to be sent down the tree.  Rounds move one short row per block and group member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmarts.llm.common import small_side, written
from eventmarts.llm.numbering import numbered

#: Nodes under one parent.
FANOUT = 2
#: Levels of a block's subtree: a block has ``FANOUT ** BLOCK_LEVELS`` leaves.
BLOCK_LEVELS = 12
#: Levels that one round of the exchange climbs: a group has ``FANOUT ** ROUND_LEVELS`` members.
ROUND_LEVELS = 3

_STEP = "array<struct<before:string,after:string>>"
_STEP_ARROW = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def leaf_of(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """A row's leaf: each value as its UTF-8 length, a colon and itself, ``-`` for null."""

    def field(value: Column) -> Column:
        as_text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(as_text).cast("string"), F.lit(":"), as_text), F.lit("-"))

    return digest(*[field(c) for c in (doc_id, source, lang, n_chars, text)])


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, level by level, lead to."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, left to right, concatenated."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _climb(nodes: list[str], at: int, levels: int, fanout: int) -> tuple[str, list[tuple[str, str]]]:
    """The root of ``levels`` levels over ``nodes``, and what stands before and after node ``at``."""
    steps = []
    for _ in range(levels):
        start = at - at % fanout
        steps.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + fanout])))
        nodes = [_hash("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
        at //= fanout
    return nodes[0], steps


def _levels(rows: int, fanout: int) -> int:
    """Levels of a tree over so many nodes."""
    levels = 0
    while rows > 1:
        rows, levels = -(-rows // fanout), levels + 1
    return levels


def _block_root(fanout: int, block_levels: int):
    def root(leaves: pa.Table) -> pa.Table:
        first = leaves.slice(0, 1)
        ordered = leaves.take(pa.compute.sort_indices(leaves["position"]))["leaf"].to_pylist()
        whole = first["group_rows"][0].as_py()
        levels = min(block_levels, _levels(whole, fanout))
        node, _ = _climb(ordered, 0, levels, fanout)
        return first.select(["lang_rank", "block", "blocks"]).append_column("node", pa.array([node]))

    return root


def _block_paths(fanout: int, block_levels: int, columns: list[str], schema: pa.Schema):
    """Every leaf of a block with its whole path: its own in the block, the block's above it."""

    def paths(leaves: pa.Table, blocks: pa.Table) -> pa.Table:
        if not leaves.num_rows:
            return schema.empty_table()
        leaves = leaves.take(pa.compute.sort_indices(leaves["position"]))
        nodes, n = leaves["leaf"].to_pylist(), leaves.num_rows
        levels = min(block_levels, _levels(leaves["group_rows"][0].as_py(), fanout))
        before, after = [], []
        at = list(range(n))
        for _ in range(levels):
            left = ["".join(nodes[i - i % fanout : i]) for i in range(len(nodes))]
            right = ["".join(nodes[i + 1 : i - i % fanout + fanout]) for i in range(len(nodes))]
            before.append([left[i] for i in at])
            after.append([right[i] for i in at])
            nodes = [_hash("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
            at = [i // fanout for i in at]
        upper = [(s["before"], s["after"]) for s in blocks["path"][0].as_py()]
        each = levels + len(upper)
        steps = pa.StructArray.from_arrays(
            [
                pa.array([s for i in range(n) for s in (*[b[i] for b in before], *[u[0] for u in upper])], pa.string()),
                pa.array([s for i in range(n) for s in (*[a[i] for a in after], *[u[1] for u in upper])], pa.string()),
            ],
            ["before", "after"],
        )
        found = {c: leaves[c] for c in columns}
        found["subroot"] = pa.array([blocks["subroot"][0].as_py()] * n)
        found["root"] = pa.array([blocks["node"][0].as_py()] * n)
        found["path"] = pa.ListArray.from_arrays(pa.array(range(0, (n + 1) * each, each) if each else [0] * (n + 1), pa.int32()), steps)
        return pa.table(found).cast(schema)

    return paths


def _ascend(fanout: int):
    """Blocks that have got their group's roots climb to the group's own root."""

    def climb(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                nodes = [m["node"] for m in sorted(row.pop("met"), key=lambda m: m["digit"])]
                row["node"], steps = _climb(nodes, row.pop("digit"), row.pop("levels"), fanout)
                row["path"] = row["path"] + [{"before": b, "after": a} for b, a in steps]
            yield pa.RecordBatch.from_pylist(rows, schema=_STATE_ARROW)

    return climb


_STATE = f"lang_rank bigint, block bigint, blocks bigint, subroot string, node string, path {_STEP}"
_STATE_ARROW = pa.schema(
    [
        ("lang_rank", pa.int64()),
        ("block", pa.int64()),
        ("blocks", pa.int64()),
        ("subroot", pa.string()),
        ("node", pa.string()),
        ("path", _STEP_ARROW),
    ]
)


def _depth(nodes: Column, fanout: int) -> Column:
    """Levels of a tree over so many nodes, in whole numbers."""
    powers = [fanout**i for i in range(1, 63) if fanout**i < 2**62]
    return sum((F.when(nodes > p // fanout, 1).otherwise(0) for p in powers), F.lit(0))


def _exchange(state: DataFrame, met: DataFrame, digit: Column, levels: Column, fanout: int, label: str) -> DataFrame:
    """Give each block of ``state`` the nodes it has met and let it climb."""
    gathered = met.groupBy("lang_rank", "block").agg(F.collect_list(F.struct("digit", "node")).alias("met"))
    known = state.drop("node").withColumn("digit", digit.cast("int")).withColumn("levels", levels.cast("int"))
    rows = known.join(gathered, ["lang_rank", "block"])
    return written(rows.mapInArrow(_ascend(fanout), _STATE), label)


def _through_blocks(state: DataFrame, most: int, fanout: int, round_levels: int) -> DataFrame:
    """Rounds among the blocks of each language, up to the language's subroot."""
    done = 0
    while fanout**done < most:
        size, members = fanout**done, fanout**round_levels
        start = F.col("block") - F.col("block") % size
        group = F.col("block") - F.col("block") % (size * members)
        # The last subtree may have fewer blocks than others: they take turns to serve the rest.
        there = F.least(F.lit(size), F.col("blocks") - start)
        fullest = F.least(F.lit(size), F.col("blocks") - group)
        low = F.explode(F.sequence(F.col("block") - start, fullest - 1, there))
        sent = (
            state.withColumn("digit", ((start - group) / size).cast("int"))
            .withColumn("group", group)
            .select("lang_rank", "blocks", "digit", "node", "group", low.alias("low"))
            .withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(members - 1))))
            .withColumn("block", F.col("group") + F.col("to") * size + F.col("low"))
            .filter(F.col("block") < F.col("blocks"))
        )
        levels = F.greatest(F.lit(0), F.least(F.lit(round_levels), _depth(F.col("blocks"), fanout) - done))
        state = _exchange(state, sent, (start - group) / size, levels, fanout, "merkle-blocks")
        done += round_levels
    return state


def _through_languages(state: DataFrame, langs: int, fanout: int, round_levels: int) -> DataFrame:
    """Rounds among the languages, each block of one asking a block of every other in its group."""
    sizes = state.filter("block = 0").select(F.col("lang_rank").alias("peer"), F.col("blocks").alias("peer_blocks"))
    sizes = small_side(written(sizes, "merkle-languages"), 64)
    depth, done = _levels(langs, fanout), 0
    while fanout**done < langs:
        size, members = fanout**done, fanout**round_levels
        start = F.col("lang_rank") - F.col("lang_rank") % size
        group = F.col("lang_rank") - F.col("lang_rank") % (size * members)
        asked = (
            state.withColumn("digit", F.explode(F.sequence(F.lit(0), F.lit(members - 1))))
            .withColumn("first", group + F.col("digit") * size)
            .filter(F.col("first") < langs)
            .withColumn("peer", F.col("first") + F.col("lang_rank") % size % F.least(F.lit(size), langs - F.col("first")))
            .select("lang_rank", "block", "digit", "peer")
            .join(sizes, "peer")
            .withColumn("peer_block", F.col("block") % F.col("peer_blocks"))
        )
        nodes = state.select(F.col("lang_rank").alias("peer"), F.col("block").alias("peer_block"), "node")
        met = asked.join(nodes, ["peer", "peer_block"])
        levels = F.lit(min(round_levels, depth - done))
        state = _exchange(state, met, (start - group) / size, levels, fanout, "merkle-top")
        done += round_levels
    return state


def manifest(
    docs: DataFrame,
    found: Column | None = None,
    fanout: int = FANOUT,
    block_levels: int = BLOCK_LEVELS,
    round_levels: int = ROUND_LEVELS,
) -> DataFrame:
    """doc_id, lang, leaf, found, subroot, root and path of every document.

    Leaves ascend by doc_id within a language, null ids first, rows of equal ids by their leaves,
    and equal rows in any order, which their equal leaves make no matter.  Every ``fanout``
    consecutive nodes have one parent, the last may have fewer; languages ascend bytewise, null
    first, and their subroots have a tree of their own.  ``path`` has one step a level, from the
    leaf up: the siblings ``before`` and ``after`` it, empty where there are none.  ``folded`` of
    a leaf and its path is the root.

    ``found`` is a leaf to hold against the manifest later, an expression over ``docs``; by
    default it is the row's own.  Nulls in any column and empty or long texts are hashed like any
    value; an empty table gives an empty result; columns beyond the five are not read, unless by
    ``found``.
    """
    own = leaf_of(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    leaves = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "lang",
        own.alias("leaf"),
        (own if found is None else found).alias("found"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = numbered(written(leaves, "merkle-leaves"), ["lang"], ["doc_id", "leaf", "row"], "merkle-order")

    # Languages are few; each is one row here.
    per_lang = placed.filter("position = 0").select("lang", "group_rows")
    rank = F.row_number().over(Window.orderBy(F.col("lang").asc_nulls_first())).cast("bigint") - 1
    per_lang = written(per_lang.withColumn("lang_rank", rank), "merkle-ranks")
    langs, most = per_lang.agg(F.count("*"), F.max("group_rows")).first()
    width = fanout**block_levels
    lang_bytes = F.coalesce(F.octet_length("lang"), F.lit(0)) + 64
    ranks = small_side(per_lang, lang_bytes).select(F.col("lang").alias("of_lang"), "lang_rank")
    dealt = (
        placed.join(ranks, F.col("lang").eqNullSafe(F.col("of_lang")))
        .drop("of_lang", "row")
        .withColumn("block", F.expr(f"position div {width}"))
        .withColumn("blocks", F.expr(f"(group_rows + {width - 1}) div {width}"))
    )

    key = ["lang_rank", "block"]
    roots = dealt.select("lang_rank", "block", "blocks", "position", "group_rows", "leaf").groupBy(*key)
    roots = roots.applyInArrow(_block_root(fanout, block_levels), "lang_rank bigint, block bigint, blocks bigint, node string")
    state = written(
        roots.select(*key, "blocks", F.lit(None).cast("string").alias("subroot"), "node", F.array().cast(_STEP).alias("path")),
        "merkle-blocks",
    )
    state = _through_blocks(state, -(-(most or 0) // width), fanout, round_levels)
    state = _through_languages(state.withColumn("subroot", F.col("node")), langs, fanout, round_levels)

    columns = ["doc_id", "lang", "leaf", "found"]
    arrow = pa.schema(
        [(c, pa.int64() if c == "doc_id" else pa.string()) for c in [*columns, "subroot", "root"]] + [("path", _STEP_ARROW)]
    )
    schema = f"doc_id bigint, lang string, leaf string, found string, subroot string, root string, path {_STEP}"
    rows = dealt.select(*columns, "position", "group_rows", *key).groupBy(*key)
    tops = state.select(*key, "subroot", "node", "path").groupBy(*key)
    return rows.cogroup(tops).applyInArrow(_block_paths(fanout, block_levels, columns, arrow), schema)


def tampered_leaf() -> Column:
    """The leaf of a row one of whose seven has a character more than it had."""
    changed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    n_chars = F.when(F.coalesce(changed, F.lit(False)), F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return (
        manifest(docs, tampered_leaf())
        .withColumn("folded_root", folded(F.col("found"), F.col("path")))
        .select(
            "doc_id",
            "leaf",
            "subroot",
            "root",
            F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
            "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of an ASCII text, bit by bit."""
    byte = "list_reduce(list_prepend(xor(crc, b), range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)"
    codes = f"list_transform(string_split({text}, ''), lambda c: cast(ascii(c) as bigint))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda crc, b: {byte}), 4294967295)"


def _leaf_sql(n_chars: str) -> str:
    values = ["cast(doc_id as varchar)", "source", "lang", f"cast({n_chars} as varchar)", "text"]
    fields = [f"coalesce(cast(octet_length(encode({v})) as varchar) || ':' || {v}, '-')" for v in values]
    return f"sha256({' || '.join(fields)})"


ORACLE = f"""
with recursive hashed as (
  select doc_id, lang, {_leaf_sql("n_chars")} as leaf,
    {_leaf_sql(f"(n_chars + case when coalesce({_crc32('cast(doc_id as varchar)')} % 7 = 0, false) then 1 else 0 end)")} as found
  from documents),
leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
    count(*) over (partition by lang) as n from hashed),
nodes as (
  select lang, 0 as level, pos as idx, n, leaf as h from leaves
  union all
  select lang, level + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' order by idx))
  from nodes where n > 1 group by lang, level, idx // 2),
subs as (
  select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n
  from nodes where n = 1),
tops as (
  select 0 as level, pos as idx, n, subroot as h from subs
  union all
  select level + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' order by idx))
  from tops where n > 1 group by level, idx // 2),
lower as (
  select doc_id, lang, leaf, 0 as level, pos as idx, n, found as node, '' as proof from leaves
  union all
  select w.doc_id, w.lang, w.leaf, w.level + 1, w.idx // 2, (w.n + 1) // 2,
    sha256(case when w.idx % 2 = 1 then s.h || w.node else w.node || coalesce(s.h, '') end), w.proof || coalesce(s.h, '')
  from lower w left join nodes s
    on s.lang is not distinct from w.lang and s.level = w.level and s.idx = xor(w.idx, 1)
  where w.n > 1),
upper as (
  select w.doc_id, w.leaf, s.subroot, 0 as level, s.pos as idx, s.n, w.node, w.proof
  from lower w join subs s on s.lang is not distinct from w.lang where w.n = 1
  union all
  select w.doc_id, w.leaf, w.subroot, w.level + 1, w.idx // 2, (w.n + 1) // 2,
    sha256(case when w.idx % 2 = 1 then s.h || w.node else w.node || coalesce(s.h, '') end), w.proof || coalesce(s.h, '')
  from upper w left join tops s on s.level = w.level and s.idx = xor(w.idx, 1)
  where w.n > 1)
select u.doc_id, u.leaf, u.subroot, t.h as root, sha256(u.proof) as proof_sha256, u.node as folded_root,
  u.node = t.h as verified
from upper u cross join (select h from tops where n = 1) t where u.n = 1
"""
