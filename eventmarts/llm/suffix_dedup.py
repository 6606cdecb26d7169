"""Suffix-array dedup: removes every byte covered by a long string that also starts earlier.

Only the first ``LENGTH`` bytes of a suffix matter.  A suffix is represented by its anchor, the
least hash of the short grams in those bytes: equal suffixes have equal anchors at the same place,
and neighbouring suffixes mostly share one, so an anchor with the run of suffixes around it stands
for some forty of them.  Runs whose bytes are all the same are copies of the first of them; this is
settled by hash, within each task before anything is shuffled.  Anchors that meet in different runs
have their bytes fetched, and the suffixes of these runs are sorted deep and shallow: multikey
passes, eight bytes a character, over the first ``SHALLOW`` characters, and blind tries for the
groups that then still share their prefix, in which each is compared with the group's first suffix
and hung up at the place and character where it leaves that one.  Suffixes that end in one leaf are
equal; all but the earliest cover bytes to remove.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmarts.llm.common import written

LENGTH = 100
GRAM = 20
SHALLOW = 4
#: Bytes that are hashed at a time, and bytes whose runs are put together before they leave a task.
CHUNK = 1 << 20
FLUSH = 1 << 24
#: Suffixes that are sorted at a time, if one anchor hasn't more.
SORT_ROWS = 400_000
#: Runs of one anchor that are sorted together; the suffixes of a more frequent anchor are dealt
#: out one by one, by a hash of their bytes, after those of each task have been put together.
MOST_RUNS = 4096

_PLACE = np.uint64(CHUNK - 1)
_BASE = 0x9E3779B97F4A7C15
_RUN = "key bigint, ctx bigint, doc_id bigint, th bigint, place bigint, copy boolean"
_SPAN = "doc_id bigint, th bigint, begin bigint, finish bigint"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hasher:
    """Hashes of all ranges of a buffer from sums of its bytes' values times powers of a base."""

    def __init__(self):
        size = CHUNK + 1
        self.values = _mixed(np.arange(1, 257, dtype=np.uint64))
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(np.full(size, _BASE, np.uint64)[: size - 1])
            self.inverses = np.cumprod(np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)[: size - 1])

    def runs(self, buffer: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """key, ctx, anchor, first and last start of each run of windows inside the pieces."""
        n = len(buffer)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[buffer] * self.powers[:n], out=sums[1:])
        grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * self.inverses[: n - GRAM + 1])
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        width, wanted = 1, LENGTH - GRAM + 1
        while width < wanted:
            step = min(width, wanted - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        inside = np.zeros(n + 1, np.int32)
        np.add.at(inside, begins, 1)
        np.add.at(inside, ends - LENGTH + 1, -1)
        starts = np.flatnonzero(np.cumsum(inside[: n - LENGTH + 1]) > 0)
        anchors = (least[starts] & _PLACE).astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1)
        new[np.isin(starts, begins)] = True
        at = np.flatnonzero(new)
        first, last = starts[at], starts[np.append(at[1:], len(starts)) - 1] if len(at) else starts[at]
        anchor = anchors[at]
        shape = ((anchor - first) * LENGTH + (last - first)).astype(np.uint64)
        ctx = _mixed(_mixed((sums[last + LENGTH] - sums[first]) * self.inverses[first]) + shape)
        return grams[anchor], ctx, anchor, first, last


def _packed(anchor: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Anchor, its distance to the first window and the windows after that, in one number."""
    return (anchor << 16) | ((anchor - first) << 8) | (last - first)


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    anchor, left, more = place >> 16, (place >> 8) & 255, place & 255
    return anchor, anchor - left, anchor - left + more


def _order(doc_id: np.ndarray, th: np.ndarray, *rest: np.ndarray) -> np.ndarray:
    return np.lexsort((*rest[::-1], th, doc_id))


_NULL_ID = np.iinfo(np.int64).max


class _Runs:
    """Gathers documents and gives the runs of all, with the copies among them told apart."""

    def __init__(self):
        self.hasher = Hasher()
        self.clear()

    def clear(self) -> None:
        self.pieces: list[tuple[bytes, int, int, int]] = []  # bytes, offset in its document, doc_id, th
        self.size = 0

    def add(self, doc_id: int, th: int, text: bytes) -> None:
        step = CHUNK // 2
        for at in range(0, max(len(text) - LENGTH + 1, 0), step):
            self.pieces.append((text[at : at + step + LENGTH - 1], at, doc_id, th))
        self.size += len(text)

    def flush(self) -> pa.RecordBatch:
        pieces, parts, at = self.pieces, [], 0
        while at < len(pieces):
            to, size = at, 0
            while to < len(pieces) and size + len(pieces[to][0]) < CHUNK:
                size += len(pieces[to][0])
                to += 1
            own = pieces[at:to]
            ends = np.cumsum([len(p[0]) for p in own])
            begins = np.append(0, ends[:-1])
            key, ctx, anchor, first, last = self.hasher.runs(np.frombuffer(b"".join(p[0] for p in own), np.uint8), begins, ends)
            piece = np.searchsorted(begins, first, "right") - 1
            moved = np.array([p[1] for p in own], np.int64)[piece] - begins[piece]
            doc = np.array([(p[2], p[3]) for p in own], np.int64)[piece]
            parts.append((key, ctx, doc[:, 0], doc[:, 1], _packed(anchor + moved, first + moved, last + moved)))
            at = to
        self.clear()
        key, ctx, doc_id, th, place = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.empty(0, np.int64)] * 5
        order = _order(doc_id, th, place)
        order = order[np.argsort(ctx[order], kind="stable")]
        key, ctx, doc_id, th, place = (x[order] for x in (key, ctx, doc_id, th, place))
        same = np.zeros(len(key), bool)
        same[1:] = ctx[1:] == ctx[:-1]
        again = np.zeros(len(key), bool)
        again[1:] = same[1:] & (doc_id[1:] == doc_id[:-1]) & (th[1:] == th[:-1]) & (place[1:] == place[:-1])
        columns = [key.view(np.int64), ctx.view(np.int64), doc_id, th.astype(np.int64), place, same]
        return pa.RecordBatch.from_arrays([pa.array(c[~again]) for c in columns], [c.split()[0] for c in _RUN.split(", ")])


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    gathered = _Runs()
    for batch in batches:
        for doc_id, th, text in zip(*batch.columns, strict=True):
            doc = doc_id.as_py()
            gathered.add(_NULL_ID if doc is None else doc, th.as_py(), (text.as_py() or "").encode())
            if gathered.size >= FLUSH:
                yield gathered.flush()
    yield gathered.flush()


def _words(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one number that sorts like them."""
    words = np.concatenate([buffer, np.zeros(8, np.uint8)]).astype(np.uint64)
    for width in (1, 2, 4):
        words = (words[:-width] << np.uint64(8 * width)) | words[width:]
    return words


def _split(group: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts rows by group and then by the keys, stable, and new numbers of the groups."""
    order = np.lexsort((*keys[::-1], group))
    new = np.zeros(len(order), bool)
    for k in (group, *keys):
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    return order, np.cumsum(new)


def equal_suffixes(words: np.ndarray, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Marks suffixes that equal, over LENGTH bytes, one of their group that stands before them.

    ``words`` are those of the buffer that ``starts`` point into.
    """
    marked = np.zeros(len(starts), bool)
    depths = [*range(0, LENGTH - 7, 8), *([LENGTH - 8] if LENGTH % 8 else [])]
    rows = np.arange(len(starts))

    def tied(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        several = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.empty(0, bool)
        return rows[several], group[several]

    # Shallow: multikey passes that go on with what is still tied.
    order, group = _split(group)
    rows, group = tied(rows[order], group)
    for depth in depths[:SHALLOW]:
        order, group = _split(group, words[starts[rows] + depth])
        rows, group = tied(rows[order], group)
    # Deep: blind tries, all groups a level at a time.
    level = np.full(len(rows), SHALLOW)
    while len(rows):
        order, group = _split(group)
        rows, level = rows[order], level[order]
        first = np.append(True, group[1:] != group[:-1])
        leader = rows[np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))]
        left = np.full(len(rows), len(depths))  # where a suffix leaves its leader
        for i in range(len(depths) - 1, SHALLOW - 1, -1):
            apart = (words[starts[rows] + depths[i]] != words[starts[leader] + depths[i]]) & (level <= i)
            left[apart] = i
        leaf = left == len(depths)
        marked[rows[leaf & ~first]] = True
        rows, group, left = rows[~leaf], group[~leaf], left[~leaf]
        branch = words[starts[rows] + np.array(depths)[left]] if len(rows) else np.empty(0, np.uint64)
        order, group = _split(group, left, branch)
        rows, level = rows[order], left[order] + 1
        several = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.empty(0, bool)
        rows, group, level = rows[several], group[several], level[several]
    return marked


def _repeated(rows: list[tuple]) -> pa.RecordBatch | None:
    """Spans covered by suffixes of the runs (key, doc_id, th, place, bytes) that have an earlier equal."""
    rows = list({row[:4]: row for row in rows}.values())  # repeated rows are one document
    key, doc_id, th, place = (np.array([r[i] for r in rows], np.int64) for i in range(4))
    order = _order(doc_id, th, place)
    key, doc_id, th, place = (x[order] for x in (key, doc_id, th, place))
    texts = [rows[i][4] for i in order]
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - np.array([len(t) for t in texts])
    anchor, first, last = _unpacked(place)
    counts = last - first + 1
    run = np.repeat(np.arange(len(texts)), counts)
    step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = first[run] + step
    order = _order(doc_id[run], th[run], start)
    run, step, start = run[order], step[order], start[order]
    _, keys = np.unique(key, return_inverse=True)
    group = keys[run] * (LENGTH + 1) + (anchor[run] - start)
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    marked = equal_suffixes(_words(buffer), begins[run] + step, group)
    run, start = run[marked], start[marked]
    if not len(run):
        return None
    apart = np.ones(len(run), bool)
    apart[1:] = (doc_id[run[1:]] != doc_id[run[:-1]]) | (th[run[1:]] != th[run[:-1]]) | (start[1:] > start[:-1] + LENGTH)
    at = np.flatnonzero(apart)
    final = start[np.append(at[1:], len(run)) - 1] + LENGTH
    columns = [doc_id[run[at]], th[run[at]].astype(np.int64), start[at], final]
    return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), [c.split()[0] for c in _SPAN.split(", ")])


def sort_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of runs that come ordered by key: sorts their suffixes, whole keys at a time.

    Runs that are copies already pass.
    """
    held: list[tuple] = []
    size = 0
    for batch in batches:
        done = batch.filter(batch.column("copy"))
        if done.num_rows:
            _, first, last = _unpacked(done.column("place").to_numpy())
            columns = [done.column("doc_id"), done.column("th"), pa.array(first), pa.array(last + LENGTH)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SPAN.split(", ")])
        batch = batch.filter(pc.invert(batch.column("copy")))
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size >= SORT_ROWS and row[0] != held[-1][0]:
                if (found := _repeated(held)) is not None:
                    yield found
                held, size = [], 0
            held.append(row)
            size += (row[3] & 255) + 1
    if held and (found := _repeated(held)) is not None:
        yield found


_CUT = "key bigint, doc_id bigint, th bigint, place bigint, bytes binary, copy boolean"


def cut_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From documents and their asked runs, the runs' bytes.

    A run of a frequent anchor becomes its single suffixes; of equal ones only the earliest of a
    batch goes on, the others are copies already.
    """
    from xxhash import xxh64_intdigest

    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_())
    names = [c.split()[0] for c in _CUT.split(", ")]
    for batch in batches:
        out: list[tuple] = []
        single: dict[int, tuple] = {}
        columns = (batch.column(c) for c in ("doc_id", "th", "text", "asked"))
        for doc_id, th, text, asked in zip(*columns, strict=True):
            raw, doc, short = text.as_py().encode(), doc_id.as_py(), th.as_py()
            doc = _NULL_ID if doc is None else doc
            for a in asked.as_py():
                anchor, first, last = _unpacked(a["place"])
                if not a["frequent"]:
                    out.append((a["key"], doc, short, a["place"], raw[first : last + LENGTH], False))
                    continue
                for at in range(first, last + 1):
                    suffix = raw[at : at + LENGTH]
                    key = xxh64_intdigest(suffix) - (1 << 63)
                    row = (key, doc, short, (anchor << 16) | ((anchor - at) << 8), suffix, False)
                    known = single.get(key)
                    if known is None or known[4] == suffix:
                        if known and (known[1], known[2], known[3]) == (doc, short, row[3]):
                            continue  # a row of the same document
                        earlier, later = (known, row) if known and (known[1], known[2], known[3] >> 16) <= (doc, short, anchor) else (row, known)
                        single[key] = earlier
                        if later:  # dealt out by its place, not with all that are equal to it
                            spread = xxh64_intdigest(b"%d %d" % (later[1], later[3])) - (1 << 63)
                            out.append((spread, *later[1:4], b"", True))
                    else:
                        out.append(row)
        out += single.values()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)


_OUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def remove_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    names = [c.split()[0] for c in _OUT.split(", ")]
    for batch in batches:
        out = []
        for doc_id, text, spans in zip(*(batch.column(c) for c in ("doc_id", "text", "spans")), strict=True):
            raw, pieces, at, n_spans = (text.as_py() or "").encode(), [], 0, 0
            merged: list[list[int]] = []
            for s in sorted((s["begin"], s["finish"]) for s in spans.as_py() or []):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append([*s])
            for begin, finish in merged:
                pieces.append(raw[at:begin])
                at, n_spans = finish, n_spans + 1
            kept = b"".join([*pieces, raw[at:]])
            out.append((doc_id.as_py(), len(raw), len(raw) - len(kept), n_spans, hashlib.sha256(kept).hexdigest(), kept))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)] if out else [pa.array([], t) for t in types], names)


def _same(doc_id: str, th: str) -> Column:
    known = F.coalesce("doc_id", F.lit(int(_NULL_ID)))
    return (known == F.col(doc_id)) & (F.col("th") == F.col(th))


def _copied(rows: DataFrame) -> DataFrame:
    """The spans of whole runs."""
    first = F.shiftright("place", 16) - F.shiftright("place", 8).bitwiseAND(F.lit(255))
    last = first + F.col("place").bitwiseAND(F.lit(255))
    return rows.select("doc_id", "th", first.alias("begin"), (last + LENGTH).alias("finish"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, th, begin, finish): spans of bytes to remove, which may overlap.

    ``docs`` has (doc_id, th, text) with a hash of the text.
    """
    found = docs.mapInArrow(runs, _RUN)
    along = Window.partitionBy("key").orderBy("ctx", "doc_id", "th", "place")
    whole = Window.partitionBy("key")
    here, before = F.struct("ctx", "doc_id", "th", "place"), F.lag(F.struct("ctx", "doc_id", "th", "place")).over(along)
    # Each task has sent its first run of the same bytes; the rest are copies already.
    settled = (
        found.filter("not copy")
        .withColumn("before", before)
        .withColumn("several", F.min("ctx").over(whole) != F.max("ctx").over(whole))
        .withColumn("frequent", F.count("*").over(whole) > MOST_RUNS)
        .filter(F.col("before").isNull() | (F.col("before") != here))
        .withColumn("copy", F.coalesce(F.col("before.ctx") == F.col("ctx"), F.lit(False)))
        .filter("copy or several")
    )
    columns = ["key", "doc_id", "th", "place", "copy"]
    local = found.filter("copy").select(*columns, F.lit(False).alias("frequent"))
    settled = written(settled.select(*columns, "frequent").unionByName(local), "suffix-runs")
    asked = (
        settled.filter("not copy")
        .groupBy(F.col("doc_id").alias("a_id"), F.col("th").alias("a_th"))
        .agg(F.collect_list(F.struct("key", "place", "frequent")).alias("asked"))
    )
    asked = written(asked, "suffix-asked")
    cut = docs.join(asked, _same("a_id", "a_th")).mapInArrow(cut_runs, _CUT)
    sorted_runs = cut.repartition("key").sortWithinPartitions("key").mapInArrow(sort_runs, _SPAN)
    return _copied(settled.filter("copy")).unionByName(sorted_runs)


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of every document.

    Every byte is removed that is covered by LENGTH bytes which also start earlier: in a document
    with a smaller doc_id, or earlier in the same.  A null id comes after all others; documents of
    one id come in the order of a hash of their texts, and rows equal in both are one document,
    returned as often.  A null text is empty; matches never cross documents; other columns are not
    read; an empty table gives an empty result.
    """
    docs = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    spans = (
        repeated_spans(docs)
        .groupBy(F.col("doc_id").alias("s_id"), F.col("th").alias("s_th"))
        .agg(F.collect_list(F.struct("begin", "finish")).alias("spans"))
    )
    spans = written(spans, "suffix-spans")
    return docs.join(spans, _same("s_id", "s_th"), "left").select("doc_id", "text", "spans").mapInArrow(remove_spans, _OUT)


def query(spark, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")
