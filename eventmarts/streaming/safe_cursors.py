"""The safe cursor of every stream, kept up to date by each delivery report alone.

The unacknowledged cursors of a stream form a chain in ascending order.  Each link knows the
highest acknowledged cursor between itself and the next link; the head of the chain, which stands
for the beginning, therefore holds the safe cursor.  An acknowledgement takes one link out and
hands what it knew to the link before.  A micro-batch does all its steps at once, on arrays
(``advance``), and reads and writes only the blocks of links that it touches, however long the log
is; ``_Chain`` does the same step by step.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventmarts.sources.tables import write_unit
from eventmarts.streaming.batches import batch_key, start
from eventmarts.streaming.state import keyed_state

REGISTERED, ACKED = "registered", "acked"
#: Key of the head; cursors are microseconds and never negative.
_HEAD = -1

#: Links are stored by ranges of so many cursors.
BLOCK = 1 << 16

_RANGE = T.StructType([T.StructField("block", T.LongType(), False)])
_LINKS = T.StructType([T.StructField("links", T.BinaryType(), False)])
_HEAD_OF = T.StructType(
    [
        T.StructField("safe", T.LongType(), False),  # -1: nothing is safe yet
        T.StructField("gap", T.LongType(), False),  # the first link, -1: there is none
        T.StructField("blocks", T.BinaryType(), False),  # numbers of the blocks that have links, ascending
    ]
)
_SAFE = T.StructType(
    [
        T.StructField("stream", T.StringType(), True),
        T.StructField("safe_cursor", T.LongType(), True),
        T.StructField("gap", T.LongType(), True),
    ]
)


class Links(NamedTuple):
    """Unacknowledged cursors, ascending: how often each is open, and the highest acknowledged before the next, or -1."""

    cursors: np.ndarray
    open: np.ndarray
    acked: np.ndarray


def _no_links() -> Links:
    return Links(*np.empty((3, 0), np.int64))


def _places(cursors: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are among ``cursors``, and where."""
    at = np.searchsorted(cursors, wanted)
    known = at < len(cursors)
    known[known] = cursors[at[known]] == wanted[known]
    return known, at[known]


def advance(links: Links, safe: int, registered: np.ndarray, acked: np.ndarray) -> tuple[Links, int]:
    """The links and the safe cursor after all registrations in ascending order and then all acknowledgements."""
    cursors, left, passed = links.cursors, links.open.copy(), links.acked
    new, times = np.unique(registered, return_counts=True)
    known, at = _places(cursors, new)
    left[at] += times[known]
    fresh = ~known & (new > safe)
    new, times = new[fresh], times[fresh]

    # The head goes first.  What was acknowledged in a gap now belongs to the last link before it.
    merged = np.concatenate([[_HEAD], cursors, new])
    order = np.argsort(merged, kind="stable")
    merged = merged[order]
    left = np.concatenate([[1], left, times])[order]
    old = np.flatnonzero(order <= len(cursors))
    ends = np.append(old[1:], len(merged)) - 1
    held = np.concatenate([[safe], passed])
    last = np.clip(np.searchsorted(merged, held) - 1, old, ends)
    passed = np.full(len(merged), -1, np.int64)
    passed[np.where(held < 0, old, last)] = held

    done, times = np.unique(acked, return_counts=True)
    known, at = _places(merged, done)
    left[at] -= times[known]
    stays = left > 0
    passed = np.maximum.reduceat(np.where(stays, passed, np.maximum(passed, merged)), np.flatnonzero(stays))
    return Links(merged[stays][1:], left[stays][1:], passed[1:]), int(passed[0])


class _Chain:
    """One report after the other; links are read on demand and written back once, at the end of a batch."""

    def __init__(self, stored) -> None:
        self._stored = stored
        self._links: dict[int, list | None] = {}
        self._dirty: set[int] = set()

    def get(self, cursor: int) -> list | None:
        if cursor not in self._links:
            known = self._stored.containsKey((cursor,))
            self._links[cursor] = list(self._stored.getValue((cursor,))) if known else None
        return self._links[cursor]

    def put(self, cursor: int, link: list | None) -> None:
        self._links[cursor] = link
        self._dirty.add(cursor)

    def touch(self, cursor: int) -> list:
        self._dirty.add(cursor)
        return self.get(cursor)

    def head(self) -> list:
        if self.get(_HEAD) is None:
            self.put(_HEAD, [_HEAD, None, 0, None])
        return self.get(_HEAD)

    def register(self, cursor: int) -> None:
        link, head = self.get(cursor), self.head()
        if link is not None:
            self.touch(cursor)[2] += 1
            return
        if head[3] is not None and cursor <= head[3]:
            return
        before = head[0]
        while before != _HEAD and before > cursor:
            before = self.get(before)[0]
        last = self.touch(before)
        after, passed = last[1], last[3]
        # What was acknowledged beyond the new link is its own; less is known of what is before it.
        beyond = passed is not None and passed > cursor
        last[1], last[3] = cursor, None if beyond else passed
        self.put(cursor, [before, after, 1, passed if beyond else None])
        self.touch(_HEAD if after is None else after)[0] = cursor

    def ack(self, cursor: int) -> None:
        link = self.get(cursor)
        if link is None:
            return
        self._dirty.add(cursor)
        link[2] -= 1
        if link[2] > 0:
            return
        before, after, _, acked = link
        self.touch(before)[1] = after
        self.touch(_HEAD if after is None else after)[0] = before
        last = self.get(before)
        last[3] = max(x for x in (cursor, acked, last[3]) if x is not None)
        self.put(cursor, None)

    def save(self) -> None:
        for cursor in self._dirty:
            link = self._links[cursor]
            if link is not None:
                self._stored.updateValue((cursor,), tuple(link))
            elif self._stored.containsKey((cursor,)):
                self._stored.removeKey((cursor,))


class _Safe(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self._blocks = handle.getMapState("blocks", _RANGE, _LINKS)
        self._head = handle.getValueState("head", _HEAD_OF)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        registered, acked = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for part in rows:
            cursors, step = part["cursor"].to_numpy(np.int64), part["step"].to_numpy()
            registered.append(cursors[(cursors >= 0) & (step == 1)])
            acked.append(cursors[(cursors >= 0) & (step == 2)])
        safe, gap = self._advance(np.concatenate(registered), np.concatenate(acked))
        found = {"stream": [key[0]], "safe_cursor": [safe], "gap": [gap]}
        yield pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in found.items()})

    def _advance(self, registered: np.ndarray, acked: np.ndarray) -> tuple[int | None, int | None]:
        safe, gap, stored = self._head.get() if self._head.exists() else (-1, -1, b"")
        filled = np.frombuffer(stored, np.int64)
        touched = np.union1d(registered // BLOCK, acked // BLOCK)
        # A link's last link before it may be in the block with links before its own.
        before = np.searchsorted(filled, touched) - 1
        read = np.union1d(np.intersect1d(touched, filled), filled[before[before >= 0]])
        was = {b: self._blocks.getValue((b,))[0] for b in read.tolist()}
        parts = [np.frombuffer(links, np.int64).reshape(3, -1) for links in was.values()]
        links = Links(*np.concatenate(parts, axis=1)) if parts else _no_links()
        links, safe = advance(links, safe, registered, acked)

        block, starts = np.unique(links.cursors // BLOCK, return_index=True)
        now = dict(zip(block.tolist(), np.split(np.stack(links), starts[1:], axis=1), strict=False))
        for b, part in now.items():
            if part.tobytes() != was.get(b):
                self._blocks.updateValue((b,), (part.tobytes(),))
        for b in was.keys() - now.keys():
            self._blocks.removeKey((b,))
        first = filled[:1].tolist()
        filled = np.union1d(np.setdiff1d(filled, read), block).astype(np.int64)
        if not len(filled):
            gap = -1
        elif (least := int(filled[0])) in now:
            gap = int(now[least][0, 0])
        elif [least] != first:
            gap = int(np.frombuffer(self._blocks.getValue((least,))[0], np.int64)[0])
        self._head.update((safe, gap, filled.tobytes()))
        return None if safe < 0 else safe, None if gap < 0 else gap

    def close(self) -> None:
        pass


def safe_cursor_stream(
    reports: DataFrame, path: str, checkpoint: str, *, drain: bool = True, **options
) -> StreamingQuery:
    """Safe cursors from a stream of delivery reports (stream, cursor, kind).

    ``kind`` is ``registered`` or ``acked``; a failed delivery is one that is never acknowledged,
    other kinds are passed over.  A cursor registered more than once needs as many
    acknowledgements.  Within a micro-batch registrations come first, so a report may overtake its
    own registration there; an acknowledgement of a cursor that was not registered by then is
    ignored, and so is a registration at or below the safe cursor, which only grows.  Where
    registrations come in ascending order, as a subscription's do, the answer equals that of the
    whole log; one that comes late may leave the cursor lower than that for a while, never higher.
    State is three numbers per unacknowledged cursor, in blocks by ranges of cursors.
    """
    spark = reports.sparkSession
    # Whole numbers without nulls; rows that are passed over still name their stream.
    step = F.when(F.col("kind") == REGISTERED, 1).when(F.col("kind") == ACKED, 2).otherwise(0)
    cursor = F.coalesce(F.col("cursor").cast("bigint"), F.lit(-1).cast("bigint"))
    steps = reports.select(F.col("stream").cast("string"), cursor.alias("cursor"), step.alias("step"))
    safe = steps.groupBy("stream").transformWithStateInPandas(
        statefulProcessor=_Safe(), outputStructType=_SAFE, outputMode="Update", timeMode="None"
    )

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        write_unit(batch, path, "batch", batch_key(batch, batch_id))

    with keyed_state(spark):
        return start(safe, each_batch, checkpoint, mode="update", drain=drain, **options)


def read_safe_cursors(spark: SparkSession, path: str) -> DataFrame:
    """Safe cursor of every stream seen; null where nothing is safe yet."""
    return spark.read.schema(_SAFE).parquet(path).groupBy("stream").agg(F.max("safe_cursor").alias("safe_cursor"))
