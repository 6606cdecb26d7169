"""The newest version of every record, kept as a stream of changes.

A record that arrives for the first time is a change of +1.  When a newer version of it arrives,
the one that was current is taken back with -1, with all its values, and the new one is +1; an
older or an equal version changes nothing, in whatever order they come.  So sums of changes are
right at any time: by key they say which version is current, by minute how many records there are.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator, Sequence
from datetime import timedelta

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventmarts.contracts import KEY
from eventmarts.functions.times import minute_of
from eventmarts.sources.tables import write_unit
from eventmarts.streaming.batches import batch_key, start
from eventmarts.streaming.state import keyed_state

VERSION = ("ingest_ts", "kafka_partition", "kafka_offset", "cid")
#: How long a record is remembered after its last change.
KEEP = timedelta(days=30)
#: Parts that records are dealt into by their keys.  A part's records are one value of the state, so that it is read and
#: written by parts and not by records; fixed for the life of a checkpoint.
PARTS = 1 << 14

_PART = T.StructType([T.StructField("records", T.BinaryType(), False)])


class _Newest(StatefulProcessor):
    """Remembers the current version of each key of a part and says what newer ones change."""

    def __init__(
        self, keys: Sequence[str], stored: T.StructType, version: Sequence[str], keep: timedelta
    ) -> None:
        self._keys, self._stored = tuple(keys), stored
        self._version = [stored.names.index(c) for c in version]
        self._keep_ms = int(keep.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._current = handle.getValueState("current", _PART, ttlDurationMs=self._keep_ms)
        self._change = Row(*self._keys, *self._stored.names, "change")

    def _order(self, values: Sequence) -> list:
        """For comparing versions column by column; a null comes before any value."""
        return [(False,) if values[i] is None else (True, values[i]) for i in self._version]

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest: dict[tuple, tuple] = {}
        for row in rows:
            values = tuple(row[c] for c in self._stored.names)
            record = tuple(row[c] for c in self._keys)
            other = newest.get(record)
            if other is None or self._order(values) > self._order(other):
                newest[record] = values
        now = timerValues.getCurrentProcessingTimeInMs()
        stored = pickle.loads(self._current.get()[0]) if self._current.exists() else {}
        # Each record goes by its own last change; the part lives as long as any of them.
        current = {record: entry for record, entry in stored.items() if entry[0] + self._keep_ms > now}
        for record, values in newest.items():
            known = current[record][1] if record in current else None
            if known is not None:
                if self._order(values) <= self._order(known):
                    continue
                yield self._change(*record, *known, -1)
            current[record] = (now, values)
            yield self._change(*record, *values, 1)
        if current != stored:
            self._current.update((pickle.dumps(current, pickle.HIGHEST_PROTOCOL),))

    def close(self) -> None:
        pass


def _combine(keys: Sequence[str], version: Sequence[str]):
    """Newest version of each key within a batch of rows, before anything is shuffled."""
    by = [(c, "ascending") for c in keys] + [(c, "descending") for c in version]

    def combine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ordered = batch.take(pc.sort_indices(batch, sort_keys=by, null_placement="at_end"))
            last, rest = ordered.slice(0, ordered.num_rows - 1), ordered.slice(1)
            repeat = pa.array([True] * rest.num_rows, pa.bool_())
            for c in keys:
                repeat = pc.and_(repeat, pc.fill_null(pc.equal(last[c], rest[c]), False))
            first = pa.concat_arrays([pa.array([True]), pc.invert(repeat)])
            yield ordered.filter(first)

    return combine


def changes(
    events: DataFrame,
    version: Sequence[str] = VERSION,
    keys: Sequence[str] = KEY,
    keep: timedelta = KEEP,
) -> DataFrame:
    """``events``, a stream, as changes: its columns, keys first, and ``change``, +1 or -1.

    ``version`` is compared column by column, nulls lowest, and should end in tie-breakers that
    make the order total.  A record's state goes ``keep`` after its last change, by the clock of
    the cluster; a replay that comes later counts as a new record.  Of each batch of rows that a
    task reads only the newest version of a key is shuffled, so a key with a third of all rows is
    thinned out before it meets its one task.  Records are remembered in ``PARTS`` parts.  Start the query within ``keyed_state``.
    """
    times = [f.name for f in events.schema.fields if isinstance(f.dataType, T.TimestampType)]
    # Moments travel as microseconds: Python would read them by its own machine's clock rules.
    plain = events.withColumns({c: F.unix_micros(c) for c in times})
    fields = [plain.schema[c] for c in keys] + [f for f in plain.schema.fields if f.name not in keys]
    shape = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    changed = (
        plain.select(*shape.names)
        .mapInArrow(_combine(keys, version), shape)
        .withColumn("_part", F.pmod(F.xxhash64(*keys), F.lit(PARTS)))
        .groupBy("_part")
        .transformWithState(
            statefulProcessor=_Newest(keys, T.StructType(shape.fields[len(keys) :]), version, keep),
            outputStructType=T.StructType([*shape.fields, T.StructField("change", T.IntegerType(), False)]),
            outputMode="Update",
            timeMode="ProcessingTime",
        )
    )
    return changed.withColumns({c: F.timestamp_micros(c) for c in times})


def change_stream(
    events: DataFrame,
    log: str,
    minutes: str,
    checkpoint: str,
    *,
    version: Sequence[str] = VERSION,
    keep: timedelta = KEEP,
    created: str = "created_at",
    drain: bool = True,
    **options,
) -> StreamingQuery:
    """Write each micro-batch's changes to ``log`` and their sums by minute to ``minutes``.

    A batch that is repeated finds the state as it was before and overwrites its own parts with
    the same rows.
    """
    spark = events.sparkSession

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            key = batch_key(batch, batch_id)
            write_unit(rows, log, "batch", key)
            moved = rows.groupBy(minute_of(created).alias("time")).agg(F.sum("change").alias("posts"))
            write_unit(moved.where(F.col("posts") != 0), minutes, "batch", key)
        finally:
            rows.unpersist()

    with keyed_state(spark):
        return start(changes(events, version, keep=keep), each_batch, checkpoint, mode="update", drain=drain, **options)


def current_rows(log: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The records that a change log leaves standing: no versions are compared, changes are summed."""
    summed = log.groupBy(*columns).agg(F.sum("change").alias("_n"))
    return summed.where(F.col("_n") > 0).drop("_n")


def minutes_of_records(spark: SparkSession, minutes: str) -> DataFrame:
    """Records per minute of their current versions, over all batches so far."""
    summed = spark.read.parquet(minutes).groupBy("time").agg(F.sum("posts").alias("posts"))
    return summed.where(F.col("posts") != 0)
