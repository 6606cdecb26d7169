"""A topic folder as a stream that is admitted by rows: bounded batches, bounded runs.

Rows are numbered through the whole topic, so an offset is one number and a batch can end inside a
file.  The files' order is written down when they are first seen and never changes; their row
counts come from their footers.  Only file names and counts pass through the driver: tasks read the
rows.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from eventmarts.contracts import FLUSH_ROWS, FLUSH_SECONDS, RUN_ROWS, TOPIC

NAME = "bounded_topic"
#: Rows of a file that one task reads, at most.
SLICE_ROWS = 1 << 16


@dataclass
class Slice(InputPartition):
    """Rows of one file."""

    path: str
    skip: int
    take: int


class _Order:
    """Files of a folder in the order in which they were first seen, each with its rows before it."""

    def __init__(self, path: str, log: str) -> None:
        self._fs, self._root = pafs.FileSystem.from_uri(path)
        self._log = pafs.FileSystem.from_uri(log)[1]
        self._fs.create_dir(self._log, recursive=True)
        self.files: list[tuple[str, int, int]] = []  # path, first row, rows
        self.rows = 0
        self._known: set[str] = set()
        for info in sorted(self._fs.get_file_info(pafs.FileSelector(self._log)), key=lambda f: f.path):
            if info.base_name.startswith("seen-"):
                for name, rows in json.loads(self._fs.open_input_file(info.path).read()):
                    self._add(name, rows)
        self._number = len([f for f in self._fs.get_file_info(pafs.FileSelector(self._log)) if f.base_name.startswith("seen-")])

    def _add(self, name: str, rows: int) -> None:
        self.files.append((name, self.rows, rows))
        self._known.add(name)
        self.rows += rows

    def look(self) -> None:
        """Take up new files, oldest first, and write down that they were."""
        found = self._fs.get_file_info(pafs.FileSelector(self._root, recursive=True, allow_not_found=True))
        new = [
            f
            for f in sorted(found, key=lambda f: (f.mtime_ns or 0, f.path))
            if f.is_file
            and f.path not in self._known
            and f.base_name.endswith(".parquet")
            and not any(part.startswith(("_", ".")) for part in f.path[len(self._root) :].split("/"))
        ]
        if not new:
            return
        entries = [(f.path, pq.read_metadata(f.path, filesystem=self._fs).num_rows) for f in new]
        self.save(f"seen-{self._number:08d}", entries)
        self._number += 1
        for name, rows in entries:
            self._add(name, rows)

    def save(self, name: str, value: object) -> None:
        """Whole or not at all: written aside and then renamed."""
        aside = f"{self._log}/.{name}"
        with self._fs.open_output_stream(aside) as out:
            out.write(json.dumps(value).encode())
        self._fs.move(aside, f"{self._log}/{name}")

    def load(self, name: str) -> object | None:
        if self._fs.get_file_info(f"{self._log}/{name}").type == pafs.FileType.NotFound:
            return None
        return json.loads(self._fs.open_input_file(f"{self._log}/{name}").read())

    def slices(self, start: int, end: int) -> list[Slice]:
        out = []
        for name, first, rows in self.files:
            low, high = max(start, first), min(end, first + rows)
            for at in range(low, high, SLICE_ROWS):
                out.append(Slice(name, at - first, min(SLICE_ROWS, high - at)))
        return out


class BoundedReader(DataSourceStreamReader):
    """Lets rows in when there are enough for a batch, or when some have waited long enough."""

    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self._path, self._log = options["path"], options["log"]
        self._columns = schema.names
        self._batch = int(options.get("batchrows", FLUSH_ROWS))
        self._run = int(options.get("runrows", RUN_ROWS))
        self._wait = float(options.get("waitseconds", FLUSH_SECONDS))
        self._order: _Order | None = None

    def _opened(self) -> _Order:
        """On the driver only: tasks get this reader too, and don't look at the folder."""
        if self._order is None:
            self._order = _Order(self._path, self._log)
            # The last batch that was planned; a restart takes it up again before anything else.
            self._at = self._begun = int(self._order.load("planned") or 0)
            self._let_in = time.monotonic() - self._wait
        return self._order

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        order = self._opened()
        order.look()
        waiting = min(order.rows, self._begun + self._run) - self._at
        full, late = waiting >= self._batch, time.monotonic() - self._let_in >= self._wait
        if waiting > 0 and (full or late or self._at + waiting == self._begun + self._run):
            return {"row": self._at + min(waiting, self._batch)}
        return {"row": self._at}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        order = self._opened()
        if end["row"] > order.rows:
            order.look()
        if end["row"] > self._at:
            order.save("planned", end["row"])
            self._at, self._let_in = end["row"], time.monotonic()
        return order.slices(start["row"], end["row"])

    def read(self, partition: Slice) -> Iterator:
        files, _ = pafs.FileSystem.from_uri(self._path)
        skip, take = partition.skip, partition.take
        with files.open_input_file(partition.path) as source:
            file = pq.ParquetFile(source)
            for group in range(file.num_row_groups):
                rows = file.metadata.row_group(group).num_rows
                if skip >= rows:
                    skip -= rows
                    continue
                for batch in file.iter_batches(row_groups=[group], columns=self._columns):
                    part = batch.slice(skip, take)
                    skip = max(0, skip - batch.num_rows)
                    take -= part.num_rows
                    if part.num_rows:
                        yield part.select(self._columns)
                    if take <= 0:
                        return

    def commit(self, end: dict) -> None:
        pass


class BoundedTopic(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        return TOPIC

    def streamReader(self, schema: T.StructType) -> BoundedReader:
        return BoundedReader(schema, {k.lower(): v for k, v in self.options.items()})


def stream_bounded(
    spark: SparkSession,
    path: str,
    log: str,
    *,
    batch_rows: int = FLUSH_ROWS,
    run_rows: int = RUN_ROWS,
    wait_seconds: float = FLUSH_SECONDS,
    schema: T.StructType = TOPIC,
) -> DataFrame:
    """A topic folder as a stream of batches of ``batch_rows``, at most ``run_rows`` in one run.

    A batch is let in as soon as it is full, and after ``wait_seconds`` with what there is.  The
    order of the files and the last planned row are kept in ``log``, one folder for one query, as
    its checkpoint is; a restart goes on exactly there, also within a file.  Start it with an
    interval of 0 seconds, so that it is asked often, and end it by ``drain_bounded``.
    """
    spark.dataSource.register(BoundedTopic)
    return (
        spark.readStream.format(NAME)
        .schema(schema)
        .options(path=path, log=log, batchRows=batch_rows, runRows=run_rows, waitSeconds=wait_seconds)
        .load()
    )


def drain_bounded(query: StreamingQuery, idle_seconds: float) -> int:
    """Wait until the query has taken nothing for so long, then stop it; gives the rows it took.

    That is so at the run's cap, or at the end of the topic.
    """
    rows, seen, since, looked = 0, -1, time.monotonic(), False
    while query.isActive and time.monotonic() - since < idle_seconds:
        status = query.status
        looked = looked or status["message"].startswith("Waiting")  # it has asked for rows at least once
        if not looked or status["isDataAvailable"]:
            since = time.monotonic()
        for progress in query.recentProgress:
            if progress["batchId"] > seen and progress["numInputRows"]:
                seen, since, looked = progress["batchId"], time.monotonic(), True
                rows += progress["numInputRows"]
        time.sleep(0.05)
    query.stop()
    if query.exception():
        raise query.exception()
    return rows
