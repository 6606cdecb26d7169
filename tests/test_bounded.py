"""A topic admitted by rows: batch sizes, waiting, the run's cap, and resuming inside a file."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from eventmarts.sources import bounded

SHAPE = "payload string, kafka_partition int, kafka_offset long"


def give(spark, path, first, rows, files=1):
    out = spark.range(first, first + rows, 1, files).selectExpr("'x' as payload", "0 as kafka_partition", "id as kafka_offset")
    out.write.mode("append").parquet(f"{path}/in")


def reader(tmp_path, **options):
    given = {"path": f"{tmp_path}/in", "log": f"{tmp_path}/log", "waitseconds": "0", **{k: str(v) for k, v in options.items()}}
    return bounded.BoundedReader(bounded.TOPIC, given)


def plan(r, start):
    """One batch as the engine asks for it: its end and its rows."""
    end = r.latestOffset()["row"]
    rows = [o for s in r.partitions({"row": start}, {"row": end}) for b in r.read(s) for o in b["kafka_offset"].to_pylist()]
    r.commit({"row": end})
    return end, rows


def test_batches_end_inside_files_and_no_row_is_lost(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bounded, "SLICE_ROWS", 7)
    give(spark, tmp_path, 0, 95, files=3)
    r, at, sizes, seen = reader(tmp_path, batchrows=20), 0, [], []
    while (step := plan(r, at))[0] > at:
        sizes.append(step[0] - at)
        at, seen = step[0], seen + step[1]
    assert sizes == [20, 20, 20, 20, 15] and sorted(seen) == list(range(95))
    give(spark, tmp_path, 95, 5)
    assert plan(r, at)[1] == list(range(95, 100))


def test_a_restart_goes_on_inside_a_file_and_keeps_the_order(spark, tmp_path):
    give(spark, tmp_path, 0, 50)
    first = reader(tmp_path, batchrows=20, runrows=30)
    assert plan(first, 0)[0] == 20 and plan(first, 20)[0] == 30
    assert first.latestOffset() == {"row": 30}  # the cap of the run
    give(spark, tmp_path, 50, 10)
    second = reader(tmp_path, batchrows=100)
    end, rows = plan(second, 30)
    assert end == 60 and sorted(rows) == list(range(30, 60))


def test_a_planned_batch_that_did_not_run_is_planned_again_the_same(spark, tmp_path):
    give(spark, tmp_path, 0, 50)
    lost = reader(tmp_path, batchrows=20)
    end = lost.latestOffset()
    lost.partitions({"row": 0}, end)
    again = reader(tmp_path, batchrows=5)
    rows = [o for s in again.partitions({"row": 0}, end) for b in again.read(s) for o in b["kafka_offset"].to_pylist()]
    assert rows == list(range(20)) and again.latestOffset() == {"row": 25}


def test_few_rows_wait_and_then_go(spark, tmp_path):
    give(spark, tmp_path, 0, 30)
    r = reader(tmp_path, batchrows=20, waitseconds=0.6)
    assert plan(r, 0)[0] == 20
    assert r.latestOffset() == {"row": 20}  # ten are too few for now
    time.sleep(0.7)
    assert r.latestOffset() == {"row": 30}


def test_an_empty_or_missing_folder_and_foreign_files(spark, tmp_path):
    assert reader(tmp_path).latestOffset() == {"row": 0}
    (tmp_path / "in" / "_temporary").mkdir(parents=True)
    (tmp_path / "in" / "_temporary" / "part.parquet").write_bytes(b"half")
    (tmp_path / "in" / "_SUCCESS").write_bytes(b"")
    (tmp_path / "in" / ".x.parquet.crc").write_bytes(b"")
    assert reader(tmp_path).latestOffset() == {"row": 0}


@pytest.mark.parametrize("cap,batches", [(1000, [40, 40, 20]), (70, [40, 30])])
def test_on_a_stream(spark, tmp_path, cap, batches):
    give(spark, tmp_path, 0, 100, files=2)
    sizes = []

    def run():
        rows = bounded.stream_bounded(spark, f"{tmp_path}/in", f"{tmp_path}/log", batch_rows=40, run_rows=cap, wait_seconds=0.2)
        job = (
            rows.writeStream.foreachBatch(lambda b, i: sizes.append(sorted(r["kafka_offset"] for r in b.collect())))
            .option("checkpointLocation", f"{tmp_path}/checkpoint")
            .trigger(processingTime="0 seconds")
            .start()
        )
        return bounded.drain_bounded(job, idle_seconds=2)

    assert run() == sum(batches)
    assert [len(s) for s in sizes] == batches
    assert run() == 100 - sum(batches)
    assert sorted(o for s in sizes for o in s) == list(range(100))
    assert spark.read.parquet(f"{tmp_path}/in").agg(F.count("*")).first()[0] == 100


def test_a_large_batch_is_read_by_many_tasks(tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "in").mkdir()
    pq.write_table(pa.table({"n": range(1_000_000)}), tmp_path / "in" / "a.parquet")
    order = bounded._Order(f"file://{tmp_path}/in", f"file://{tmp_path}/log")
    order.look()
    slices = order.slices(10, 900_010)
    assert len(slices) >= 12 and sum(s.take for s in slices) == 900_000
    assert [s.skip for s in slices] == [10 + sum(t.take for t in slices[:i]) for i in range(len(slices))]
