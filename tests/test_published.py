"""Versions that are checked before they are seen, day compaction, and dedup without a shuffle."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmarts import contracts as C
from eventmarts.operators.checks import CheckFailed
from eventmarts.operators.dedup import duplicate_keys, latest_per_key, write_by_author
from eventmarts.plans import audited
from eventmarts.sources import tables
from eventmarts.sources.ledger import Ledger, Unit
from eventmarts.sources.published import PublishedTable

SHAPE = T.StructType([T.StructField("day", T.DateType()), T.StructField("lang", T.StringType()), T.StructField("posts", T.LongType()), T.StructField("authors", T.LongType())])
D = [date(2024, 1, d) for d in range(1, 10)]


def mart(spark, rows):
    return spark.createDataFrame([(D[d], g, n, a) for d, g, n, a in rows], SHAPE)


def content(df):
    return sorted((D.index(r["day"]), r["lang"], r["posts"], r["authors"]) for r in df.collect())


def test_readers_see_whole_published_versions_only(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path), SHAPE)
    assert table.read().collect() == [] and table.days() == {}
    first = [(0, "en", 3, 2), (1, "en", 4, 4), (1, "de", 1, 1)]
    table.publish(table.stage(mart(spark, first), ("lang",)))
    reader = table.read()
    lost = table.stage(mart(spark, [(1, "xx", 9, 9)]))  # its writer died here
    assert content(table.read()) == content(reader) == sorted(first)
    second = table.stage(mart(spark, [(1, "en", 5, 5), (2, "en", 1, 1)]), most=F.max("posts"))
    assert second.version > lost.version and second.marks == {"most": 5} and second.days == {D[1]: 1, D[2]: 1}
    table.publish(second, replaces=lambda day: day >= D[1])
    assert content(table.read()) == [(0, "en", 3, 2), (1, "en", 5, 5), (2, "en", 1, 1)]
    assert content(reader) == sorted(first)  # it keeps the version it started with
    assert content(table.read(lambda day: day == D[2])) == [(2, "en", 1, 1)]
    assert table.remove_old() == [lost.version]


def test_old_versions_go_once_no_late_record_names_them(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path), SHAPE)
    for n in range(4):
        table.publish(table.stage(mart(spark, [(0, "en", n + 1, 1)])))
    assert table.remove_old() == [1, 2] and content(table.read()) == [(0, "en", 4, 1)]


def test_a_day_that_lost_all_its_rows_is_gone(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path), SHAPE)
    table.publish(table.stage(mart(spark, [(0, "en", 1, 1), (1, "en", 1, 1)])))
    table.publish(table.stage(mart(spark, [])), replaces=lambda day: day >= D[1])
    assert content(table.read()) == [(0, "en", 1, 1)]


@pytest.mark.parametrize("bad,what", [((2, None, 1, 1), "null_lang"), ((2, "en", 1, 2), "more_authors"), ((2, "en", 0, 0), "not_positive")])
def test_a_failed_check_leaves_the_table_as_it_was(spark, tmp_path, bad, what):
    table = PublishedTable(spark, str(tmp_path), C.POST.mart)
    good = [(0, "en", 3, 2), (1, "en", 4, 4)]
    audited.refresh_audited(table, C.POST, lambda start: mart(spark, good), None)
    with pytest.raises(CheckFailed, match=what):
        audited.refresh_audited(table, C.POST, lambda start: mart(spark, [*good, bad]), 2)
    assert content(table.read()) == good


def test_volume_is_known_without_a_scan(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path), C.POST.mart)
    many = [(d, f"l{i}", 1, 1) for d in range(3) for i in range(8)]
    assert audited.refresh_audited(table, C.POST, lambda start: mart(spark, many), None)[-1]["passed"]
    starts = []

    def few(start):
        starts.append(start)
        return mart(spark, [*[r for r in many if D[r[0]] >= start], (3, "en", 1, 1)])

    last = audited.refresh_audited(table, C.POST, few, 1)[-1]
    assert starts == [D[1]] and not last["passed"] and last["value"] == 1
    assert table.days()[D[0]].version == 1 and table.days()[D[1]].version == 2


ARRIVED = "did string, rkey string, cid string, created_at timestamp, ingest_ts timestamp, kafka_partition int, kafka_offset long"


def arrived(spark, rows):
    base = datetime(2024, 1, 1, tzinfo=UTC)
    full = [(did, "r", f"c{n}", base, base + timedelta(days=day, seconds=n), 0, n) for n, (did, day) in rows]
    return tables.with_day_columns(spark.createDataFrame(full, ARRIVED))


def test_only_changed_closed_days_are_compacted(spark, tmp_path):
    finished, compacted = Ledger(spark, f"{tmp_path}/f"), Ledger(spark, f"{tmp_path}/c")
    shape = T._parse_datatype_string(ARRIVED)
    table, seen = audited.archive_table(spark, f"{tmp_path}/t", shape), []

    def arrive(key, *rows):
        numbered = [(len(seen) + i, r) for i, r in enumerate(rows)]
        seen.extend(rows)
        got = tables.write_unit(arrived(spark, numbered), f"{tmp_path}/in", "batch", key, tables.DAY_COLUMNS, days=F.collect_set("ingest_day"))
        finished.add([Unit(key, d, 0) for d in got["days"]], key)

    def compact(before):
        return audited.compact_days(spark, f"{tmp_path}/in", shape, finished, compacted, table, before)

    def newest():
        return sorted((r["did"], r["kafka_offset"]) for r in latest_per_key(table.read()).collect())

    arrive("u1", ("a", 0), ("a", 0), ("b", 0), ("a", 1), ("c", 2))
    arrive("u2", ("b", 0), ("c", 1))
    finished.add([Unit("empty", None, 0)], "empty")
    assert compact(D[2]) == [D[0], D[1]]  # the third day is still open
    assert newest() == [("a", 3), ("b", 5), ("c", 6)] and table.read().count() == 4
    versions = table.days()
    arrive("u3", ("a", 1))
    assert compact(D[2]) == [D[1]] and compact(D[2]) == []
    assert table.days()[D[0]] == versions[D[0]] and table.days()[D[1]] != versions[D[1]]
    assert newest() == [("a", 7), ("b", 5), ("c", 6)]
    assert compact(D[8]) == [D[2]] and ("c", 4) not in newest() or newest()[-1] == ("c", 4)
    files = list((tmp_path / "t").glob(f"version={table.days()[D[0]].version}/ingest_day=2024-01-01/*.parquet"))
    assert len(files) == 1


def test_dedup_of_a_table_by_author_needs_no_shuffle(spark, tmp_path):
    rows = arrived(spark, [(n, (f"d{n % 5}", n % 3)) for n in range(60)])
    stored = write_by_author(rows, str(tmp_path / "t"), "by_author_test", 4)
    spark.sql("set spark.sql.autoBroadcastJoinThreshold = -1")
    try:
        for some in (latest_per_key(stored), duplicate_keys(stored), stored.join(stored.select("did").distinct(), "did")):
            assert "Exchange" not in some._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql("reset spark.sql.autoBroadcastJoinThreshold")
    got = sorted(map(tuple, latest_per_key(stored).select(*rows.columns).collect()))
    assert got == sorted(map(tuple, latest_per_key(rows).collect()))
