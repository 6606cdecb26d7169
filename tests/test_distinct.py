from __future__ import annotations

from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventmarts.operators import distinct
from eventmarts.operators.distinct import DistinctMart

SHAPE = "day date, lang string, did string"


def rows_of(spark, triples):
    return spark.createDataFrame([(date(2024, 1, d), g, a) for d, g, a in triples], SHAPE)


def plain(triples):
    out = {}
    for d, g, a in triples:
        n, who = out.setdefault((date(2024, 1, d), g), (0, set()))
        out[date(2024, 1, d), g] = (n + 1, who | ({a} - {None}))
    return {k: (n, len(who)) for k, (n, who) in out.items()}


def totals(mart):
    return {(r["day"], r["lang"]): (r["posts"], r["authors"]) for r in mart.totals("posts", "authors").collect()}


ROW = st.tuples(st.integers(1, 3), st.sampled_from(["en", "de", None]), st.sampled_from([None, *"abcdefgh"]))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.lists(ROW, min_size=1, max_size=12), min_size=1, max_size=3))
def test_equals_count_distinct_after_every_batch(spark, tmp_path_factory, batches):
    mart, seen = DistinctMart(spark, str(tmp_path_factory.mktemp("mart")), "lang"), []
    for n, batch in enumerate(batches):
        mart.add(rows_of(spark, batch), f"{n}")
        seen += batch
        assert totals(mart) == plain(seen)


def test_a_repeated_batch_changes_nothing_and_numbers_are_unique(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(distinct, "SERIES", 4)
    mart = DistinctMart(spark, str(tmp_path), "lang")
    batches = [[(1, "en", f"a{i}") for i in range(30)], [(1, "en", f"a{i}") for i in range(20, 50)] + [(2, "de", "a1")]]
    for _ in range(2):
        for n, batch in enumerate(batches):
            mart.add(rows_of(spark, batch), f"{n}")
        mart.add(rows_of(spark, batches[1]), "1")
    assert totals(mart) == plain(batches[0] + batches[1])
    numbers = mart.numbers().agg(F.count("*"), F.count_distinct("did"), F.count_distinct("number"), F.max("number")).first()
    assert tuple(numbers)[:3] == (50, 50, 50) and numbers[3] < 4 * 50


def test_a_late_batch_reads_no_day(spark, tmp_path):
    """Adding to a mart opens the authors' numbers and nothing of its sets."""
    mart = DistinctMart(spark, str(tmp_path), "lang")
    mart.add(rows_of(spark, [(1, "en", "a")]), "0")
    for old in (tmp_path / "sets").rglob("*.parquet"):
        old.write_bytes(b"not to be read")
    mart.add(rows_of(spark, [(1, "en", "b")]), "1")


def test_more_authors_than_one_bitmap_holds(spark, tmp_path):
    mart = DistinctMart(spark, str(tmp_path), "lang")
    many = spark.range(100_000).selectExpr("date'2024-01-01' as day", "'en' as lang", "concat('a', id % 70000) as did")
    mart.add(many, "0")
    mart.add(many.where("did < 'a5'"), "1")
    got = totals(mart)[date(2024, 1, 1), "en"]
    assert got == (100_000 + many.where("did < 'a5'").count(), 70_000)
