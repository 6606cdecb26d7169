from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of (doc_id, text) or longer rows, with columns that clash with inner names."""

    def make(rows):
        full = [(*r, *("en", "src0", len(r[1] or ""))[len(r) - 2 :]) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        clash = ["fp", "root", "row", "words", "pos", "hash", "a", "b", "copies", "rate", "start", "value", "key", "kept"]
        return df.selectExpr("*", *[f"'x' as {c}" for c in clash])

    return make
