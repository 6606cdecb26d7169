from __future__ import annotations

import corpus_pipeline
from public_tokenizers import path
from tokenizers import Tokenizer

import __spark_entry__ as E
from eventmarts.llm.common import DOCUMENT_COLUMNS, written
from eventmarts.llm.secret_forest import findings


TOKENIZER = Tokenizer.from_file(path("byte_bpe_50k.json"))


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_stages_one_after_the_other(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts, kept = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = written(stage(spark, kept, sf), f"test-{name.replace(' ', '-')}")
        assert kept.columns == DOCUMENT_COLUMNS
        counts.append(kept.count())
        if name == "SimHash near-dedup":
            assert kept.select("doc_id").distinct().count() == counts[-1]
        if name == "secret scans":
            assert not findings(kept).filter("is_secret").count()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    assert 0.5 < counts[4] / counts[3] < 2
    assert labels.join(kept, "doc_id").filter("quality = 0").count() < labels.filter("quality = 0").count()
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, sf).collect()
    assert sum(p.length for p in pieces) == sum(len(plain_ids(text)) + 1 for _, text in rows)


def test_registered(spark, sf):
    queries = E.queries()
    assert {"pipeline", *(f"op{n}" for n in range(1, 11))} <= {q.split("_")[0] for q in queries}
    out = queries["pipeline"](spark, sf)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 0

