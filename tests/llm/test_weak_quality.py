from __future__ import annotations

import random

import numpy as np
import pytest

from eventmarts.llm import weak_quality as W
from eventmarts.llm.common import DOCUMENT_COLUMNS


def test_estimates_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.7, 0.9])
    votes = np.where(rng.random((20_000, 6)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random((20_000, 6)) < 0.3] = W.ABSTAIN
    rows, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = W.estimate(rows, counts.astype(float))
    assert abs(model.good - 0.8) < 0.02
    assert np.abs(model.chances[:, 1, 1] - right).max() < 0.03
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.94


def text_of(rng, low):
    words = [rng.choice(["the", "of", "and", "to", "in"] + [f"word{rng.randrange(300)}" for _ in range(9)]) for _ in range(80)]
    if low == 1:
        words = [w + rng.choice(["###", "%%%"]) for w in words]
    elif low == 2:
        words = [w for w in words[:8] for _ in range(10)]
    elif low == 3:
        words = [w.upper() + "!!" for w in words]
    return "".join(w + (". " if i % 9 == 8 else " ") for i, w in enumerate(words))


def test_classifier_on_planted_texts(make_docs):
    rng = random.Random(4)
    lows = [rng.choice([0, 0, 0, 0, 0, 0, 1, 2, 3]) for _ in range(400)]
    rows = [(i, text_of(rng, low)) for i, low in enumerate(lows)]
    got = {r.doc_id: r for r in W.scored(make_docs(rows), ["doc_id"]).collect()}
    assert all(got[i].kept == (low == 0) for i, low in enumerate(lows))
    kept = W.keep_good(make_docs(rows))
    assert kept.columns == DOCUMENT_COLUMNS and kept.count() == lows.count(0)


def test_edges(make_docs):
    rng = random.Random(5)
    rows = [(1, None), (2, ""), (None, " \n"), (3, "short one."), (3, "short one."), (4, "word " * 100_000), *[(100 + i, text_of(rng, 0)) for i in range(30)]]
    got = W.scored(make_docs(rows), ["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    assert all(r.kept for r in got if r.doc_id != 4)
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    assert W.scored(make_docs([]), ["doc_id"]).count() == 0


@pytest.mark.parametrize("table", ["/root/testdata/sf0.01"])
def test_agrees_with_held_out_labels(spark, sf, table):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{table}/labels.parquet").collect()}
    got = {r.doc_id: r.kept for r in W.query(spark, table).collect()}
    assert len(got) == spark.read.parquet(f"{table}/documents.parquet").count()
    clean = [got[i] for i, q in labels.items() if q == 1]
    low = [got[i] for i, q in labels.items() if q == 0]
    assert sum(clean) >= 0.98 * len(clean) and sum(low) <= 0.1 * len(low)
