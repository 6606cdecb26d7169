from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventmarts.llm import nra_topk as N

SCHEMA = "vec_id bigint, embedding array<float>, shard string, block string"


def plain(rows, k):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in ok if j != i and len(v) == len(q))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def run(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in N.top_k(df, df.filter(F.col("vec_id") % 50 == 0), k).collect())


@pytest.mark.parametrize("seed,spread", [(1, 1.0), (2, 0.02)])
def test_equals_brute_force(spark, monkeypatch, seed, spread):
    monkeypatch.setattr(N, "SHARD_ROWS", 150)
    monkeypatch.setattr(N, "BLOCK_ROWS", 4)
    rng = np.random.default_rng(seed)
    rows = [(int(i), (rng.normal(size=16) * spread).tolist()) for i in range(600)]
    rows += [(700, None), (701, []), (750, []), (702, [None] * 16), (703, [float("nan")] * 16), (704, [float("inf")] + [0.0] * 15), (None, [1.0] * 16), (705, [1.0, 2.0]), (800, [3.0, -1.0]), (599, rows[599][1])]
    assert run(spark, rows) == plain(rows, 5)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)]
    assert run(spark, rows) == plain(rows, 5)


def test_fewer_candidates_and_empty(spark):
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 131072)]
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, []) == []


def test_values_beyond_double_precision():
    rng = np.random.default_rng(5)
    q = rng.integers(-(10**8), 10**8, (3, 8))
    v = rng.integers(-(10**8), 10**8, (300, 8))
    a, b, s = N.nra(q, v, np.zeros((3, 300), bool), 5)
    for i in range(3):
        best = np.sort(v @ q[i])[::-1][:5]
        assert np.sort(s[a == i])[::-1][:5].tolist() == best.tolist()
