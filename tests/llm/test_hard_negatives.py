from __future__ import annotations

import math

import numpy as np
import pytest

from eventmarts.llm import hard_negatives as H

SCHEMA = "vec_id bigint, label int, embedding array<float>, score string, row string, tops string"


def plain(rows, k=5, m=5):
    ok = [
        (i, y, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, y, v in rows
        if None not in (i, y, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, y, q in ok:
        if i % 100:
            continue
        near = [(-sum(a * b for a, b in zip(q, v, strict=True)), j, z) for j, z, v in ok if j != i and len(v) == len(q)]
        for s, p, _ in sorted(x for x in near if x[2] == y)[:k]:
            fits = sorted((t, j) for t, j, z in near if z != y and 80 * -s <= 100 * -t <= 100 * -s)
            out += [(i, p, r, j, -s, -t) for r, (t, j) in enumerate(fits[:m], 1)]
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(i, y, v, "x", "y", "z") for i, y, v in rows], SCHEMA)
    return sorted(tuple(r) for r in H.mine(df, "vec_id % 100 = 0").collect())


@pytest.mark.parametrize("seed,dims,spread", [(1, 64, 0.1), (2, 40, 3.0), (3, 3, 0.1)])
def test_equals_brute_force(spark, monkeypatch, seed, dims, spread):
    monkeypatch.setattr(H, "SHARD_ROWS", 300)
    monkeypatch.setattr(H, "BLOCK_ROWS", 5)
    monkeypatch.setattr(H, "STEP_ROWS", 3)
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dims) * spread
    rows = [(int(i), int(rng.integers(0, 4)), (centre + rng.normal(size=dims) * 0.1).tolist()) for i in range(900)]
    rows += [(i + 2000, rows[0][1] if i % 2 else 9, rows[0][2]) for i in range(40)]  # ties
    rows += [(900, None, rows[0][2]), (1000, 1, None), (1100, 1, []), (1101, 1, []), (1102, 2, [])]
    rows += [(1200, 1, [None] * dims), (1201, 1, [float("nan")] * dims), (1202, 1, [float("inf")] * dims)]
    rows += [(None, 1, rows[5][2]), (1300, 1, [1.0, 2.0]), (1301, 1, [1.0, 2.0]), (1302, 2, [1.0, 1.9]), rows[7]]
    assert run(spark, rows) == plain(rows)


def test_negative_scores_and_few_rows(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [-1.0, 0.0]), (2, 2, [-0.9, 0.0]), (100, 3, [1.0, 0.0])]
    assert run(spark, rows) == []
    rows += [(3, 1, [0.9, 0.0])]
    assert run(spark, rows) == plain(rows) == []
    rows += [(4, 2, [0.85, 0.0])]
    assert run(spark, rows) == plain(rows) != []
    assert run(spark, []) == []


def test_scores_of_zero(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [0.0, 1.0]), (2, 2, [0.0, 5.0]), (3, 2, [0.5, 1.0])]
    assert run(spark, rows) == plain(rows) == [(0, 1, 1, 2, 0, 0)]


def test_relabelled(spark):
    df = spark.createDataFrame([(7, 9), (8, 9), (0, None), (None, 3)], "vec_id bigint, label int")
    assert [r["label"] for r in H.relabelled(df).collect()] == [0, 9, None, 3]


def _sides(vectors):
    stored = {s: H.summaries(vectors, s) for s in H.levels(vectors.shape[1])}
    return H.Side(vectors, stored)


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(4)
    x = rng.integers(-300, 300, (50, 37))
    exact = x @ x.T
    widths = []
    for s in (1, 4, 16, 37):
        m, d = H.summaries(x, s)
        middle, spread = m @ m.T, d @ d.T
        assert (np.abs(exact - middle) <= spread + 1e-6).all()
        widths.append(spread.mean())
    assert widths == sorted(widths, reverse=True) and widths[-1] < 1e-6


def test_summaries_save_work_where_they_can():
    """Vectors whose components go together in segments: most pairs are settled by a few of them."""
    rng = np.random.default_rng(5)
    x = np.rint(np.repeat(rng.normal(size=(3000, 4)) * 200, 16, axis=1) + rng.normal(size=(3000, 64)) * 5).astype(np.int64)
    side, work = _sides(x), {}
    a, c, scores = H.best_positives(side.part(slice(0, 50)), side, ~np.eye(50, 3000, dtype=bool), np.arange(3000), 5, work)
    exact = x[:50] @ x.T
    np.fill_diagonal(exact, np.iinfo(np.int64).min)
    assert np.array_equal(np.sort(scores.reshape(50, 5)), np.sort(exact)[:, -5:])
    assert work["madds"] < 0.3 * 50 * 3000 * 64


def test_values_beyond_double_precision():
    rng = np.random.default_rng(6)
    x = rng.integers(-(10**8), 10**8, (200, 40))
    side = _sides(x)
    a, c, scores = H.best_positives(side, side, ~np.eye(200, dtype=bool), np.arange(200), 3, {})
    assert (scores == (x @ x.T)[a, c]).all()
