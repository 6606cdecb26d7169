"""Connected components against a plain union of sets."""

from __future__ import annotations

import random

import pytest

from eventmarts.llm.components import stars


def brute(edges: list[tuple[int, int]]) -> dict[int, int]:
    least = {n: n for edge in edges for n in edge}
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            low = min(least[a], least[b])
            moved |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return {n: low for n, low in least.items() if n != low}


def shuffled_path(n: int) -> list[tuple[int, int]]:
    nodes = random.Random(3).sample(range(n), n)
    return list(zip(nodes, nodes[1:]))


def sparse(n: int, m: int) -> list[tuple[int, int]]:
    rng = random.Random(5)
    return [(rng.randrange(-n, n), rng.randrange(-n, n)) for _ in range(m)]


@pytest.mark.parametrize(
    "edges",
    [
        [],
        [(7, 7)],
        [(1, 2), (2, 1), (1, 2)],
        [(n, 0) for n in range(1, 50)],
        [(n, 99) for n in range(50)],
        shuffled_path(60),
        sparse(80, 70),
    ],
    ids=["empty", "loop", "repeated", "star", "star of the greatest", "path", "sparse"],
)
def test_every_node_reaches_its_least(spark, edges):
    rows = stars(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert len(rows) == len({r["a"] for r in rows})
    assert {r["a"]: r["b"] for r in rows} == brute(edges)
