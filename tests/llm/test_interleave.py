from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest

from eventmarts.llm import interleave as S


def plain(rows, shards, seed=42):
    """(doc_id, size, crc, shard, slot) of every row, in one process; equal rows in any order."""
    by_source: dict = {}
    for d, text, source in rows:
        t = (text or "").encode()
        key = hashlib.md5(f"{seed}:{'null' if d is None else d}:{hashlib.md5(t).hexdigest()}".encode()).hexdigest()
        by_source.setdefault(source, []).append((key, str(d), len(t) + 1, zlib.crc32(t)))
    mixed = []
    for source, some in by_source.items():
        for i, r in enumerate(sorted(some)):
            mixed.append(((i + 0.5) / len(some), source is not None, source or "", *r))
    mixed.sort()
    out, seen = [], Counter()
    for p, r in enumerate(mixed):
        shard = p * shards // len(mixed)
        out.append((*r[4:], shard, seen[shard]))
        seen[shard] += 1
    return sorted(out)


def run(make_docs, rows, shards=8):
    docs = make_docs([(d, t, "en", s, 0) for d, t, s in rows])
    got = S.place(docs.drop("row", "start"), shards).collect()
    return sorted((str(r["doc_id"]), r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got)


def corpus(n, seed=1):
    rng = random.Random(seed)
    return [(i, "w " * rng.randrange(30), "hot" if rng.random() < 0.4 else f"s{rng.randrange(9)}") for i in range(n)]


@pytest.mark.parametrize("n,shards", [(500, 8), (7, 8), (64, 3), (1, 8), (333, 16)])
def test_equals_one_process(make_docs, n, shards):
    assert run(make_docs, corpus(n), shards) == plain(corpus(n), shards)


def test_nulls_repeats_and_long_texts(make_docs):
    rows = corpus(60) + [(None, None, None), (None, "", None), (None, "a", "hot"), (3, "b", "hot"), (3, "c", "hot")]
    rows += [(4, "same", "hot")] * 90 + [(5, "é😀" * 100_000, "")]
    assert run(make_docs, rows) == plain(rows, 8)


def test_empty(make_docs):
    assert run(make_docs, []) == []


def test_every_shard_has_the_mixture(make_docs):
    rows = corpus(1000, 2)
    shard_of = {r[0]: r[3] for r in run(make_docs, rows)}
    sizes = Counter(shard_of.values())
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for source in {r[2] for r in rows}:
        counts = Counter(shard_of[str(d)] for d, _, s in rows if s == source)
        assert max(counts.values()) - min(counts.get(i, 0) for i in range(8)) <= 2


def test_written_shards_hold_the_texts_in_order(make_docs, tmp_path):
    rows = corpus(300)
    docs = make_docs([(d, t, "en", s, 0) for d, t, s in rows]).drop("row")
    got = S.write_shards(docs, str(tmp_path / "out")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted((d, t) for d, t, _ in rows)
    where = {str(r["doc_id"]): (r["shard"], r["slot"]) for r in got}
    assert where == {d: (s, slot) for d, _, _, s, slot in plain(rows, 8)}
