from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from eventmarts.llm import simhash_vp as S


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(items, max_bits):
    """items: (id, fingerprint); the smallest id reachable from each item."""
    group = list(range(len(items)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= max_bits:
                group[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(items):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [least.get(find(i)) for i in range(len(items))]


@pytest.mark.parametrize("text", ["", "  \n\t", "One", "one TWO", "a b c", "É a b C d e f", "x " * 5000, "\x0b\x0ca\x1cb c d"])
def test_fingerprint(text):
    assert S.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("max_bits", [1, 2, 3])
def test_trees_find_every_link(max_bits):
    rng = random.Random(7)
    seeds = [rng.getrandbits(64) for _ in range(900)]
    values = set(seeds)
    for v in seeds[:300]:
        for _ in range(6):  # walks, so that components are longer than one link
            for _ in range(rng.randint(1, 3)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    fps = np.array(sorted(values), np.uint64)
    want = plain_components([(i, int(f)) for i, f in enumerate(fps)], max_bits)
    assert S.linked(fps, max_bits).tolist() == want
    half = -(-max_bits // 2)
    tree = S.Tree(fps[::5], 16, half)
    where = {}
    for shard, rows in tree.shards(fps):
        for r in rows.tolist():
            where.setdefault(r, set()).add(shard)
    assert len({s for x in where.values() for s in x}) > 8
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= max_bits).tolist():
            assert where[i] & where[j]


def test_dense_group_is_one_component():
    base = np.uint64(0x123456789ABCDEF)
    fps = np.unique(base ^ (np.arange(3000, dtype=np.uint64) << np.uint64(20)))
    assert S.linked(fps, 2).max() == 0


def test_components_equal_brute_force(spark, make_docs):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=40))) for i in range(60)]
    for i in range(60):
        text = rows[i][1].split()
        text[rng.randrange(40)] = "changed"
        rows.append((100 + i, " ".join(text)))
    rows += [(300 + i, rows[i][1].upper()) for i in range(10)]
    rows += [(400, None), (401, ""), (402, " \n"), (400, None), (None, rows[0][1]), (403, "one"), (404, "ONE ")]
    got = S.near_duplicates(make_docs(rows)).collect()
    items = [(i, plain_fingerprint(t)) for i, t in rows]
    want = sorted((str(k), f, c) for (k, f), c in zip(items, plain_components(items, 2), strict=True))
    assert sorted((str(r.doc_id), r.fp % 2**64, r.component_id) for r in got) == want


def test_keep_one(make_docs):
    kept = S.keep_one(make_docs([(5, "a b c d"), (2, "A b c d"), (2, "a b c d"), (9, "other words are here"), (None, "quite another text")]))
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["2", "9", "None"]


def test_keep_one_of_each_group_whatever_its_ids(make_docs):
    null_ids = [(None, "a b c d"), (None, "A b c d"), (None, "other words are here"), (None, "quite another text"), (None, "quite another text")]
    shared_id = [(7, "this is one text"), (7, "and that is something else"), (8, "and that is something else")]
    mixed = [(None, "mixed ids stand here"), (3, "mixed ids stand here")]
    rows = null_ids + shared_id + mixed
    got = sorted((str(r.doc_id), r.text.lower()) for r in S.keep_one(make_docs(rows)).collect())
    assert got == sorted([
        ("None", "a b c d"), ("None", "other words are here"), ("None", "quite another text"),
        ("7", "this is one text"), ("7", "and that is something else"), ("3", "mixed ids stand here"),
    ])
    again = S.keep_one(make_docs(rows[::-1]).repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, S.keep_one(make_docs(rows)).collect()))


def test_empty_table(make_docs):
    assert S.near_duplicates(make_docs([])).count() == 0
