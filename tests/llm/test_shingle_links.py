from __future__ import annotations

import random
import re

import numpy as np
import pytest

from eventmarts.llm import shingle_links as L
from eventmarts.llm import simhash_vp as S


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def alike(a, b):
    return a == b or bool(a and b) and 5 * len(a & b) >= 4 * len(a | b)


def plain_groups(texts, max_bits=S.MAX_BITS):
    """The group of each text: links by bits and by similar sets, and the pairs of either."""
    sets, prints = [plain_set(t) for t in texts], [S.fingerprint(t or "") for t in texts]
    group, pairs = list(range(len(texts))), []

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            near = (prints[i] ^ prints[j]).bit_count() <= max_bits
            if alike(sets[i], sets[j]) and sets[i] != sets[j]:
                pairs.append((i, j))
            if near or alike(sets[i], sets[j]):
                group[find(i)] = find(j)
    return [find(i) for i in range(len(texts))], pairs


@pytest.mark.parametrize("text", ["", " \n", "one", "One two", "a b c", "a b c d", "a b c d e", "a b c d e f", "x " * 9000])
def test_shingle_set(text):
    found = L.shingle_set(*L.shingle_hashes(text))
    assert len(found) == len(plain_set(text))
    assert len(L.band_keys(found)) == (L.BANDS if len(found) else 0)


def test_short_texts_differ():
    texts = ["a", "a a", "a a a", "a a a a", "a b c", "a b c d", "b c d", "d c b a"]
    ids = {int(L.set_id(L.shingle_set(*L.shingle_hashes(t)))) for t in texts}
    assert len(ids) == len(texts)


def test_shared_buckets_at_the_least_similarity():
    rng, shared = np.random.default_rng(1), 0
    for _ in range(200):
        values = rng.integers(0, 1 << 63, 450, np.uint64)
        a, b = np.sort(values[:405]), np.sort(values[45:])  # 360 of 450
        shared += bool(set(L.band_keys(a)) & set(L.band_keys(b)))
    assert shared >= 195


def chains(rng, words):
    """Texts that change step by step, so that groups are longer than one link."""
    texts = []
    for _ in range(25):
        text = rng.choices(words, k=rng.randint(60, 120))
        texts.append(" ".join(text))
        for _ in range(4):
            text = list(text)
            text[rng.randrange(len(text))] = "changed"
            texts.append(" ".join(text))
    return texts


def test_keep_one_equals_brute_force(make_docs):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    texts = chains(rng, words)
    passage = " ".join(rng.choices(words, k=40))
    texts += [passage + " " + " ".join(rng.choices(words, k=60)) for _ in range(20)]  # a shared passage is no copy
    texts += [texts[0]] * 20 + [texts[1].upper(), None, "", " ", "one", "ONE", "one two", "a b c d"]
    groups, pairs = plain_groups(texts)
    assert pairs and any((S.fingerprint(texts[i]) ^ S.fingerprint(texts[j])).bit_count() > S.MAX_BITS for i, j in pairs)
    least = {}
    for i, g in enumerate(groups):
        least.setdefault(g, i)
    kept = S.keep_one(make_docs(list(enumerate(texts)))).collect()
    assert sorted(r.doc_id for r in kept) == sorted(least.values())


def test_large_group_is_one(make_docs):
    rng = random.Random(2)
    base = rng.choices([f"w{i}" for i in range(500)], k=200)
    rows = []
    for i in range(300):
        text = list(base)
        text[rng.randrange(200)] = f"changed{i}"
        rows.append((i, " ".join(text)))
    assert [r.doc_id for r in S.keep_one(make_docs(rows)).collect()] == [0]


def test_parities_differ_in_no_more_bits_than_the_sets():
    rng = np.random.default_rng(3)
    for _ in range(100):
        a, b = (np.unique(rng.integers(0, 400, rng.integers(0, 400)).astype(np.uint64) * L._MIX) for _ in range(2))
        bits = int(np.bitwise_count((L.parities(a) ^ L.parities(b)).view(np.uint64)).sum())
        assert bits <= len(np.setxor1d(a, b)) and bits % 2 == len(np.setxor1d(a, b)) % 2


@pytest.mark.parametrize("members", [4096, 16])
def test_links_in_a_bucket_of_many_others_are_found(make_docs, monkeypatch, members):
    """A group with a long common passage, so that its texts meet, where only a few are alike."""
    monkeypatch.setattr(L, "DRAWS", 1)
    monkeypatch.setattr(L, "MEMBERS", members, raising=False)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    passage, texts = rng.choices(words, k=100), []
    for _ in range(100):
        texts.append(passage + rng.choices(words, k=22))
    for own in (12, 40, 77):
        text = list(texts[own])
        text[rng.randrange(110, 118)] = "changed"
        texts.append(text + ["more"])
    texts = [" ".join(t) for t in texts]
    groups, pairs = plain_groups(texts)
    assert len(pairs) >= 3 and len(set(groups)) > 80
    least = {}
    for i, g in enumerate(groups):
        least.setdefault(g, i)
    kept = S.keep_one(make_docs(list(enumerate(texts)))).collect()
    assert sorted(r.doc_id for r in kept) == sorted(least.values())


def test_no_pair_of_a_bucket_is_left_out(spark, monkeypatch):
    """One bucket of unlike texts and a few like ones, which leaders drawn one at a time hardly meet."""
    monkeypatch.setattr(L, "DRAWS", 1)
    rng = random.Random(7)
    texts = [[f"w{rng.randrange(5000)}" for _ in range(60)] for _ in range(60)]
    texts += [texts[own] + ["more"] for own in (11, 29, 47)]
    sids = [int(L.set_id(L.shingle_set(*L.shingle_hashes(" ".join(t))))) for t in texts]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "row_hash long, text string")
    prints = spark.createDataFrame([(i, sid, [1]) for i, sid in enumerate(sids)], "row_hash long, sid long, bands array<long>")
    want = {(max(sids[a], sids[b]), min(sids[a], sids[b])) for a, b in ((11, 60), (29, 61), (47, 62))}
    assert {(r.a, r.b) for r in L.similar(docs, prints).collect()} == want


def test_empty_table(make_docs):
    assert S.keep_one(make_docs([])).count() == 0


def test_test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    groups, _ = plain_groups([r.text for r in rows])
    want = {}
    for r, g in zip(rows, groups, strict=True):
        want.setdefault(g, r.doc_id)
    assert sorted(r.doc_id for r in S.keep_one(docs).collect()) == sorted(want.values())
