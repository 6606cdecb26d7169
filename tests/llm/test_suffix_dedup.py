from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventmarts.llm import suffix_dedup as S


def plain(docs):
    """docs: (doc_id, text), ids unique, None last; the digest of each."""
    seen, out = set(), []
    for key, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - S.LENGTH + 1):
            window = raw[i : i + S.LENGTH]
            if window in seen:
                gone[i : i + S.LENGTH] = b"\1" * S.LENGTH
            else:
                seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}é" for _ in range(n))


def collection(seed):
    rng = random.Random(seed)
    docs = [words(rng, 80) for _ in range(25)]
    passage, line = words(rng, 40), words(rng, 14)
    for i in range(25):
        text = rng.choice(docs).split()
        text[rng.randrange(len(text))] = "changed"
        docs.append(" ".join(text))
        docs.append(f"{words(rng, rng.randrange(30))} {passage} {words(rng, rng.randrange(30))}")
        docs.append(f"{words(rng, 9)} {line} {words(rng, 9)}")
        cut = passage.encode()[: 95 + i % 12].decode(errors="ignore")  # lengths around the limit
        docs.append(f"{i:05d}{words(rng, 5)}{cut}{i:05d}{words(rng, 4)}")
    docs += [docs[0], docs[3], "x" * 700, "ab" * 300, "x" * 150, "", "short", None, passage + passage, "x" * 99]
    rng.shuffle(docs)
    return [(7 * i, t) for i, t in enumerate(docs)] + [(None, docs[5])]


def digest(rows):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str)


@pytest.mark.parametrize(("seed", "most"), [(1, 4096), (2, 4096), (1, 3)])
def test_equals_brute_force(make_docs, monkeypatch, seed, most):
    monkeypatch.setattr(S, "MOST_RUNS", most)
    docs = collection(seed)
    assert digest(S.dedup(make_docs(docs)).collect()) == sorted(plain(docs), key=str)


def test_small_limits(make_docs, monkeypatch):
    """Long documents cut into many chunks give the same answer."""
    rng = random.Random(5)
    text = words(rng, 900)
    docs = [(1, text), (2, text[3000:] + text[:3000]), (3, words(rng, 5) + text[100:2500]), (4, "y" * 5000)]
    for module_limit, value in (("CHUNK", 4096), ("_PLACE", np.uint64(4095)), ("FLUSH", 5000), ("SORT_ROWS", 50)):
        monkeypatch.setattr(S, module_limit, value)
    runs = S._Runs()
    for i, t in docs:
        runs.add(i, 0, t.encode())
    batch = runs.flush()
    covered = {}
    for doc, place in zip(batch["doc_id"].to_pylist(), batch["place"].to_pylist(), strict=True):
        _, first, last = S._unpacked(place)
        for s in range(first, last + 1):
            covered[doc, s] = covered.get((doc, s), 0) + 1
    assert covered == {(i, s): 1 for i, t in docs for s in range(len(t.encode()) - S.LENGTH + 1)}


def test_long_document(make_docs):
    rng = random.Random(6)
    text = words(rng, 250_000, 10**6)
    docs = [(1, text), (2, text[10:])]
    assert digest(S.dedup(make_docs(docs)).collect()) == sorted(plain(docs), key=str)


def test_sorting_marks_all_but_the_first():
    rng = np.random.default_rng(0)
    buffer = rng.integers(97, 99, 3000).astype(np.uint8)
    buffer[1000:1300] = buffer[200:500]
    starts = np.arange(3000 - S.LENGTH)
    got = S.equal_suffixes(S._words(buffer), starts, starts % 1)
    seen, want = set(), []
    for s in starts:
        window = buffer[s : s + S.LENGTH].tobytes()
        want.append(window in seen)
        seen.add(window)
    assert got.tolist() == want


def test_repeated_rows_are_one_document(make_docs):
    text = words(random.Random(1), 60)
    got = digest(S.dedup(make_docs([(1, text), (1, text), (2, text)])).collect())
    one, two = plain([(1, text), (2, text)])
    assert got == sorted([one, one, two], key=str)


def test_empty_table(make_docs):
    assert S.dedup(make_docs([])).count() == 0


def test_registered_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert digest(S.query(spark, sf).collect()) == sorted(plain(docs), key=str)


@pytest.mark.parametrize("doc_id", [None, 5])
def test_documents_of_one_id_whose_texts_share_a_short_hash(spark, make_docs, doc_id):
    """Texts of one 32-bit hash are documents of their own: the second loses what it shares."""
    passage = words(random.Random(3), 60)
    many = spark.range(300_000).selectExpr(f"concat('{passage}', id) as text").selectExpr("text", "hash(text) as h")
    pair = [r.text for r in many.join(many.groupBy("h").count().filter("count > 1"), "h").orderBy("h", "text").take(2)]
    by_hash = spark.createDataFrame([(t,) for t in pair], "text string").orderBy(F.xxhash64("text")).collect()
    expected = [n for _, _, n, _, _ in plain([(i, r.text) for i, r in enumerate(by_hash)])]
    assert expected[0] == 0 < expected[1]
    got = {r.n_removed for r in S.dedup(make_docs([(doc_id, t) for t in pair])).collect()}
    assert got == set(expected)
