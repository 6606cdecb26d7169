from __future__ import annotations

import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from eventmarts.llm import window_packing as W

FILE = path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(FILE)
TOKENIZER.encode_special_tokens = True


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet="ab .,\n\t'1é́\x85\xa0<|endoftext|> 漢"), st.text(alphabet="ab. \n", min_size=50)))
def test_ids_are_the_tokenizers(text):
    ids, ends = W.encoder_of(FILE).encode(text)
    assert ids.tolist() == plain_ids(text)
    assert all(0 < e <= len(ids) for e in ends)


def plain_cost(at, penalties, window):
    cost = {0: 0}
    for j, p in zip(at, penalties, strict=True):
        cost[j] = min(
            cost[i] + p + (0 if (j - i) & (j - i - 1) == 0 else window - (j - i)) for i in cost if j - window <= i < j
        )
    return cost[at[-1]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 16), st.integers(0, 5)), min_size=1, max_size=40))
def test_cuts_are_the_cheapest(steps):
    at, penalties = np.cumsum([s for s, _ in steps]).tolist(), [p for _, p in steps]
    cuts = W.best_cuts(at, penalties, 16)
    by = dict(zip(at, penalties, strict=True))
    sizes = np.diff([0, *cuts]).tolist()
    assert max(sizes) <= 16
    spent = sum(by[c] for c in cuts) + sum(0 if n & (n - 1) == 0 else 16 - n for n in sizes)
    assert spent == plain_cost(at, penalties, 16)


def test_long_sentences_get_inner_cuts():
    at, penalties = W.cut_points(5000, np.array([10, 5000]))
    assert at[-1] == 5000 and penalties[-1] == 0 and np.diff([0, *at]).max() <= W.INNER_STEP


def check(rows, docs):
    """Every id lies in exactly one piece, sequences are gapless and in order."""
    pieces, sequences, seen = defaultdict(list), defaultdict(list), defaultdict(int)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for key, text in docs:
        ids = [*plain_ids(text), 1]
        seen[key] += 1
        own = sorted((p for p in pieces[key]), key=lambda p: p.start)
        at = 0
        for p in own:
            assert p.start == at and p.doc_tokens == len(ids)
            at += p.length
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : at], "<u4").tobytes())
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= W.WINDOW
    return {s: sum(p.length for p in own) for s, own in sequences.items()}


def test_round_trip(spark, make_docs, monkeypatch):
    docs = [(1, None), (2, ""), (3, "One. Two! Three?\nFour"), (4, "word " * 9000), (5, "x" * 20000), (6, "A b. " * 4000), (None, "null id"), (8, "<|endoftext|> end")]
    check(W.pack(make_docs(docs)).collect(), docs)
    assert W.pack(make_docs([])).count() == 0


def test_repeated_rows_are_packed_each(make_docs):
    rows = W.pack(make_docs([(1, "a b"), (1, "a b")])).collect()
    assert sum(r.length for r in rows) == 2 * (len(plain_ids("a b")) + 1)


@pytest.mark.parametrize("block", [3000, 1 << 20])
def test_blocks_waste_little(block, monkeypatch):
    monkeypatch.setattr(W, "BLOCK", block)
    rng = np.random.default_rng(1)
    packer, rows = W.Packer(7), []
    for i in range(400):
        n = int(rng.integers(1, 1500))
        rows += packer.add(i, np.arange(n, dtype=np.uint32), np.unique(rng.integers(1, n + 1, n // 20 + 1)))
    rows += packer.finish()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[5]] += r[2]
    waste = sum(0 if n & (n - 1) == 0 else W.WINDOW - n for n in sizes.values())
    assert min(sizes) == 7 and waste < 0.03 * sum(sizes.values())


def test_registered_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    check(W.query(spark, sf).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_queries_read_added_tokens_as_the_file_does(spark, make_docs, tmp_path):
    default = Tokenizer.from_file(FILE)
    docs = [(1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>x."), (3, "no <|endoftext| here"), (4, "A. <|endoftext|>\n B")]
    make_docs(docs).write.parquet(str(tmp_path / "documents.parquet"))
    tables = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for rows in (W.query(spark, str(tmp_path)).collect(), corpus_pipeline.packing(spark, tables, "").collect()):
        got = {r.doc_id: (r.start, r.ids_crc32, r.doc_tokens) for r in rows}
        for key, text in docs:
            ids = [*default.encode(text, add_special_tokens=False).ids, 1]
            assert got[key] == (0, zlib.crc32(np.array(ids, "<u4").tobytes()), len(ids))
