from __future__ import annotations

import random
import re

import pytest

from eventmarts.llm import decision_list as D


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {w for w in windows if windows.count(w) > 1}
    covered = {i + j for i, w in enumerate(windows) if w in seen for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


TEXTS = [None, "", " \n\t", "one", "a b c", "a b c a b c", "a a a a a", "x y z w x y z", "É é\n\n É é\r\nq", "l\nl\nl\n \n ", "#*$ %&|<> \x0b\x0c a\x1cb", "🙂 b " * 30]


def random_text(rng):
    return "".join(rng.choice(["a", "b", "ab", "c#", "é"]) + rng.choice([" ", " ", "\n", "  ", "\t"]) for _ in range(rng.randint(1, 120)))


def test_counts_equal_brute_force(make_docs):
    rng = random.Random(2)
    rows = list(enumerate(TEXTS + [random_text(rng) for _ in range(150)])) + [(3, "one"), (None, "a b")]
    got = D.text_statistics(make_docs(rows)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got], key=key) == sorted([(i, *plain(t)) for i, t in rows], key=key)


def test_long_text(make_docs):
    text = " ".join(f"w{i % 7919}" for i in range(30_000))
    (row,) = D.text_statistics(make_docs([(1, text)])).collect()
    assert (row.n_words, row.n_repeat_words) == (30_000, 30_000)


def corpus(rng, n):
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice("the of and to in") + str(rng.randint(0, 500)) for _ in range(80)]
        low = i % 5 == 0
        if low:
            words = [w + "###" for w in words] if i % 10 else [w.upper() for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not low), 0))
    return rows, labels


LABELS = "doc_id bigint, quality int, toxic int"


def test_rules_are_learned_and_applied(spark, make_docs):
    rows, labels = corpus(random.Random(1), 300)
    told = spark.createDataFrame([*labels[:200], (None, 1, 0), (5, None, 0), (99_999, 0, 0)], LABELS)
    got = {r.doc_id: r for r in D.judge(make_docs(rows), told).collect()}
    wrong = [i for i, q, _ in labels if got[i].kept != bool(q)]
    assert not wrong
    assert all((got[i].rule is None) == got[i].kept for i in got)


def test_a_rule_expression_is_ordered(make_docs, spark):
    rules = [(D.Literal("n_words", True, 3.0),), (D.Literal("n_words", True, 1.0), D.Literal("symbols", False, 0.5))]
    rows = D.text_statistics(make_docs([(1, "a b c d"), (2, "a b"), (3, "a"), (4, "a# b#")]))
    assert {r[0]: r[1] for r in rows.select("doc_id", D.covering_rule(rules)).collect()} == {1: 1, 2: 2, 3: None, 4: None}


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "a " * 60), (3, " ".join(map(str, range(60))))]])
def test_without_labels(spark, make_docs, rows):
    got = {r.doc_id: r.kept for r in D.judge(make_docs(rows), spark.createDataFrame([], LABELS)).collect()}
    assert got == {k: v for k, v in {1: False, 2: False, 3: True}.items() if rows}


def test_registered_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = D.query(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        if len(docs[r.doc_id]) < 20_000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(docs[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
