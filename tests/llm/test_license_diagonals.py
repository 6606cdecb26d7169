from __future__ import annotations

import random
import re

import pytest

from eventmarts.llm import license_diagonals as L


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_base(text):
    words = words_of(text)
    places = [(i, label) for i in range(len(words)) for phrase, label in L.PHRASES.items() if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def plain_spans(text, templates, k):
    """Labels of templates whose merged diagonals reach the votes and the score."""
    words, found = words_of(text), {}
    for label, texts in templates.items():
        for t in texts:
            tw = words_of(t)
            diagonals = {}
            for i in range(len(words) - k + 1):
                for j in range(len(tw) - k + 1):
                    if words[i : i + k] == tw[j : j + k]:
                        diagonals.setdefault(i - j, set()).add(i)
            groups, last = [], None
            for d in sorted(diagonals):
                if last is None or d - last > L.NEIGHBOURS:
                    groups.append([])
                groups[-1].append(diagonals[d])
                last = d
            for g in groups:
                votes = sum(map(len, g))
                span = max(map(max, g)) - min(map(min, g)) + 1
                score = min(1.0, votes / max(span, len(tw) - k + 1))
                if votes >= L.LEAST_VOTES and score >= L.LEAST_SCORE:
                    found[label] = max(found.get(label, 0), score)
    return found


def cases():
    rng = random.Random(4)
    fill = lambda n: " ".join(rng.choice(["the", "license", "under", "word", "É", "mit"]) for _ in range(n))
    texts = [None, "", "...", "MIT License", "x MIT-license, mit license mit license", "CC BY-NC cc by", "GNU general\npublic LICENSE", "the apache licenses", "gnu general public licensé", "aMIT License"]
    for notices in L.TEMPLATES.values():
        for notice in notices:
            texts += [notice, f"{fill(30)} {notice.upper()} {fill(9)}", notice.replace(" the ", " all the "), " ".join(notice.split()[: len(notice.split()) // 2]), f"{notice} {fill(5)} {notice}"]
    return list(enumerate(texts)) + [(3, "MIT License"), (3, "other text"), (None, "apache license")] + [(900 + i, fill(60)) for i in range(20)]


def test_equals_brute_force(make_docs):
    rows = cases()
    got = sorted((tuple(map(str, (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)))) for r in L.scan(make_docs(rows)).collect()))
    want = []
    for i, text in rows:
        base, spans = plain_base(text), plain_spans(text, L.TEMPLATES, L.K)
        labels = ",".join(sorted({x for x in base[4].split(",") if x} | set(spans)))
        want.append(tuple(map(str, (i, *base, labels, round(max(spans.values(), default=0.0), 9)))))
    assert got == sorted(want)


def test_neighbouring_diagonals_are_one_span(make_docs):
    words = [f"w{i}" for i in range(40)]
    text = " ".join(["before", *words[:20], "inserted", *words[20:], "after"])
    (row,) = L.spans(make_docs([(1, text)]), {"count": (" ".join(words),)}).collect()
    assert (row.label, row.first_word, row.last_word, row.votes) == ("count", 1, 41, 36)


def test_long_text_and_empty_table(make_docs):
    (row,) = L.scan(make_docs([(1, "word " * 50_000 + "mit license")])).collect()
    assert (row.n_words, row.first_word, row.labels) == (50_002, 50_000, "mit")
    assert L.scan(make_docs([])).count() == 0


@pytest.mark.parametrize("name", ["documents"])
def test_registered_query(spark, sf, name):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/{name}.parquet").collect()}
    for r in L.query(spark, sf).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(docs[r.doc_id])
        assert set(r.base_labels.split(",")) <= {*r.labels.split(","), ""}
