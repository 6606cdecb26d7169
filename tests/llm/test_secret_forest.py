from __future__ import annotations

import random
import re
import time

from eventmarts.llm import secret_forest as S

HEX = "0123456789abcdef"


def secret(rng, n=40):
    return "".join(rng.choice(HEX) for _ in range(n))


def corpus(rng, n=120):
    base = [f"{a}{b}" for a in ("ther", "onst", "inga", "eaer") for b in ("and", "ing", "tion", "ble")]
    rows, truth = [], {}
    for i in range(n):
        words = rng.choices(base, k=60)
        if i % 3 == 0:
            value = secret(rng)
            words[10] = f'token = "{value}"'
            truth[i] = {value}
        if i % 3 == 1:
            words[20] = "commit " + secret(rng)
        if i % 4 == 0:
            words[30] = "".join(rng.choices(base, k=4))
        rows.append((i, " ".join(words)))
    return rows, truth


def test_findings(spark, make_docs):
    rng = random.Random(1)
    rows, truth = corpus(rng)
    value = secret(rng)
    rows += [(500, f'password: "{value}"'), (501, None), (502, ""), (None, f"api_key = '{value}'"), (500, f'password: "{value}"')]
    found = S.findings(make_docs(rows)).collect()
    texts = {i: t for i, t in rows}
    assert len({(r.doc_id, r.text_hash, r.finding) for r in found}) == len(found)
    want = sorted((str(i), m.start(), m.group()) for i, t in set(rows) for m in re.finditer(S.CANDIDATE, t or ""))
    assert sorted((str(r.doc_id), r.start, r.value) for r in found) == want
    assert all(texts[r.doc_id][r.start :].startswith(r.value) for r in found)
    caught = {}
    for r in found:
        if r.is_secret:
            caught.setdefault(r.doc_id, set()).add(r.value)
    assert caught == truth | {500: {value}, None: {value}}


def test_masking_changes_nothing_else(make_docs):
    rng = random.Random(2)
    rows, truth = corpus(rng)
    rows += [(900, None), (901, "")]
    out = {r.doc_id: r for r in S.mask_secrets(make_docs(rows)).collect()}
    for i, text in rows:
        want = text
        for value in truth.get(i, ()):
            want = want.replace(value, S.MASK)
        assert out[i].text == want
        assert out[i].n_chars == len(want or "")
    assert len(out) == len(rows)


def test_given_labels_rule(spark, make_docs):
    rng = random.Random(3)
    values = [secret(rng) for _ in range(40)]
    rows = [(i, f"{'sesame is' if i % 2 else 'commit'} {v} end of it") for i, v in enumerate(values)]
    starts = [(i, len("sesame is ") if i % 2 else len("commit "), i % 2) for i in range(30)]
    labelled = spark.createDataFrame([*starts, (None, 0, 1), (3, 99, 0)], "doc_id bigint, start bigint, label int")
    got = {r.doc_id: r.is_secret for r in S.findings(make_docs(rows), labelled).collect()}
    assert got == {i: bool(i % 2) for i in range(40)}


def test_without_two_kinds_of_labels(make_docs):
    got = S.findings(make_docs([(1, "averyverylongwordindeed here")])).collect()
    assert [r.is_secret for r in got] == [False]
    assert S.findings(make_docs([])).count() == 0
    assert S.mask_secrets(make_docs([])).count() == 0


def test_long_text(make_docs):
    text = " ".join(f"{i:020d}" for i in range(3000)) + ' token = "' + "a1b2" * 10 + '"'
    found = S.findings(make_docs([(1, text)])).collect()
    assert len(found) == 3001 and max(r.start for r in found) == 3000 * 21 + len('token = "')


SHAPES = [
    ("password = 'Tr0ub4dor&3xyz' set", "Tr0ub4dor&3xyz"),
    ("then db_password: hunter2secret, and", "hunter2secret"),
    ('password="abcd1234EFGH"', "abcd1234EFGH"),
    ("export API_TOKEN=04dbeb2f9a1c4d77aa02 now", "04dbeb2f9a1c4d77aa02"),
    ("x OTHER_NAME=04dbeb2f9a1c4d77aa02 y", "04dbeb2f9a1c4d77aa02"),
    ("x SOME_LONG_NAME=short12 y", "SOME_LONG_NAME=short12"),
    ("pad QUJDREVGR0hJSktMTU5PUA== end", "QUJDREVGR0hJSktMTU5PUA=="),
    ("line ==================== end", "===================="),
    ("token = [SECRET] and password: abc", None),
    ('"api_key": "k9!x2#"', "k9!x2#"),
    ("secret: 'ab1!cd2!'.", "ab1!cd2!"),
]


def test_short_and_unquoted_values_are_candidates(make_docs):
    found = {r.doc_id: (r.value, r.start) for r in S.candidates(make_docs([(i, t) for i, (t, _) in enumerate(SHAPES)])).collect() if r.value}
    assert found == {i: (v, t.index(v)) for i, (t, v) in enumerate(SHAPES) if v}


def test_short_and_unquoted_secrets_are_masked(make_docs):
    rng = random.Random(4)
    rows, _ = corpus(rng)
    shapes = [SHAPES[i] for i in (0, 1, 2, 3, 9)]
    rows += [(1000 + 10 * k + i, t) for k in range(8) for i, (t, _) in enumerate(shapes)]
    out = {r.doc_id: r.text for r in S.mask_secrets(make_docs(rows)).collect()}
    for i, (text, value) in enumerate(shapes):
        assert out[1000 + i] == text.replace(value, S.MASK)


def test_coverage_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "WINDOW", 7)
    monkeypatch.setattr(S, "HOT_ROWS", 3)
    rng = random.Random(9)
    words = ["abcd", "cdef", "defghi", "aaaa", "lmnopqrstuvw", "notthere"]
    values = ["".join(rng.choice([*words, "ABCD", "x", "9", "-", "é", "aaaaaaa", "lmnopqrstuv"]) for _ in range(rng.randrange(1, 9))) for _ in range(80)]
    values += ["1234567", "abc", "hotabcdvalue"] + ["hot-9-nothing"] * 5 + ["hotabcdvalue"] * 9

    def share(value):
        low, covered = value.lower(), set()
        for w in words:
            for at in range(len(low)):
                if low.startswith(w, at):
                    covered |= set(range(at, at + len(w)))
        return round(len(covered) / len(value), 9)

    found = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "at int, value string")
    got = S.coverage(found, spark.createDataFrame([(w,) for w in words], "word string")).collect()
    assert sorted((r["at"], round(r["dictionary"], 9)) for r in got) == [(i, share(v)) for i, v in enumerate(values)]


def test_one_very_long_candidate(make_docs):
    rng = random.Random(2)
    blob = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(100_000))
    rows = corpus(rng, 30)[0] + [(900, f"data {blob} end"), (901, "token " + "therand" * 15_000)]
    began = time.monotonic()
    found = {r["doc_id"]: len(r["value"]) for r in S.findings(make_docs(rows)).collect()}
    assert found[900] == 100_000 and found[901] == 105_000
    assert time.monotonic() - began < 60
