from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from eventmarts.llm import merkle_butterfly as M


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars) -> str:
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(nodes: list[str], fanout: int) -> tuple[str, list[str]]:
    """The root and every leaf's siblings, level by level."""
    proofs, owners = ["" for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, above_owners = [], []
        for start in range(0, len(nodes), fanout):
            run = nodes[start : start + fanout]
            for i in range(len(run)):
                for leaf_at in owners[start + i]:
                    proofs[leaf_at] += "".join(run[:i] + run[i + 1 :])
            above.append(h("".join(run)))
            above_owners.append([x for o in owners[start : start + fanout] for x in o])
        nodes, owners = above, above_owners
    return nodes[0], proofs


def plain(rows, fanout=2):
    """(doc_id, leaf, subroot, root, proof) of every row, in one process."""
    by_lang: dict = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r[0], leaf(*r)))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    subs, lower = [], {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        sub, proofs = tree([x[1] for x in by_lang[lang]], fanout)
        subs.append(sub)
        lower[lang] = proofs
    root, upper = tree(subs, fanout)
    return sorted(
        (str(d), lf, subs[i], root, h(lower[lang][j] + upper[i]))
        for i, lang in enumerate(langs)
        for j, (d, lf) in enumerate(by_lang[lang])
    )


def run(make_docs, rows, **options):
    out = M.manifest(make_docs(rows), **options)
    out = out.withColumn("proof", F.sha2(M.siblings(F.col("path")), 256)).withColumn("up", M.folded(F.col("found"), F.col("path")))
    got = out.collect()
    assert all(r["up"] == r["root"] for r in got)
    return sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["proof"]) for r in got)


ODD = [
    (None, None, None, None, None),
    (None, "", "en", "s", 0),
    (None, "", "en", "s", 0),
    (7, "x" * 200_000, "en", "s", 200_000),
    (7, "same id", "en", None, 7),
    (8, "é ü 😀", "", "s", None),
    (-3, "minus", "en", "s", 5),
    (8, "é ü 😀", "", "s", None),
]


def documents(sizes: dict) -> list:
    return [(i, f"text {i} {lang}", lang, f"s{i % 3}", i) for lang, n in sizes.items() for i in range(n)]


@pytest.mark.parametrize("fanout,block_levels,round_levels", [(2, 12, 3), (2, 0, 2), (3, 1, 1)])
def test_equals_one_process(make_docs, fanout, block_levels, round_levels):
    rows = ODD + documents({"en": 23, "de": 9, "fr": 1, "zz": 2, "Ä": 5, None: 3})
    got = run(make_docs, rows, fanout=fanout, block_levels=block_levels, round_levels=round_levels)
    assert got == plain(rows, fanout)


def test_languages_of_every_shape(make_docs):
    rows = documents({f"l{n:02d}": n for n in (*range(1, 14), 16, 17, 33)})
    assert run(make_docs, rows, block_levels=1, round_levels=1) == plain(rows)


def test_empty(make_docs):
    assert run(make_docs, []) == []


def test_a_changed_row_does_not_lead_to_the_root(make_docs):
    rows = documents({"en": 40, "de": 3}) + [(1000 + i, "no count", "fr", "s", None) for i in range(20)]
    out = M.manifest(make_docs(rows), M.tampered_leaf()).withColumn("up", M.folded(F.col("found"), F.col("path")))
    import zlib

    for r in out.collect():
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["doc_id"] < 1000
        assert (r["up"] == r["root"]) == (not changed)
