"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, low or abstain on every document.  Documents are counted
by their votes, so all of them enter, as at most 3 ** labellers counts, and expectation-maximisation
over the counts estimates how often each labeller is right.  The posterior of a document's votes is
its label.  A linear scorer over hashed words and hashed statistics is then trained on a bounded
sample of such labels, and scores every document by its whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import compress, crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventmarts.llm.common import DOCUMENT_COLUMNS

#: About so many documents, chosen by a hash, on which the scorer is trained.
TRAIN_ROWS = 10_000
#: Hashed features; the scorer's weights are the only thing that tasks are sent.
FEATURES = 1 << 16
#: A document is kept if the scorer gives at least this chance that it is good.
LEAST_GOOD = 0.5
EM_ROUNDS = 200
TRAIN_ROUNDS = 80
L2 = 1e-3
ABSTAIN = 2

# Frequent small words of the corpus languages.
SMALL_WORDS = frozenset(
    w.encode()
    for w in (
        "the of and to in a is that for with on as was by it are be this or an "
        "de la que el en y los del se las por un una con no su para "
        "le les des et est du pour dans qui par sur au une avec pas "
        "der die und das von zu den mit ist nicht ein eine auf dem"
    ).split()
)
_CAPITALS = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>{}\\~^"
_MARKS = b"!?"
_NOT_LETTERS = bytes(set(range(128)) - set(range(65, 91)) - set(range(97, 123)))
_STOP = re.compile(rb"[.!?](?=\s|$)")


def _count(text: bytes, wanted: bytes) -> int:
    return len(text) - len(text.translate(None, wanted))


def statistics(text: bytes, words: list[bytes], distinct: set[bytes]) -> dict[str, float]:
    """Shares that the labellers look at and that the scorer sees in steps."""
    n, chars = max(1, len(words)), max(1, len(text))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return {
        "words": len(words),
        "chars": len(text),
        "distinct": len(distinct) / n,
        "stutter": sum(map(bytes.__eq__, words, words[1:])) / n,
        "pairs": len(set(zip(words, words[1:], strict=False))) / n,
        "packed": len(compress(text, 1)) / chars,
        "lines": len(set(lines)) / max(1, len(lines)),
        "small": sum(map(SMALL_WORDS.__contains__, words)) / n,
        "symbols": _count(text, _SYMBOLS) / n,
        "capitals": _count(text, _CAPITALS) / chars,
        "marks": _count(text, _MARKS) / n,
        "digits": _count(text, _DIGITS) / chars,
        "wordless": sum(not w.translate(None, _NOT_LETTERS) for w in distinct) / max(1, len(distinct)),
        "bars": words.count(b"|") / n,
        "mean_word": chars / n,
        "stops": len(_STOP.findall(text)) / n,
    }


def _between(low: bool, good: bool) -> int:
    return 0 if low else 1 if good else ABSTAIN


def votes_of(s: dict[str, float]) -> tuple[int, ...]:
    """A vote of every labeller: 0 low, 1 good, or ABSTAIN.

    Labellers are meant to be right more often than not, and to overlap; none needs to be sharp.
    """
    n = s["words"]
    return (
        _between(s["symbols"] > 0.2, s["symbols"] < 0.02),
        _between(s["bars"] > 0.1, s["bars"] == 0 and n >= 20),
        _between(n >= 10 and s["distinct"] < 0.4, n >= 10 and s["distinct"] > 0.5),
        _between(n >= 10 and s["stutter"] > 0.2, n >= 10 and s["stutter"] < 0.05),
        _between(n >= 20 and s["pairs"] < 0.6, n >= 20 and s["pairs"] > 0.8),
        _between(s["chars"] >= 300 and s["packed"] < 0.2, s["chars"] >= 300 and s["packed"] > 0.3),
        _between(n >= 10 and s["lines"] < 0.6, n >= 20 and s["lines"] > 0.9),
        _between(n >= 10 and s["capitals"] > 0.3, n >= 10 and s["capitals"] < 0.1),
        _between(n >= 5 and s["marks"] > 0.3, n >= 5 and s["marks"] < 0.05),
        _between(n >= 30 and s["small"] < 0.08, n >= 30 and s["small"] > 0.15),
        _between(n >= 40 and s["stops"] < 0.01, n >= 20 and 0.03 < s["stops"] < 0.4),
        _between(n >= 20 and not 3.5 < s["mean_word"] < 8, n >= 20 and 4 < s["mean_word"] < 7),
        _between(n >= 10 and s["wordless"] > 0.3, n >= 10 and s["wordless"] < 0.1),
        _between(n >= 5 and s["digits"] > 0.3, n >= 5 and s["digits"] < 0.1),
    )


LABELLERS = len(votes_of(statistics(b"", [], set())))
_STEPS = (
    *(("distinct", 10), ("stutter", 10), ("lines", 10), ("small", 20), ("symbols", 10), ("capitals", 20)),
    *(("marks", 10), ("digits", 20), ("wordless", 10), ("bars", 20), ("mean_word", 2), ("stops", 20)),
)


def read(text: str | None) -> tuple[tuple[int, ...], list[bytes]]:
    """Votes on a text, and its features' names: lower-cased words, and statistics in steps."""
    raw = (text or "").encode()
    words = raw.lower().split()
    distinct = set(words)
    s = statistics(raw, words, distinct)
    steps = [b"\x1f%b=%d" % (name.encode(), min(40, int(s[name] * scale))) for name, scale in _STEPS]
    return votes_of(s), [*distinct, *steps]


def hashed(names: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, names), np.int64, len(names)) % FEATURES


@dataclass
class LabelModel:
    """The share of good documents, and of each labeller its chances of each vote given the truth."""

    good: float
    chances: np.ndarray  # [labeller, truth (low, good), vote (low, good)], given that it votes

    def odds(self, votes: np.ndarray) -> np.ndarray:
        """Log odds of good for rows of votes, one column a labeller; abstaining tells nothing."""
        each = np.log(self.chances[:, 1] / self.chances[:, 0])
        each = np.concatenate([each, np.zeros((len(each), 1))], axis=1)
        return np.log(self.good / (1 - self.good)) + each[np.arange(len(each)), votes].sum(axis=1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return _chance(self.odds(votes))


def _chance(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> LabelModel:
    """Expectation-maximisation over distinct vote rows and their counts.

    It starts from low for every row with two or more low votes; every estimate is smoothed by one
    count.
    """
    lows = (votes == 0).sum(axis=1)
    good = np.where(lows >= 2, 0.1, np.where(lows == 1, 0.5, 0.95))
    one = np.eye(3)[votes][:, :, :2]  # [row, labeller, vote]
    for _ in range(rounds):
        mass = np.stack([counts * (1 - good), counts * good])
        chances = np.einsum("tr,rlv->ltv", mass, one) + 1.0
        chances /= chances.sum(axis=2, keepdims=True)
        model = LabelModel(float((mass[1].sum() + 1) / (counts.sum() + 2)), chances)
        after = model.posterior(votes)
        if np.abs(after - good).max(initial=0) < 1e-9:
            break
        good = after
    return model


def label_model(docs: DataFrame) -> tuple[LabelModel, int]:
    """The model of all documents' votes and their number; at most 3 ** LABELLERS counts are collected."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = [bytes(read(t.as_py())[0]) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(votes, pa.binary())], ["votes"])

    rows = docs.select("text").mapInArrow(vote, "votes binary").groupBy("votes").count().orderBy("votes").collect()
    votes = np.array([list(r["votes"]) for r in rows], int).reshape(len(rows), LABELLERS)
    counts = np.array([r["count"] for r in rows], float)
    return estimate(votes, counts), int(counts.sum())


def fit(rows: list[np.ndarray], good: np.ndarray, rounds: int = TRAIN_ROUNDS) -> np.ndarray:
    """Weights of a logistic scorer, the last for all documents, fitted to chances of good."""
    weights, sums = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-8)
    if not rows:
        return weights
    flat = np.concatenate([np.append(r, FEATURES) for r in rows])
    sizes = np.array([len(r) + 1 for r in rows])
    starts = np.cumsum(sizes) - sizes
    scale = np.repeat(1 / np.sqrt(sizes), sizes)
    # Good and low documents weigh the same together.
    share = np.clip(good.mean(), 1e-3, 1 - 1e-3)
    balance = good / share + (1 - good) / (1 - share)
    for _ in range(rounds):
        chance = _chance(np.add.reduceat(weights[flat] * scale, starts))
        error = (chance - good) * balance / len(rows)
        slope = np.bincount(flat, np.repeat(error, sizes) * scale, FEATURES + 1) + L2 / len(rows) * weights
        sums += slope**2
        weights -= 0.5 * slope / np.sqrt(sums)
    return weights


def train(docs: DataFrame, model: LabelModel, n: int, rows: int = TRAIN_ROWS) -> np.ndarray:
    """The scorer's weights, from the posteriors of about ``rows`` of the ``n`` documents."""

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [read(t.as_py()) for t in batch.column(0)]
            features = [np.sort(hashed(names)).astype("<u4").tobytes() for _, names in seen]
            good = model.posterior(np.array([v for v, _ in seen], int).reshape(len(seen), LABELLERS))
            yield pa.RecordBatch.from_arrays([pa.array(features, pa.binary()), pa.array(good)], ["features", "good"])

    chosen = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(n, 1))) < rows).select("text")
    found = chosen.mapInArrow(sampled, "features binary, good double").orderBy(F.xxhash64("features", "good")).collect()
    return fit([np.frombuffer(r["features"], "<u4").astype(np.int64) for r in found], np.array([r["good"] for r in found]))


def scored(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns of every document with posterior (of the votes), score (of the scorer), kept.

    ``columns`` may leave out the text, which is read anyhow.  A null text counts as empty, on which
    most labellers abstain; repeated rows are judged each; a null doc_id is judged; other columns
    are not read; an empty table gives an empty result.
    """
    docs = docs.select(*dict.fromkeys([*columns, "doc_id", "text"]))
    model, n = label_model(docs)
    weights = train(docs, model, n)
    names = [*columns, "posterior", "score", "kept"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = np.empty((batch.num_rows, LABELLERS), int)
            odds = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column("text")):
                votes[i], features = read(text.as_py())
                at = np.append(hashed(features), FEATURES)
                odds[i] = weights[at].sum() / np.sqrt(len(at))
            chance = _chance(odds).round(6)
            found = [model.posterior(votes).round(6), chance, chance >= LEAST_GOOD]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], *map(pa.array, found)], names)

    schema = StructType([docs.schema[c] for c in columns]).add("posterior", "double").add("score", "double").add("kept", "boolean")
    return docs.mapInArrow(score, schema)


def keep_good(docs: DataFrame) -> DataFrame:
    """The document columns of the documents that the classifier doesn't reject."""
    return scored(docs, DOCUMENT_COLUMNS).filter("kept").select(*DOCUMENT_COLUMNS)


def query(spark, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
