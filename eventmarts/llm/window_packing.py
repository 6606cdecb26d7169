"""Packing by order-preserving dynamic programming.

Documents stay in the order of their table; the token stream of each input partition is cut into
windows of at most 2048 tokens.  A cut may stand at the end of a document (free), at the end of a
sentence, or inside an over-long sentence (each with its own penalty).  With S(j) the least cost of
all windows up to cut j,

    S(j) = penalty(j) + min over cuts i with j - 2048 <= i < j of S(i) + padding(j - i),

where padding is 2048 less the length, or nothing if the length is a power of two.  As the padding
is linear, the minimum is that of S(i) + i over a sliding range, kept in a monotone queue; cuts a
power of two before are looked up besides.

A task packs its partition of the stored table as a stream in blocks of bounded size, without a
shuffle, and gives the same windows again if it is retried.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 2048
END_ID = 1
#: Costs of a cut, in tokens of padding.
SENTENCE_PENALTY = 4
INNER_PENALTY = 64
#: A sentence may be cut inside after every so many tokens; shorter ones never are.
INNER_STEP = 256
#: Tokens that are packed at a time, and sequences of each block that are packed again with the next.
BLOCK = 1 << 20
KEEP_OPEN = 8
SEQUENCE_BITS = 40

_FULL_STOP = re.compile(rb"[.!?]+['\")\]]*")

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


class Encoder:
    """Token ids and sentence ends of texts, by the byte-pair vocabulary of a tokenizer file.

    The file's ids are the ranks of its merges, so the faster of the two libraries that read such
    vocabularies gives the ids that the file's own library gives; a test holds them together.
    Tokens that the file adds to its merges, like ``<|endoftext|>``, are plain text to ``encode``
    unless ``added_tokens`` is set; the file's own library always reads them as one id.
    """

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in tokenizer.get_vocab().items() if t not in special}
        self.encoding = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        size = max([*ranks.values(), *special.values()]) + 1
        self.line_end, self.full_stop, self.space_first = np.zeros((3, size), bool)
        for token, i in ranks.items():
            self.line_end[i] = token.endswith(b"\n")
            self.full_stop[i] = _FULL_STOP.fullmatch(token) is not None
            self.space_first[i] = token[:1].isspace()

    def encode(self, text: str, added_tokens: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text, and the positions in it (in ids) after which a sentence ends."""
        found = self.encoding.encode(text, allowed_special="all") if added_tokens else self.encoding.encode_ordinary(text)
        ids = np.array(found, np.uint32)
        ends = self.line_end[ids]
        ends[:-1] |= self.full_stop[ids[:-1]] & self.space_first[ids[1:]]
        return ids, np.flatnonzero(ends) + 1


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it can be printed."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printed]
    return {chr(b): b for b in printed} | {chr(0x100 + i): b for i, b in enumerate(others)}


@cache
def encoder_of(path: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(path)


def cut_points(n: int, sentence_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in a document of ``n`` tokens at which it may be cut, its end the last, and their penalties."""
    ends = np.unique(np.append(sentence_ends[(sentence_ends > 0) & (sentence_ends < n)], n))
    begins = np.append(0, ends[:-1])
    penalties = np.full(len(ends), SENTENCE_PENALTY, np.int64)
    penalties[-1] = 0
    steps = (ends - begins - 1) // INNER_STEP
    if steps.any():
        inner = np.repeat(begins, steps) + INNER_STEP * (
            np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps) + 1
        )
        at = np.concatenate([ends, inner])
        penalties = np.concatenate([penalties, np.full(len(inner), INNER_PENALTY, np.int64)])
        order = np.argsort(at, kind="stable")
        return at[order], penalties[order]
    return ends, penalties


def best_cuts(at: list[int], penalties: list[int], window: int = WINDOW) -> list[int]:
    """Indexes into ``at`` of the cheapest cuts, the last always among them.

    ``at`` are increasing positions above 0, no two neighbours (nor 0 and the first) further apart
    than ``window``.
    """
    spot = np.array(at, np.int64)
    exact: list[list[int]] = [[] for _ in at]  # of each cut: earlier cuts a power of two before it
    present = np.zeros(at[-1] + 1, bool)
    present[0] = True
    present[spot] = True
    for k in range(window.bit_length()):
        if (power := 1 << k) <= window:
            hits = np.flatnonzero((spot >= power) & present[np.maximum(spot - power, 0)])
            for i in hits.tolist():
                exact[i].append(at[i] - power)
    cost_at = {0: 0}
    before = {0: 0}
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (S(i) + i, i), least first
    for j, penalty, tries in zip(at, penalties, exact, strict=True):
        while queue[0][1] < j - window:
            queue.popleft()
        least, came = queue[0]
        least += window - j
        for i in tries:
            if cost_at[i] < least:
                least, came = cost_at[i], i
        cost_at[j], before[j] = least + penalty, came
        key = least + penalty + j
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], at[-1]
    while j:
        cuts.append(j)
        j = before[j]
    return cuts[::-1]


class Packer:
    """Packs a stream of documents; ``add`` and ``finish`` return rows of finished sequences."""

    def __init__(self, first_sequence: int):
        self.sequence = first_sequence
        self.docs: list[list] = []  # [doc_id, all its ids, tokens already packed]
        self.at: list[np.ndarray] = []
        self.penalties: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id, ids: np.ndarray, sentence_ends: np.ndarray) -> list[tuple]:
        at, penalties = cut_points(len(ids), sentence_ends)
        self.docs.append([doc_id, ids, 0])
        self.at.append(at + self.size)
        self.penalties.append(penalties)
        self.size += len(ids)
        return self._pack(KEEP_OPEN) if self.size >= BLOCK else []

    def finish(self) -> list[tuple]:
        return self._pack(0) if self.size else []

    def _pack(self, keep_open: int) -> list[tuple]:
        at, penalties = np.concatenate(self.at), np.concatenate(self.penalties)
        cuts = best_cuts(at.tolist(), penalties.tolist())
        cuts = cuts[: len(cuts) - keep_open]
        rows, done, begin = [], 0, 0
        for cut in cuts:
            offset = 0
            while begin < cut:
                doc_id, ids, packed = doc = self.docs[done]
                length = min(cut - begin, len(ids) - packed)
                crc = zlib.crc32(ids[packed : packed + length].astype("<u4").tobytes())
                rows.append((doc_id, packed, length, crc, len(ids), self.sequence, offset))
                doc[2] += length
                begin += length
                offset += length
                if doc[2] == len(ids):
                    done += 1
            self.sequence += 1
        self.docs = self.docs[done:]
        rest = at > begin
        self.at, self.penalties = [at[rest] - begin], [penalties[rest]]
        self.size -= begin
        return rows


def pack(docs: DataFrame, tokenizer_path: str | None = None, added_tokens: bool = False) -> DataFrame:
    """One row per piece of a document in a sequence, in the order of the table.

    A document's tokens are its text's ids and then id 1, so a null or empty text is one token.
    With ``added_tokens`` the ids are those that the tokenizer file's own library gives by default.
    Rows that repeat an id are packed one by one; a null id stays null; columns other than doc_id
    and text are not read; an empty table gives an empty result.  Sequence ids are unique: the
    partition's number above ``SEQUENCE_BITS`` bits, and a count below.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from public_tokenizers import path
        from pyspark import TaskContext

        encoder = encoder_of(tokenizer_path or path("byte_bpe_50k.json"))
        packer = Packer(TaskContext.get().partitionId() << SEQUENCE_BITS)
        end = np.array([END_ID], np.uint32)

        def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids, ends = encoder.encode(text.as_py() or "", added_tokens)
                yield from out(packer.add(doc_id, np.append(ids, end), ends))
        yield from out(packer.finish())

    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return docs.select("doc_id", "text").mapInArrow(tasks, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), added_tokens=True)
