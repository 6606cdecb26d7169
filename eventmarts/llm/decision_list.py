"""Quality rules: a learned decision list over statistics of whole texts.

Rules are learned by sequential covering from labelled documents.  Each rule is a conjunction of
thresholds, grown literal by literal by information gain on two thirds of the labelled documents
that no earlier rule covers, and pruned on the other third.  The counts for a literal are one sum
over the labelled rows by statistic and bin, so all labels are used and only sums reach the driver.
The list comes out as one ordered conditional expression.  DataFrame functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmarts.llm.common import SPACE, bind, written

#: A text fails the base rules with fewer words, or a larger percentage of words in repeated windows.
LEAST_WORDS = 50
MOST_REPEATED = 50
MAX_RULES = 8
MAX_LITERALS = 4
BINS = 32
#: Share of low-quality documents among those that a pruned rule covers, and the fewest it covers.
LEAST_PRECISION = 0.98
LEAST_COVER = 5
SYMBOLS = r"[#*$%&|<>]"
#: Low bits of a packed window that hold its place; the rest are from its hash.
_PLACE = (1 << 31) - 1


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def _same(items: Column, i: Column, value) -> Column:
    """Whether the item before or after ``i`` has the value of item ``i``."""
    here = value(F.get(items, i))
    before = F.when(i > 0, value(F.get(items, i - 1)) == here)
    return F.coalesce(before, F.lit(False)) | F.coalesce(value(F.get(items, i + 1)) == here, F.lit(False))


def repeated_words(words: Column) -> Column:
    """Words in windows of three words that are found twice or more, each word once.

    Windows are sorted by a short hash with their place; those whose hash has a neighbour are
    sorted again by their words, so the count is exact whatever the hashes do.
    """

    def by_hash(w: Column) -> Column:
        windows = F.slice(
            F.transform(
                w,
                lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
                .bitwiseAND(F.lit(~_PLACE))
                .bitwiseOR(i.cast("bigint")),
            ),
            1,
            F.greatest(F.size(w) - 2, F.lit(0)),
        )
        return bind(
            F.sort_array(windows), lambda p: F.filter(p, lambda x, i: _same(p, i, lambda v: F.shiftright(v, 31)))
        )

    def by_words(w: Column, places: Column) -> Column:
        named = F.transform(
            places,
            lambda x: bind(
                x.bitwiseAND(F.lit(_PLACE)).cast("int"),
                lambda i: F.struct(
                    F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("window"), i.alias("at")
                ),
            ),
        )
        return bind(
            F.sort_array(named),
            lambda n: F.sort_array(
                F.transform(
                    F.filter(n, lambda x, i: _same(n, i, lambda v: v["window"])), lambda x: x["at"]
                )
            ),
        )

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)

    return bind(words, lambda w: bind(by_words(w, by_hash(w)), covered))


def text_statistics(docs: DataFrame) -> DataFrame:
    """Counts of every whole text, a null text counting as empty."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split("body", "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    counted = docs.select("doc_id", text.alias("body")).select(
        "doc_id", "body", words_of(F.col("body")).alias("ws"), lines.alias("ls")
    )
    size = F.size("ws").cast("bigint")
    return counted.select(
        "doc_id",
        size.alias("n_words"),
        (F.length("body") - F.regexp_count("body", F.lit(f"[{SPACE}]"))).cast("bigint").alias("word_chars"),
        F.regexp_count("body", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("ws")).alias("n_repeat_words"),
        F.size(F.array_distinct("ws")).cast("bigint").alias("n_distinct"),
        F.regexp_count("body", F.lit("[A-Z]")).cast("bigint").alias("n_capitals"),
        F.regexp_count("body", F.lit("[!?]")).cast("bigint").alias("n_marks"),
    )


def ratios() -> dict[str, Column]:
    """The statistics that rules may test."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / words,
        "dup_lines": F.col("n_dup_lines") / words,
        "repeated": F.col("n_repeat_words") / words,
        # Over the square root: a long text has a smaller share of distinct words, not a smaller one of these.
        "variety": F.col("n_distinct") / F.sqrt(words),
        "capitals": F.col("n_capitals") / chars,
        "marks": F.col("n_marks") / words,
    }


@dataclass(frozen=True)
class Literal:
    statistic: str
    above: bool
    bound: float

    def holds(self) -> Column:
        value = ratios()[self.statistic]
        return value > self.bound if self.above else value <= self.bound

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.bound:.6g}"


Rule = tuple[Literal, ...]


def holds(rule: Rule) -> Column:
    together = F.lit(True)
    for literal in rule:
        together = together & literal.holds()
    return together


def covering_rule(rules: list[Rule]) -> Column:
    """The number from 1 of the first rule that covers a document, null if none does."""
    case = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        case = F.when(holds(rule), number).otherwise(case)
    return case


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _grow(rows: DataFrame, edges: dict[str, list[float]]) -> Rule:
    rule: Rule = ()
    names = list(edges)
    bins = F.array(
        *[
            F.struct(F.lit(name).alias("statistic"), F.size(F.filter(F.array(*map(F.lit, edges[name])), lambda e: e < ratios()[name])).alias("bin"))
            for name in names
        ]
    )
    while len(rule) < MAX_LITERALS:
        sums = (
            rows.filter(~F.col("held_out") & holds(rule))
            .select("low", F.explode(bins).alias("b"))
            .groupBy("b.statistic", "b.bin")
            .agg(F.sum("low").alias("low"), F.sum(1 - F.col("low")).alias("good"))
            .collect()  # at most 2 * BINS rows a statistic
        )
        best, most = None, 0.0
        for name in names:
            counts = {r["bin"]: (r["low"], r["good"]) for r in sums if r["statistic"] == name}
            p0 = sum(c[0] for c in counts.values())
            n0 = sum(c[1] for c in counts.values())
            p = n = 0
            for i, edge in enumerate(edges[name]):
                p, n = p + counts.get(i, (0, 0))[0], n + counts.get(i, (0, 0))[1]
                for above, a, b in ((False, p, n), (True, p0 - p, n0 - n)):
                    if (gain := _gain(a, b, p0, n0)) > most + 1e-9:
                        best, most = Literal(name, above, edge), gain
        if best is None:
            break
        rule = (*rule, best)
    return rule


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The shortest of the best beginnings of a rule on the held-out rows, and its counts there."""
    starts = [rule[: i + 1] for i in range(len(rule))]
    sums = [
        F.coalesce(F.sum(F.when(holds(s), value)), F.lit(0)).alias(f"{kind}{i}")
        for i, s in enumerate(starts)
        for kind, value in (("low", F.col("low")), ("good", 1 - F.col("low")))
    ]
    row = rows.filter("held_out").agg(*sums).first()
    scored = [((row[f"low{i}"] - row[f"good{i}"]) / max(1, row[f"low{i}"] + row[f"good{i}"]), -i) for i in range(len(starts))]
    at = -max(scored)[1]
    return starts[at], row[f"low{at}"], row[f"good{at}"]


def learn(statistics: DataFrame, labels: DataFrame) -> list[Rule]:
    """Rules for low quality from (doc_id, quality 0 or 1); other labels and ids are left out."""
    told = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", (1 - F.col("quality")).alias("low"))
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    rows = written(statistics.join(told, "doc_id").withColumn("held_out", held_out), "quality-labelled")
    shares = [i / BINS for i in range(1, BINS)]
    edges: dict[str, set[float]] = {name: set() for name in ratios()}
    for part in (rows, rows.filter("low = 1")):  # bounds in the tails of either kind
        values = part.select(*[v.alias(k) for k, v in ratios().items()])
        for name, found in zip(ratios(), values.approxQuantile(list(ratios()), shares, 0.005), strict=True):
            edges[name].update(found)
    # Half-way between neighbours, so that a bound keeps its distance from either kind.
    bounds = {
        name: [(a + b) / 2 for a, b in pairwise(sorted(found))] for name, found in edges.items() if len(found) > 1
    }
    rules: list[Rule] = []
    rest = rows
    while bounds and len(rules) < MAX_RULES:
        rule = _grow(rest, bounds)
        if not rule:
            break
        rule, low, good = _prune(rest, rule)
        if low + good < LEAST_COVER or low < LEAST_PRECISION * (low + good):
            break
        rules.append(rule)
        rest = rest.filter(~holds(rule))
    return rules


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, ``base_failed``, ``rule`` and ``kept`` of every document.

    ``kept`` is false for a document that fails the base rules or that a learned rule covers;
    ``rule`` is the first such rule's number.  A null text counts as empty; repeated rows are
    judged each; a null doc_id is judged but has no label; other columns are not read; without
    labels no rule is learned and only the base rules hold; no documents give an empty result.
    """
    statistics = written(text_statistics(docs), "quality-statistics")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    # Rules are for what the base rules leave.
    rules = learn(statistics.filter(~failed), labels)
    return statistics.withColumn("base_failed", failed).withColumn("rule", covering_rule(rules)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "rule",
        (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
