"""Secret scans: candidates by pattern, false positives removed by a random forest.

Every long run of token characters in a whole text is a candidate, without a name assigned in front
of it, and so is every value of any characters but white space and quotes, six or more of them,
that is assigned to a credential's name.  A forest over its length,
character transitions, coverage by dictionary words, path and neighbouring words is trained from
labelled findings and decides which candidates are secrets.  The dictionary is counted from the
whole corpus.  DataFrame and Spark ML operations only.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmarts.llm.common import DOCUMENT_COLUMNS, small_side, written

CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
MASK = "[SECRET]"
#: Characters of the text on either side of a candidate that its features see.
CONTEXT = 48
#: Labelled findings, chosen by a hash, from which the forest is trained.
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 30, 6, 42
LEAST_SCORE = 0.5
#: Words of these lengths that the corpus has at least so often are dictionary words.
WORD_SIZES = (4, 12)
LEAST_COUNT = 20
#: Letters of a run that are looked at together, and candidates that make their value a hot one.
WINDOW = 256
HOT_ROWS = 1000

# Words that name credentials, and words that name other long tokens.
CREDENTIAL_WORDS = "token|secret|password|passwd|pwd|api_?key|access_?key|private_?key|auth|bearer|credential"
OTHER_WORDS = "sha|sha1|sha256|md5|crc|digest|checksum|hash|commit|uuid|guid|etag|integrity|revision"

# What is looked for is a value assigned to a credential's name, or else a CANDIDATE, without the name that a "=" ends.
_NAME = r"[A-Za-z0-9+/_-]"
_VALUE = (
    r"(?!\[SECRET\])(?:[^\s\"'`]{6,}(?=[\"'`])|[^\s\"'`]{5,}[^\s\"'`.,;:!?()\[\]{}<>])"  # no stop behind an unquoted one
)
_ASSIGNED = (
    r"(?<=[:=\s\"'`>])(?<=[:=]>?\s{0,4}[\"'`]?)"  # rules nearly all places out before the long look back
    rf"(?<=(?i:{CREDENTIAL_WORDS})[\w-]{{0,20}}[\"'`]?\s{{0,4}}[:=]{{1,2}}>?\s{{0,4}}[\"'`]?){_VALUE}"
)
FOUND = (
    rf"{_ASSIGNED}|(?<!{_NAME})(?={CANDIDATE})(?!{_NAME}{{1,80}}=(?!=){CANDIDATE})"
    rf"(?!{_NAME}{{0,60}}(?i:{CREDENTIAL_WORDS})[\w-]{{0,20}}=(?!=){_VALUE}){CANDIDATE}"
)

FEATURES = [
    *("length", "digits", "capitals", "class_changes", "vowel_changes", "distinct_chars", "dictionary"),
    *("credential_before", "other_before", "assigned", "quoted", "in_path", "test_path", "words_around"),
]
KEYS = ["doc_id", "text_hash", "finding"]


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate: doc_id, text_hash, finding (from 0), path, value, before, after, start.

    Rows that repeat an id and a text have their candidates once.
    """
    body = F.coalesce("text", F.lit(""))
    found = docs.filter(body.rlike(FOUND)).select(
        "doc_id",
        _text_hash().alias("text_hash"),
        F.coalesce("source", F.lit("")).alias("path"),
        F.regexp_extract_all(body, F.lit(FOUND), F.lit(0)).alias("values"),
        F.split(body, FOUND, -1).alias("gaps"),
    )
    # An outer explode: for the other kind a test for emptiness, with the arrays' expressions in it, goes below.
    each = found.select(
        "doc_id",
        "text_hash",
        "path",
        F.posexplode_outer(
            F.transform(
                "values",
                lambda v, i: F.struct(
                    v.alias("value"),
                    F.right(F.get("gaps", i), F.lit(CONTEXT)).alias("before"),
                    F.left(F.get("gaps", i + 1), F.lit(CONTEXT)).alias("after"),
                    (F.length(F.get("gaps", i)) + F.length(v)).alias("step"),
                ),
            )
        ).alias("finding", "c"),
    ).select(*KEYS, "path", "c.*")
    upto = Window.partitionBy("doc_id", "text_hash").orderBy("finding").rowsBetween(Window.unboundedPreceding, 0)
    return (
        each.dropDuplicates(KEYS)
        .withColumn("start", (F.sum("step").over(upto) - F.length("value")).cast("bigint"))
        .drop("step")
    )


def dictionary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word): lower-case words of letters that all texts together have at least ``least`` times."""
    low, high = WORD_SIZES
    pattern = rf"(?<![A-Za-z])[a-z]{{{low},{high}}}(?![A-Za-z])"
    words = docs.select(F.explode_outer(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(pattern), F.lit(0))).alias("word"))
    return words.filter(F.col("word").isNotNull()).groupBy("word").count().filter(F.col("count") >= least).select("word")


def covered_letters(runs: DataFrame, words: DataFrame) -> DataFrame:
    """(run, letters): how many letters of each distinct run of lower-case letters lie in dictionary words.

    A run is first cut into windows that overlap by a word's length less one, so the work for a run
    grows with its length, and rows carry a window's words, never the run.
    """
    low, high = WORD_SIZES
    numbered = runs.withColumn("run_id", F.md5("run"))
    starts = F.explode(F.sequence(F.lit(0), F.length("run") - low, F.lit(WINDOW)))
    windows = numbered.select("run_id", starts.alias("begin"), "run").select(
        "run_id", "begin", F.substring("run", F.col("begin") + 1, F.lit(WINDOW + high - 1)).alias("part")
    )
    places = windows.select("run_id", "begin", "part", F.explode(F.sequence(F.lit(1), F.least(F.lit(WINDOW), F.length("part")))).alias("at"))
    parts = places.select("*", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("n")).filter(
        F.col("at") + F.col("n") - 1 <= F.length("part")
    )
    covered = (
        parts.select("run_id", (F.col("begin") + F.col("at")).alias("at"), "n", F.substring("part", F.col("at"), F.col("n")).alias("word"))
        .join(words, "word")
        .select("run_id", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("at"))
        .groupBy("run_id")
        .agg(F.count_distinct("at").alias("letters"))
    )
    return numbered.join(covered, "run_id").select("run", "letters")


def coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds ``dictionary``: the share of a candidate's characters inside dictionary words.

    Words are of letters, so runs of letters are looked at, each distinct one once.  A value that
    stands in more than ``HOT_ROWS`` candidates has its answer broadcast, of which there are few;
    the others' answers are joined.
    """
    low, _ = WORD_SIZES
    values = found.groupBy("value").agg(F.count("*").alias("rows")).withColumn("value_id", F.md5("value"))
    pieces = values.select("value_id", F.explode(F.regexp_extract_all(F.lower("value"), F.lit(f"[a-z]{{{low},}}"), F.lit(0))).alias("run"))
    pieces = pieces.groupBy("value_id", "run").count()
    letters = covered_letters(pieces.select("run").distinct(), words)
    each = pieces.join(letters, "run").groupBy("value_id").agg(F.sum(F.col("letters") * F.col("count")).alias("letters"))
    shares = written(
        values.join(each, "value_id", "left").select(
            "value", "rows", (F.coalesce("letters", F.lit(0)) / F.length("value")).alias("dictionary")
        ),
        "secret-coverage",
    )
    hot = small_side(shares.filter(F.col("rows") > HOT_ROWS).select("value", F.col("dictionary").alias("of_hot")), F.octet_length("value") + 64)
    told = found.join(hot, "value", "left")
    cold = shares.filter(F.col("rows") <= HOT_ROWS).select("value", "dictionary")
    rest = told.filter(F.col("of_hot").isNull()).drop("of_hot").join(cold, "value")
    return rest.unionByName(told.filter(F.col("of_hot").isNotNull()).withColumnRenamed("of_hot", "dictionary"))


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """The candidates with one double for each of FEATURES."""
    value, before, n = F.col("value"), F.lower("before"), F.length("value")

    def count(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)).cast("double")

    def flag(column: Column, pattern: str) -> Column:
        return column.rlike(pattern).cast("double")

    features = {
        "length": F.log1p(n),
        "digits": count("[0-9]") / n,
        "capitals": count("[A-Z]") / n,
        "class_changes": count(r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])") / n,
        "vowel_changes": count(r"(?<=[aeiouAEIOU])(?=[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z])") / n,
        "distinct_chars": F.size(F.array_distinct(F.split("value", ""))) / n,
        "credential_before": flag(before, rf"({CREDENTIAL_WORDS})[^a-z]*$"),
        "other_before": flag(before, rf"(?:^|[^a-z])({OTHER_WORDS})[^a-z]*$"),
        "assigned": flag(before, r"[:=]\s*[\"'`]?$"),
        "quoted": flag(before, r"[\"'`]$") * flag(F.col("after"), r"^[\"'`]"),
        "in_path": flag(before, r"://\S*$|[\w.]/$"),
        "test_path": flag(F.lower("path"), r"test|example|sample|fixture|mock|doc"),
        "words_around": F.regexp_count(F.concat("before", F.lit(" "), "after"), F.lit(r"\s\p{L}+(?=\s)")).cast("double"),
    }
    return coverage(found, words).select("*", *[v.alias(k) for k, v in features.items()])


def weak_label() -> Column:
    """1 for a candidate assigned to a credential's name, 0 for plain words and named digests, else null."""
    mixed = (F.col("digits") > 0.05) & (F.col("class_changes") > 0.05)
    return (
        F.when((F.col("credential_before") == 1) & (F.col("assigned") == 1) & mixed, 1.0)
        .when(F.col("other_before") == 1, 0.0)
        .when((F.col("digits") == 0) & (F.col("capitals") < 0.2), 0.0)
        .when(F.col("digits") == 1, 0.0)
    )


def findings(docs: DataFrame, labelled: DataFrame | None = None, rows: int = TRAIN_ROWS) -> DataFrame:
    """All candidates of all documents with ``score`` (the forest's chance) and ``is_secret``.

    ``labelled`` has (doc_id, start, label 0 or 1) of earlier findings; without it the labels are
    those that ``weak_label`` gives from the neighbouring words.  The forest is trained on at most
    ``rows`` labelled findings; with labels of one kind only, that kind is the verdict for all, and
    without any nothing is a secret.  Null and empty texts have no candidates; a null source is an
    empty path; a null doc_id is kept; other columns are not read.
    """
    words = small_side(written(dictionary(docs), "secret-words"), 64)
    found = written(candidates(docs), "secret-found")
    found = written(with_features(found, words), "secret-candidates")
    if labelled is None:
        told = found.withColumn("label", weak_label())
    else:
        known = labelled.select(F.col("doc_id").alias("l_id"), F.col("start").alias("l_start"), F.col("label").cast("double"))
        told = found.join(known, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("start") == F.col("l_start")))
    # One partition in a fixed order, so that the forest is the same wherever its rows came from.
    chosen = told.filter(F.col("label").isin(0.0, 1.0)).orderBy(F.xxhash64(*KEYS), *KEYS).limit(rows)
    chosen = written(chosen.select("label", *FEATURES).coalesce(1), "secret-train")
    kinds = [r["label"] for r in chosen.select("label").distinct().collect()]
    keep = [*KEYS, "start", "value", "path"]
    if len(kinds) < 2:
        return found.select(*keep, F.lit(kinds[0] if kinds else 0.0).alias("score"), F.lit(kinds == [1.0]).alias("is_secret"))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, probabilityCol="chances").fit(assembler.transform(chosen))
    judged = forest.transform(assembler.transform(found))
    score = F.round(F.get(vector_to_array("chances"), F.lit(1)), 6)
    return judged.select(*keep, score.alias("score"), (score >= LEAST_SCORE).alias("is_secret"))


def mask_secrets(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The documents' columns, with every secret in the text replaced by ``MASK`` and n_chars to match."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    secret = (
        findings(docs, labelled)
        .groupBy(F.col("doc_id").alias("s_id"), F.col("text_hash").alias("s_hash"))
        .agg(
            F.max("is_secret").alias("any"),
            F.transform(
                F.array_sort(F.collect_list(F.struct("finding", "is_secret"))), lambda x: x["is_secret"]
            ).alias("flags"),
        )
        .filter("any")
        .drop("any")
    )
    secret = small_side(written(secret, "secret-flags"), 256)
    values = F.regexp_extract_all(F.col("text"), F.lit(FOUND), F.lit(0))
    pieces = F.transform(
        F.arrays_zip(F.split("text", FOUND, -1).alias("gap"), values.alias("value"), F.col("flags").alias("flag")),
        lambda p: F.concat(p["gap"], F.when(p["flag"], MASK).otherwise(F.coalesce(p["value"], F.lit("")))),
    )
    same = F.col("doc_id").eqNullSafe(F.col("s_id")) & (_text_hash() == F.col("s_hash"))
    masked = F.when(F.col("flags").isNotNull(), F.concat_ws("", pieces)).otherwise(F.col("text"))
    return docs.join(secret, same, "left").select(
        "doc_id",
        masked.alias("text"),
        "lang",
        "source",
        F.when(F.col("flags").isNotNull(), F.length(masked).cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """Every candidate of every document with its place, score and verdict."""
    found = findings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "start", F.length("value").alias("n_chars"), "value", "score", "is_secret")
