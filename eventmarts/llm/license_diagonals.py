"""License scans by diagonal voting.

Every rolling k-gram of a text's words is joined to the places of the same k-gram in the license
templates.  A match votes for its diagonal, the text's place less the template's; votes are summed
by diagonal, neighbouring diagonals are merged (words put in or left out), and a merged span is
verified: enough votes, and a large enough share of the k-grams of the text's span and of the whole
template.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmarts.llm.common import bind, lower_ascii, small_side, written

K = 3
#: Diagonals at most this far apart are one span.
NEIGHBOURS = 2
LEAST_VOTES = 3
LEAST_SCORE = 0.8
#: What separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases of the base rule with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Usual notices of public licenses, by label.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction',
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
}


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def grams(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The keys of a table with ``words``, and the 64-bit hash and the place, from 0, of every k-gram."""

    def hashes(words: Column) -> Column:
        every = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, k)]))
        return F.slice(every, 1, F.greatest(F.size(words) - (k - 1), F.lit(0)))

    # An outer explode: for the other kind a test for emptiness, with the whole array in it, goes below.
    return (
        df.select(*keys, bind(F.col("words"), hashes).alias("hashes"))
        .select(*keys, F.posexplode_outer("hashes").alias("at", "gram_hash"))
        .filter(F.col("gram_hash").isNotNull())
    )


def template_grams(spark, templates=None, k: int = K) -> DataFrame:
    """(label, template, template_at, template_grams, gram_hash) of all templates."""
    rows = [(label, i, text) for label, texts in (templates or TEMPLATES).items() for i, text in enumerate(texts)]
    words = spark.createDataFrame(rows, "label string, template int, text string").withColumn("words", words_of(F.col("text")))
    sized = words.withColumn("template_grams", F.size("words") - (k - 1))
    return grams(sized, ["label", "template", "template_grams"], k).withColumnRenamed("at", "template_at")


def spans(docs: DataFrame, templates=None, k: int = K) -> DataFrame:
    """Verified spans: doc_id, text_hash, label, template, first and last word (from 0), votes, score.

    Rows of the same id and text have their spans once.
    """
    named = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), words_of(F.col("text")).alias("words"))
    places = small_side(written(template_grams(docs.sparkSession, templates, k), "license-grams"), 256)
    keys = ["doc_id", "text_hash", "label", "template", "template_grams"]
    matched = (
        grams(named, ["doc_id", "text_hash"], k)
        .join(places, "gram_hash")
        .select(*keys, "at", "template_at", (F.col("at") - F.col("template_at")).alias("diagonal"))
    )
    by_diagonal = matched.groupBy(*keys, "diagonal").agg(
        F.count_distinct("at").alias("votes"), F.min("at").alias("first_word"), F.max("at").alias("last_at")
    )
    along = Window.partitionBy(*keys).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > NEIGHBOURS
    merged = (
        by_diagonal.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("apart").over(along))
        .groupBy(*keys, "span")
        .agg(
            F.sum("votes").alias("votes"),
            F.min("first_word").alias("first_word"),
            F.max("last_at").alias("last_at"),
        )
    )
    longest = F.greatest(F.col("last_at") - F.col("first_word") + 1, F.col("template_grams"))
    return (
        merged.withColumn("score", F.least(F.lit(1.0), F.col("votes") / longest))
        .filter((F.col("votes") >= LEAST_VOTES) & (F.col("score") >= LEAST_SCORE))
        .select("doc_id", "text_hash", "label", "template", "first_word", (F.col("last_at") + k - 1).alias("last_word"), "votes", "score")
    )


def _phrase_places(words: Column, phrases: dict[str, str]) -> Column:
    """(at, label) of all places of the phrases."""

    def at_place(i: Column) -> Column:
        case = F.lit(None).cast("string")
        for phrase, label in phrases.items():
            together = F.lit(True)
            for j, word in enumerate(phrase.split()):
                together = together & F.coalesce(F.get(words, i + j) == word, F.lit(False))
            case = F.when(together, label).otherwise(case)
        return case

    starts = F.transform(words, lambda _, i: F.struct(i.cast("bigint").alias("at"), at_place(i).alias("label")))
    return F.filter(starts, lambda p: p["label"].isNotNull())


def scan(docs: DataFrame, templates=None, phrases: dict[str, str] | None = None) -> DataFrame:
    """Words, phrase places, labels and score of every document.

    ``labels`` has the labels of the phrases found and of the templates whose spans were verified;
    ``score`` is that of the best span, 0 without one.  A null or empty text has no words and empty
    labels; rows that repeat an id are scanned each; a null doc_id is kept; other columns are not
    read; an empty table gives an empty result.
    """
    phrases = phrases or PHRASES
    lower = lower_ascii(F.coalesce("text", F.lit("")))
    maybe = "|".join(p.replace(" ", SEPARATORS) for p in phrases)
    none = F.array().cast("array<struct<at:bigint,label:string>>")
    # Only texts that the pattern finds can have places; the words decide.
    base = (
        docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), words_of(F.col("text")).alias("words"), lower.rlike(maybe).alias("maybe"))
        .select("doc_id", "text_hash", F.size("words").cast("bigint").alias("n_words"), F.when(F.col("maybe"), bind(F.col("words"), lambda w: _phrase_places(w, phrases))).otherwise(none).alias("places"))
    )
    found = (
        spans(docs, templates)
        .groupBy(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"))
        .agg(F.collect_set("label").alias("found"), F.max("score").alias("best"))
    )
    found = small_side(written(found, "license-spans"), 256)
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash"))
    at, label = F.transform("places", lambda p: p["at"]), F.array_distinct(F.transform("places", lambda p: p["label"]))

    def listed(labels: Column) -> Column:
        return F.concat_ws(",", F.array_sort(labels))

    return base.join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        listed(label).alias("base_labels"),
        listed(F.array_union(label, F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
