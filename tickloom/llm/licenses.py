"""License scan by diagonal voting, in DataFrame operations only.

All rolling word k-grams of all texts are joined with the k-grams of the templates. A match at
word p of the text and word t of the template votes for diagonal p - t. Votes are counted by
diagonal, neighbouring diagonals (words inserted or left out) are merged, and the merged spans
are verified by the words of their votes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.frames import stored

GRAM = 3
# Diagonals of one span differ by at most so many words from one to the next.
NEIGHBOUR = 4
# Share of a template's k-grams that a span must hold.
MIN_COVERAGE = 0.6

# Phrases whose consecutive words are a base match.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Opening sentences of public license texts, found with gaps and changes.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial license"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text in which A-Z are lower-cased; a null text has none."""
    held = F.coalesce(text.cast("string"), F.lit(""))
    # Only two other characters have a lower case in ASCII; texts with them take the slow way.
    odd = F.contains(held, F.lit("\u0130")) | F.contains(held, F.lit("\u212a"))
    return F.regexp_extract_all(F.when(odd, F.translate(held, _UPPER, _LOWER)).otherwise(F.lower(held)), F.lit(_WORD), F.lit(0))


def rolling_grams(df: DataFrame, array: str, place: str, gram: str) -> DataFrame:
    """All k-grams of a column of words, one row each with its place; fewer words give none."""
    count = F.greatest(F.size(array) - (GRAM - 1), F.lit(0))
    shifted = [F.slice(array, k + 1, count).alias(f"w{k}") for k in range(GRAM)]
    kept = [F.col(f"`{name}`") for name in df.columns if name != array]
    return df.select(*kept, F.posexplode(F.arrays_zip(*shifted)).alias(place, gram))


def template_grams(spark: SparkSession, phrases, templates) -> DataFrame:
    """K-grams of all phrases and templates: a fixed table of a few hundred rows."""
    rows = [(n, label, text, n < len(phrases)) for n, (label, text) in enumerate((*phrases, *templates))]
    listed = spark.createDataFrame(rows, "template INT, label STRING, phrase STRING, is_base BOOLEAN").withColumn("own", words(F.col("phrase")))
    listed = listed.select("template", "label", "is_base", (F.size("own") - (GRAM - 1)).alias("n_grams"), "own")
    return rolling_grams(listed, "own", "t", "gram").select("*", _hash("gram").alias("code"))


def _hash(gram: str) -> Column:
    return F.xxhash64(*[F.col(f"{gram}.w{k}") for k in range(GRAM)])


def spans(docs: DataFrame, text_col: str, key_cols: list[str], phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """Verified spans: key, template, label, is_base, first_word, end_word, coverage."""
    spark = docs.sparkSession
    # Short texts and copies do not matter here: each k-gram is looked up by itself.
    seen = docs.select(*key_cols, words(F.col(text_col)).alias("words"))
    rolling = rolling_grams(seen, "words", "p", "held").select("*", _hash("held").alias("code"))
    listed = F.broadcast(template_grams(spark, phrases, templates))  # fixed size
    same_words = [F.col(f"held.w{k}") == F.col(f"gram.w{k}") for k in range(GRAM)]
    match = rolling.join(listed, ["code"]).where(same_words[0] & same_words[1] & same_words[2])
    votes = match.select(*key_cols, "template", "label", "is_base", "n_grams", (F.col("p") - F.col("t")).alias("diagonal"), "p", "t")
    by_diagonal = votes.groupBy(*key_cols, "template", "label", "is_base", "n_grams", "diagonal").agg(
        F.collect_set("t").alias("held"), F.min("p").alias("p0"), F.max("p").alias("p1")
    )
    # Few rows, read twice below: the texts are scanned only once for them.
    by_diagonal = stored(by_diagonal, "votes")
    # A phrase stands where one diagonal has all its k-grams.
    exact = by_diagonal.where(F.col("is_base") & (F.size("held") == F.col("n_grams"))).select(
        *key_cols, "template", "label", "is_base", F.col("p0").cast("long").alias("first_word"),
        (F.col("p1") + GRAM).cast("long").alias("end_word"), F.lit(1.0).alias("coverage"),
    )
    along = Window.partitionBy(*key_cols, "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > NEIGHBOUR, F.lit(True))
    merged = (
        by_diagonal.where(~F.col("is_base"))
        .withColumn("fresh", fresh.cast("int"))
        .withColumn("span", F.sum("fresh").over(along))
        .groupBy(*key_cols, "template", "label", "is_base", "n_grams", "span")
        .agg(F.array_distinct(F.flatten(F.collect_list("held"))).alias("held"), F.min("p0").alias("p0"), F.max("p1").alias("p1"))
        .withColumn("coverage", F.size("held") / F.col("n_grams"))
        .where(F.col("coverage") >= MIN_COVERAGE)
    )
    return exact.unionByName(
        merged.select(
            *key_cols, "template", "label", "is_base", F.col("p0").cast("long").alias("first_word"), (F.col("p1") + GRAM).cast("long").alias("end_word"), "coverage"
        )
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """Licenses of every document: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base matches are exact phrases; the method adds labels of templates that a merged span covers
    by ``MIN_COVERAGE`` or more. ``score`` is the largest coverage, 0 without a match. Null and
    empty texts have no words and no labels. Every row of ``docs`` comes back once; rows
    of equal id and text share one result. Other columns are left out.
    """
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(
        "id", "text", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("key"), F.xxhash64("text").alias("text_code")
    )
    keys = ["key", "text_code"]
    base = F.col("is_base")
    found = (
        spans(keyed, "text", keys, phrases, templates)
        .groupBy(*keys)
        .agg(
            F.collect_set(F.when(base, F.struct("first_word", "template"))).alias("places"),
            F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
            F.max("coverage").alias("score"),
        )
    )
    sizes = keyed.select("id", *keys, F.size(words(F.col("text"))).cast("long").alias("n_words"))
    return sizes.join(found, keys, "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min("places.first_word").alias("first_word"),
        F.array_max("places.first_word").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
