"""Licences: exact phrases, and text blocks that contain most words of a licence template (set-similarity join)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, WORD_CLASS, cut_lineage, measured, row_view
from tidemark.llm.decontamination import words_of

#: Phrases and their labels. Fixed values.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Templates of the join: label and wording of well-known notices. Fixed values.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("apache-2.0", "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4.0"),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4.0 international license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0"),
)

#: A block is a line, or a paragraph of wrapped lines between empty ones or the ends of the text. Both cuts are looked at.
LINES, PARAGRAPHS = r"\n", r"\n[\x20\t\r]*\n"
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def phrase_pattern() -> str:
    said = "|".join(BREAK.join(p.split()) for p, _ in PHRASES)
    return rf"(?<![{WORD_CLASS}])(?i:{said})(?![{WORD_CLASS}])"


def phrase_places(text: Column) -> dict[str, Column]:
    """n_words, n_base, first_word, last_word and base_labels of a text. A phrase starts and ends at word limits, so the words
    before the last place are all but those of what follows it and its own."""
    pattern, word = phrase_pattern(), F.lit(WORD)
    n_words = F.regexp_count(text, word).cast("long")
    any_ = text.rlike(pattern)
    hits = F.when(any_, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    gaps = F.when(any_, F.split(text, pattern, -1))
    label = lambda h: F.coalesce(*(F.when(F.lower(h).startswith(p.split()[0]), F.lit(name)) for p, name in PHRASES))
    return {
        "n_words": n_words,
        "n_base": F.coalesce(F.size(hits), F.lit(0)).cast("long"),
        "first_word": F.regexp_count(gaps[0], word).cast("long"),
        "last_word": n_words
        - F.regexp_count(F.element_at(gaps, -1), word)
        - F.regexp_count(F.element_at(hits, -1), word),
        "base_labels": F.coalesce(F.array_distinct(F.transform(hits, label)), F.array().cast("array<string>")),
    }


def template_table(spark: SparkSession, templates=TEMPLATES, containment: float = 0.8) -> DataFrame:
    """(template, label, words, needed): distinct words of each template and how many a block must have."""
    rows = [(n, label, sorted(set(_words(text)))) for n, (label, text) in enumerate(templates)]
    table = spark.createDataFrame(
        [(n, label, words, math.ceil(containment * len(words) - 1e-9)) for n, label, words in rows if words],
        "template int, label string, words array<string>, needed int",
    )
    return table


def _words(text: str) -> list[str]:
    return "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower()).split()


def blocks_of(view: DataFrame, vocabulary: list[str], least: int) -> DataFrame:
    """(_id, key, block, words): for each line and paragraph the template words in it, where there are `least` or more.

    Words that no template has can add to no overlap, so a block is carried as its words of the vocabulary.
    """
    known = F.array(*(F.lit(v) for v in vocabulary))
    lines = F.split("_text", LINES)
    paragraphs = F.when(F.col("_text").contains("\n"), F.split("_text", PARAGRAPHS)).otherwise(F.array().cast("array<string>"))
    cut = view.filter(F.col("_text").isNotNull()).select("_id", "key", F.posexplode(F.concat(lines, paragraphs)).alias("block", "b"))
    return cut.select("_id", "key", "block", F.array_intersect(words_of(F.col("b")), known).alias("words")).filter(
        F.size("words") >= least
    )


def template_matches(docs: DataFrame, templates=TEMPLATES, containment: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, key, block, label, score): blocks that hold at least `containment` of a template's distinct words.

    Words are ordered by how many blocks of the corpus have them, rarest first. A template whose `needed` words a block holds
    shares one of its first |T| - needed + 1 words with it, so only those prefixes are joined; a block with fewer words than
    needed is not (length filter), nor one where the words behind the shared one can no longer make up the number
    (positional filter). What is left is verified exactly.
    """
    spark = docs.sparkSession
    table = template_table(spark, templates, containment)
    rows = table.collect()  # the templates given, which this call made into rows
    vocabulary = sorted({w for r in rows for w in r["words"]})
    view = row_view(docs, id_col, text_col).withColumn("key", F.xxhash64("_text"))
    blocks = blocks_of(view, vocabulary, min((r["needed"] for r in rows), default=1))
    blocks = cut_lineage(blocks)
    seen = {r["w"]: r["n"] for r in blocks.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    ordered = F.create_map(*(F.lit(x) for pair in rank.items() for x in pair))
    first = [
        (w, i, r["template"], r["label"], len(r["words"]), r["needed"], r["words"])
        for r in rows
        for i, w in enumerate(sorted(r["words"], key=rank.__getitem__)[: len(r["words"]) - r["needed"] + 1])
    ]
    prefixes = spark.createDataFrame(
        first, "word string, place int, template int, label string, total int, needed int, words_t array<string>"
    )
    by_rank = F.transform(
        F.array_sort(F.transform("words", lambda w: F.struct(F.element_at(ordered, w).alias("r"), w.alias("w")))), lambda x: x["w"]
    )
    tokens = blocks.withColumn("words", by_rank).select("_id", "key", "block", "words", F.posexplode("words").alias("at", "word"))
    met = tokens.join(measured(prefixes), "word").filter(F.size("words") >= F.col("needed"))
    met = met.filter(1 + F.least(F.col("total") - F.col("place") - 1, F.size("words") - F.col("at") - 1) >= F.col("needed"))
    shared = F.size(F.array_intersect("words", "words_t"))
    met = met.withColumn("shared", shared).filter(F.col("shared") >= F.col("needed"))
    return met.groupBy("_id", "key", "block", "label").agg(F.max(F.col("shared") / F.col("total")).alias("score"))


def scan_licenses(docs: DataFrame, templates=TEMPLATES, containment: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score), one row per row of `docs`.

    base_labels: of the phrases found; labels: with those of the templates that a line or paragraph of the text contains;
    both distinct and sorted. score: 1 where a phrase stands, else the best containment found, else 0.
    Null and empty texts: no words, no labels, score 0. Null ids are matched null-safely; repeated rows each get their row.
    DataFrame functions only.
    """
    view = row_view(docs, id_col, text_col).select("_id", F.xxhash64("_text").alias("key"), F.coalesce("_text", F.lit("")).alias("_text"))
    found = template_matches(docs, templates, containment, id_col, text_col)
    found = found.groupBy("_id", "key").agg(F.collect_set("label").alias("more"), F.max("score").alias("best"))
    found = found.select(F.col("_id").alias("hit_id"), F.col("key").alias("hit_key"), "more", "best")
    base = view.select("_id", "key", *(c.alias(n) for n, c in phrase_places(F.col("_text")).items()))
    joined = base.join(found, F.col("_id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key")), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        F.col("_id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_sort("base_labels").alias("base_labels"),
        F.array_sort(F.array_union("base_labels", F.coalesce("more", none))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
