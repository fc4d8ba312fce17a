"""License scan by exact set-similarity join, in DataFrame functions alone.

Templates and texts are sets of words, ordered by how few documents have a word. A text that contains a given
share of a template has one of the template's rarest words, as many as the share leaves room for:
these are its prefix. The join is on prefix words; pairs go on only if the text has enough template words
(length filter) and enough are left on both sides from the shared word on (positional filter). What is left is compared
exactly, in blocks of twice the template's length that overlap by half.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from osspulse.llm.common import is_hot, join_hot, stored, text_key, without

# Phrases that name a license, and its label.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Public notices, and their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
CONTAINED = 0.8
# Prefix words times words of all templates up to which the prefixes are broadcast; a shuffle join beyond.
BROADCAST_WORDS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text, null counting as empty; ASCII letters lower-cased."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lower, BETWEEN_WORDS, -1), lambda w: w != "")


def phrase_starts(found: Column, phrase: str) -> Column:
    """Places, counted in words from 0, where the phrase's words stand."""
    parts = phrase.split()
    stand = lambda i: reduce(Column.__and__, [F.get(found, i + k) == w for k, w in enumerate(parts)])
    places = F.filter(F.sequence(F.lit(0), F.size(found) - len(parts)), stand)
    # Two spaces between words, so that occurrences share no space.
    joined = F.concat(F.lit(" "), F.array_join(found, "  "), F.lit(" "))
    none = F.array().cast("array<int>")
    return F.when((F.size(found) >= len(parts)) & joined.contains(f" {'  '.join(parts)} "), places).otherwise(none)


def template_table(docs: DataFrame, templates, contained: float) -> DataFrame:
    """One row per template: label, set of words, how many of them make it contained, number of words."""
    spark = docs.sparkSession
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(templates)], "template int, label string, t string")
    split = rows.select("template", "label", words(F.col("t")).alias("all"))
    sized = split.select("template", "label", F.size("all").alias("length"), F.array_distinct("all").alias("set"))
    return sized.filter("length > 0").withColumn("needed", F.ceil(F.size("set") * F.lit(contained)).cast("int"))


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    phrases: dict[str, str] | None = None,
    templates=TEMPLATES,
    contained: float = CONTAINED,
) -> DataFrame:
    """`docs` without the text, with n_words, n_base, first_word, last_word, base_labels, found_labels, score.

    `found_labels`: labels of the templates of which a block has at least the share `contained` of words.
    Null texts are empty. Results belong to the text, so repeated rows and equal texts get the same. `score`: the largest
    share of a template that was found, 1 for a phrase, else 0. Templates are a list of the caller's,
    so their words are a bounded set.
    """
    phrases = PHRASES if phrases is None else phrases
    own = ["n_words", "n_base", "first_word", "last_word", "base_labels", "found_labels", "score"]
    kept = without(docs, own)
    known = template_table(docs, templates, contained)
    vocabulary = sorted({w for row in known.select("set").collect() for w in row.set})
    vocab = F.array(*map(F.lit, vocabulary)) if vocabulary else F.array().cast("array<string>")

    # How many documents have a template's word: one row per word of the templates.
    seen = kept.select(F.explode(F.array_intersect(words(F.col(text)), vocab)).alias("word"))
    counts = {r.word: r.n for r in seen.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranked = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    order = F.array(*map(F.lit, ranked)) if ranked else vocab

    sets = known.withColumn("set", F.array_intersect(order, "set"))
    prefix = F.slice("set", 1, F.size("set") - F.col("needed") + 1)
    sets = sets.withColumn("prefix", prefix)
    prefixes = [row.prefix for row in sets.select("prefix").collect()]
    rare = sorted({w for words in prefixes for w in words}, key=ranked.index)

    split = kept.withColumn("_words", words(F.col(text))).withColumns(dict(zip(["_k1", "_k2"], text_key(text), strict=True)))
    starts = [phrase_starts(F.col("_words"), p) for p in phrases]
    split = split.withColumns({f"_p{i}": s for i, s in enumerate(starts)})
    split = split.withColumn("_set", F.array_intersect(order, F.array_intersect("_words", vocab)))
    may = F.arrays_overlap("_set", F.array(*map(F.lit, rare))) if rare else F.lit(False)
    places = F.concat(*[F.col(f"_p{i}") for i in range(len(phrases))]) if phrases else F.array().cast("array<int>")
    labels = F.array_compact(
        F.array(F.lit(None).cast("string"), *[F.when(F.size(f"_p{i}") > 0, F.lit(v)) for i, v in enumerate(phrases.values())])
    )
    slim = split.select(
        *(F.col(f"`{c}`") for c in kept.columns if c.lower() != text.lower()),
        "_k1",
        "_k2",
        F.size("_words").cast("long").alias("n_words"),
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(labels)).alias("base_labels"),
        F.when(may, F.col("_set")).alias("_set"),
        F.when(may, F.col("_words")).alias("_words"),
    )
    slim = stored(slim, "words")

    texts = slim.filter("_set is not null").groupBy("_k1", "_k2").agg(
        F.count(F.lit(1)).alias("_n"), F.first("_set").alias("_set"), F.first("_words").alias("_words")
    )
    texts = stored(texts, "texts")
    small = sum(map(len, prefixes)) * max(1, len(vocabulary)) <= BROADCAST_WORDS
    found = contained_templates(texts, sets, rare, small).groupBy("_k1", "_k2").agg(
        F.array_sort(F.collect_set("label")).alias("found_labels"), F.max("share").alias("_share")
    )
    found = stored(found, "found")
    total = slim.count()
    hot = texts.filter(is_hot("_n", total)).select("_k1", "_k2")
    maybe = join_hot(slim.filter("_set is not null"), found, ["_k1", "_k2"], hot, "left")
    plain = slim.filter("_set is null").withColumn("found_labels", F.lit(None).cast("array<string>"))
    whole = maybe.unionByName(plain.withColumn("_share", F.lit(None).cast("double")))
    return (
        whole.withColumn("found_labels", F.coalesce("found_labels", F.array().cast("array<string>")))
        .withColumn("score", F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_share", F.lit(0.0))))
        .drop("_k1", "_k2", "_set", "_words", "_share")
    )


def contained_templates(texts: DataFrame, sets: DataFrame, rare: list[str], small: bool) -> DataFrame:
    """Pairs of a text and a template that one of its blocks contains, with the largest share.

    `rare`: the words of all prefixes. `small`: the prefixes were counted to be few enough to broadcast.
    """
    index = sets.select(
        "template", "label", "length", "needed", F.col("set").alias("of"), F.posexplode("prefix").alias("at", "word")
    )
    shared = F.array_intersect("_set", F.array(*map(F.lit, rare)) if rare else F.array().cast("array<string>"))
    tokens = texts.select("_k1", "_k2", "_set", "_words", F.explode(shared).alias("word"))
    tokens = tokens.withColumn("place", F.array_position("_set", F.col("word")) - 1)
    pairs = tokens.join(F.broadcast(index) if small else index, "word")
    long_enough = F.size("_set") >= F.col("needed")
    left = 1 + F.least(F.size("of") - F.col("at") - 1, F.size("_set") - F.col("place") - 1)
    # The first shared word of the prefix stands for the pair, so each comes once.
    first = F.get(F.array_intersect("of", "_set"), F.lit(0)) == F.col("word")
    pairs = pairs.filter(long_enough & first & (left >= F.col("needed")))
    pairs = pairs.filter(F.size(F.array_intersect("of", "_set")) >= F.col("needed"))
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("_words") - 1, F.lit(0)), F.col("length")),
        lambda i: F.size(F.array_intersect("of", F.slice("_words", i + 1, 2 * F.col("length")))),
    )
    best = pairs.withColumn("most", F.array_max(blocks)).filter(F.col("most") >= F.col("needed"))
    return best.select("_k1", "_k2", "label", (F.col("most") / F.size("of")).alias("share"))
