"""License scans: named phrases, and an exact similarity join of text blocks with license templates.

A block is a window of words that shares half of them with the next, so that any run of words as
long as the longest template lies whole in one. Blocks and templates are sets of words; a
template is found where a block holds ``threshold`` of its words. Only words of some template can
count, so blocks are cut down to those, and ordered by how many blocks of the corpus hold
them, rarest first. Of two sets that share ``c`` words the rarest shared one is among the first
``size - c + 1`` of each, which is what is joined; lengths and places bound the overlap
before it is counted. All of it is DataFrame expressions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLACES = "array<struct<place:bigint,label:string>>"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and the licenses they name.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)


class Template(NamedTuple):
    label: str
    text: str


# The public notices by which texts are put under a license.
TEMPLATES = (
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"
        " as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    Template(
        "gpl",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
        " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    Template(
        "apache",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
        " You may obtain a copy of the License at",
    ),
    Template(
        "apache",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,'
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
        ' (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,'
        " merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met",
    ),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed"
        " with this file, You can obtain one at",
    ),
    Template("public-domain", "This is free and unencumbered software released into the public domain"),
)


def template_words(text: str) -> list[str]:
    """Words of a template by the rule of ``words_of``."""
    return [w for w in re.split(NO_WORD, text.translate(str.maketrans(CAPITALS, SMALL))) if w]


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased, in order; of null none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), CAPITALS, SMALL), NO_WORD), "")


def places(words: Column, joined: Column, phrase: str, label: str) -> Column:
    """(place, label) of each place where the phrase's words follow each other; ``joined`` is the words with blanks around."""
    parts = phrase.split()
    starts = F.sequence(F.lit(0), F.size(words) - len(parts))

    def here(i: Column) -> Column:
        hit = F.lit(True)
        for k, part in enumerate(parts):
            hit = hit & (F.get(words, i + k) == part)
        return hit

    found = F.transform(F.filter(starts, here), lambda i: F.struct(i.cast("long").alias("place"), F.lit(label).alias("label")))
    # The text is searched first; the words are walked only where the phrase occurs.
    return F.when(joined.contains(f" {phrase} "), found).otherwise(F.array().cast(PLACES))


def need(size: int, percent: int) -> int:
    """Least common words that make ``percent`` in a hundred of ``size``."""
    return -(-size * percent // 100)


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[Template] = TEMPLATES,
    threshold: float = 0.8,
) -> DataFrame:
    """``keep``, n_words, n_base, first_word, last_word, base_labels, labels and score, one row per row.

    Places of phrases count as they stand; ``labels`` adds those of templates of which some block
    holds ``threshold`` (in hundredths) of the words. The score is 1 where a phrase is found, else the
    greatest share of a template found, else 0. Null and empty texts have no words, no places
    (first_word and last_word null), empty labels and score 0. Repeated rows stay rows; columns
    not named are not read. Templates are parameters: their words and first words go to
    all tasks, and are as many as the templates have.
    """
    results = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    common.no_clash(keep, (*results, "row"))
    percent = round(100 * threshold)
    sets = [sorted(set(template_words(t.text))) for t in templates]
    vocabulary = sorted(set().union(*sets))
    window = 2 * max((len(template_words(t.text)) for t in templates), default=1)
    least = min((need(len(s), percent) for s in sets if s), default=1)
    strings = lambda values: F.from_json(F.lit(json.dumps(values)), "array<string>")

    read = docs.select(*keep, words_of(F.col(text)).alias("words"))
    read = read.withColumn("joined", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    found = [places(F.col("words"), F.col("joined"), phrase, label) for phrase, label in phrases]
    n = F.size("words")
    # Windows of ``window`` words, each beginning half a window after the one before.
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(window // 2))
    blocks = F.transform(starts, lambda i: F.array_intersect(strings(vocabulary), F.slice("words", i + 1, window)))
    read = read.select(*keep, n.cast("long").alias("n_words"), F.concat(F.array().cast(PLACES), *found).alias("base"), F.filter(blocks, lambda b: F.size(b) >= least).alias("blocks"))
    rows = common.staged(read.withColumn("row", F.monotonically_increasing_id()), "license-rows")

    held = rows.select("row", F.explode("blocks").alias("block"))
    counts = held.select(F.explode("block").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    # One row per word of the templates, so a bounded number.
    frequency = {r["word"]: r["n"] for r in counts.collect()}
    ordered = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
    firsts = []
    for t, words in zip(templates, sets):
        words = sorted(words, key=ordered.index)
        for place, word in enumerate(words[: len(words) - need(len(words), percent) + 1] if words else []):
            firsts.append((word, t.label, words, place, need(len(words), percent)))
    index = docs.sparkSession.createDataFrame(firsts, "word string, label string, template array<string>, t_place int, need int")
    ranked = held.select("row", F.array_intersect(strings(ordered), "block").alias("block"))
    prefix = F.slice("block", 1, F.size("block") - least + 1)
    probes = ranked.select("row", "block", F.posexplode(prefix).alias("b_place", "word"))
    # What can still be shared behind the place in either set, the word itself counted.
    most = F.least(F.size("block") - F.col("b_place"), F.size("template") - F.col("t_place"))
    met = probes.join(F.broadcast(index), "word").filter((F.size("block") >= F.col("need")) & (most >= F.col("need")))
    both = F.size(F.array_intersect("block", "template"))
    links = met.withColumn("both", both).filter(F.col("both") >= F.col("need"))
    share = F.max(F.col("both") / F.size("template"))
    matches = links.groupBy("row").agg(share.alias("share"), F.collect_set("label").alias("more"))

    base = F.col("base")
    of_base = F.array_sort(F.array_distinct(F.transform(base, lambda p: p["label"])))
    place = F.transform(base, lambda p: p["place"])
    more = F.coalesce("more", F.array().cast("array<string>"))
    return rows.drop("blocks").join(matches, "row", "left").select(
        *keep, "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(place).alias("first_word"), F.array_max(place).alias("last_word"),
        F.array_join(of_base, ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(of_base, more)), ",").alias("labels"),
        F.when(F.size(base) > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(common.read(spark, sf_dir, "documents"))


def sql(threshold: float = 0.8) -> str:
    """The same rows by comparing every block with every template."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    phrases = ", ".join(f"('{p}', {len(p.split())}, '{label}')" for p, label in PHRASES)
    sets = [(sorted(set(template_words(t.text))), t.label) for t in TEMPLATES]
    templates = ", ".join(f"({quoted(words)}, '{label}')" for words, label in sets)
    half = max(len(template_words(t.text)) for t in TEMPLATES)
    percent = round(100 * threshold)
    return rf"""
        WITH phrases(p, size, label) AS (VALUES {phrases}),
        templates(t, label) AS (VALUES {templates}),
        texts AS MATERIALIZED (
            SELECT row_number() OVER () AS row, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ),
        words AS (SELECT row, unnest(w) AS w1, generate_subscripts(w, 1) - 1 AS i FROM texts),
        runs AS (SELECT row, i, w1, lead(w1) OVER a AS w2, lead(w1, 2) OVER a AS w3, lead(w1, 3) OVER a AS w4 FROM words WINDOW a AS (PARTITION BY row ORDER BY i)),
        base AS (
            SELECT row, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM runs, phrases
            WHERE p = CASE size WHEN 2 THEN w1 || ' ' || w2 WHEN 4 THEN w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 END GROUP BY row
        ),
        halves AS (SELECT row, i // {half} AS k, list(DISTINCT w1) AS b FROM words GROUP BY ALL),
        blocks AS (SELECT row, list_distinct(list_concat(b, lead(b, 1, []) OVER (PARTITION BY row ORDER BY k))) AS b FROM halves),
        found AS (SELECT row, label, len(list_intersect(b, t)) / len(t) AS share, 100 * len(list_intersect(b, t)) >= {percent} * len(t) AS ok FROM blocks, templates),
        more AS (SELECT row, max(share) AS share, list(DISTINCT label) AS labels FROM found WHERE ok GROUP BY row)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
               CAST(last_word AS BIGINT) AS last_word, coalesce(array_to_string(base.labels, ','), '') AS base_labels,
               coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ','), '') AS labels,
               CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
        FROM texts LEFT JOIN base USING (row) LEFT JOIN more USING (row)
    """


SQL = {"op13_licenses": sql()}
