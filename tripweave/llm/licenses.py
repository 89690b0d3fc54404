"""Scan for licence notices: phrases, and an exact set-similarity join of text blocks with templates.

A block is a sentence, which may go over line ends but not over a blank line; for templates of at least PARAGRAPH_WORDS distinct
words a whole run of non-blank lines is a block too. A block meets a template when it holds at least THRESHOLD of the
template's distinct words. The join follows the prefix filter: words in the order of their frequency in the corpus, rarest first; a block that
meets a template must hold one of the template's rarest words, as many as may be missing and one more. Of blocks with such a
word, length and position bound what can still be shared before anything is counted. No block is missed.

DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import blank, staged

#: The phrases whose places are counted, with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
THRESHOLD = 0.8
#: Templates by label, short public notices and passages of public licences, as words.
TEMPLATES = {
    "mit": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files to deal in the software without restriction including without limitation the rights to use copy "
        "modify merge publish distribute sublicense and or sell copies of the software",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties "
        "of merchantability fitness for a particular purpose and noninfringement",
    ),
    "apache": (
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 you may not use this file except in compliance with the license you may "
        "obtain a copy of the license at http www apache org licenses license 2 0",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is "
        "basis without warranties or conditions of any kind either express or implied",
    ),
    "gpl": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation",
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
        "merchantability or fitness for a particular purpose",
    ),
    "lgpl": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
        "license as published by the free software foundation",
    ),
    "agpl": ("licensed under the gnu affero general public license version 3",),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
        "that the above copyright notice and this permission notice appear in all copies",
    ),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
    "zlib": (
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and "
        "redistribute it freely subject to the following restrictions",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission",
    ),
    "cc": ("licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution 4 0 international license"),
}
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What divides a text into paragraphs, and into sentences.
PARAGRAPH_END = r"\n[ \t-\r]*\n"
SENTENCE_END = rf"{PARAGRAPH_END}|[.!?][ \t-\r]"
#: Templates with fewer distinct words are looked for in sentences: many sentences together may hold so few words by chance.
PARAGRAPH_WORDS = 12


def _words(lowered: Column) -> Column:
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def _places(words: Column, phrase: str) -> Column:
    """Positions where the phrase's words stand one after the other."""
    parts = phrase.split(" ")

    def stands(i: Column) -> Column:
        out = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            out = out & (F.get(words, i + k) == part)
        return out

    starts = F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), stands)
    return F.when(F.size(words) >= len(parts), starts).otherwise(F.array().cast("array<int>"))


def _needed(size: int, threshold: float) -> int:
    """Words that a block must share with a template of so many words."""
    return next(k for k in range(size + 1) if k >= threshold * size - 1e-9)


def frequency_order(docs: DataFrame, text_col: str, words: list[str]) -> list[str]:
    """These words, those in the fewest texts first."""
    own = F.array(*map(F.lit, words))
    found = docs.select(F.explode(F.array_intersect(_words(F.lower(blank(F.col(text_col)))), own)).alias("word"))
    counts = {r.word: r.n for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}  # the templates' words at most
    return sorted(words, key=lambda w: (counts.get(w, 0), w))


def scan(docs: DataFrame, templates: Mapping[str, tuple[str, ...]] | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Phrases and templates in every whole text, one row for each row of `docs`:

    doc_id, n_words, n_base (places of phrases), first_word, last_word (smallest and largest place, words from 0), base_labels,
    labels (those of templates too), score (1 with a phrase, else the largest share of a template's words that a block
    holds, 0 if none reaches the threshold). A null text counts as empty. Rows that repeat an id are scanned one by one;
    further columns don't matter; a table without rows gives none.
    """
    templates = TEMPLATES if templates is None else templates
    sets = {(label, n): sorted(set(t.split())) for label, texts in templates.items() for n, t in enumerate(texts)}
    order = frequency_order(docs, text_col, sorted({w for words in sets.values() for w in words}))
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for (label, n), words in sets.items():
        needed = _needed(len(words), threshold)
        for place, word in enumerate(sorted(words, key=rank.get)):
            if place <= len(words) - needed:
                rows.append((f"{label}-{n}", label, sorted(words, key=rank.get), needed, word, place))
    prefixes = docs.sparkSession.createDataFrame(rows, "template string, label string, template_words array<string>, needed int, word string, place int")

    # A text without a rare template word and without a phrase's first word has nothing to find. Lower case by Unicode may
    # turn other letters into ASCII ones, so it finds no fewer such words than A-Z alone; the words' number is the same.
    signs = sorted({r[4] for r in rows} | {p.split(" ")[0] for p in PHRASES})
    text = blank(F.col(text_col))
    # Lower case and words are worked out once for each text.
    found = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), _words(F.lower(text)).alias("words"))
    found = found.select("doc_id", F.size("words").cast("long").alias("n_words"), F.when(F.arrays_overlap("words", F.array(*map(F.lit, signs))), F.col("text")).alias("text"))
    found = staged(found.withColumn("uid", F.monotonically_increasing_id()))
    some = found.filter("text is not null")

    # Staged, so that the search for places reads the words instead of dividing the text anew at each place.
    words = staged(some.select("uid", _words(F.translate("text", UPPER, LOWER)).alias("words")))
    places = words.select("uid", *(_places(F.col("words"), p).alias(label) for p, label in PHRASES.items()))
    every = F.concat(*PHRASES.values())
    based = places.select(
        "uid",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.filter(F.array(*(F.when(F.size(label) > 0, F.lit(label)) for label in sorted(PHRASES.values()))), lambda x: x.isNotNull()).alias("base"),
    ).filter("n_base > 0")

    met = blocks_that_meet(some, prefixes, order)
    added = met.groupBy("uid").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))  # as many as labels
    none = F.array().cast("array<string>")
    joined = found.drop("text").join(based, "uid", "left").join(added, "uid", "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.array_join(F.coalesce("base", none), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(F.coalesce("base", none), F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def blocks_that_meet(texts: DataFrame, prefixes: DataFrame, order: list[str]) -> DataFrame:
    """(uid, template, label, share) for each block of `texts` (uid, text) and template that it meets."""
    lowered = F.translate("text", UPPER, LOWER)
    kinds = F.concat(F.transform(F.split(lowered, SENTENCE_END), lambda b: F.struct(F.lit(0).alias("kind"), b.alias("block"))), F.transform(F.split(lowered, PARAGRAPH_END), lambda b: F.struct(F.lit(1).alias("kind"), b.alias("block"))))
    blocks = texts.select("uid", F.posexplode(kinds).alias("n", "one"))
    # Of a block, only template words matter; array_intersect gives them in the order of its first argument: rarest first.
    own = F.array(*map(F.lit, order))
    blocks = blocks.select("uid", "n", "one.kind", F.array_intersect(own, _words(F.col("one.block"))).alias("shared")).filter(F.size("shared") > 0)
    tokens = blocks.select("uid", "kind", "shared", F.posexplode("shared").alias("at", "word"))
    size = F.size("template_words")
    fits = (
        (F.size("shared") >= F.col("needed"))
        & (F.lit(1) + F.least(size - F.col("place") - 1, F.size("shared") - F.col("at") - 1) + F.least("place", "at") >= F.col("needed"))
        & ((F.col("kind") == 0) | (size >= PARAGRAPH_WORDS))
    )
    # The prefixes are a few hundred rows, as many as the templates' words at most.
    candidates = tokens.join(F.broadcast(prefixes), "word").filter(fits)
    share = F.size(F.array_intersect("shared", "template_words"))
    return candidates.withColumn("both", share).filter(F.col("both") >= F.col("needed")).select("uid", "template", "label", (F.col("both") / size).alias("share"))


def scan_sql() -> str:
    """DuckDB's way to the rows of scan(documents): every block against every template."""
    values = ", ".join(f"('{label}', {sorted(set(t.split()))})" for label, texts in TEMPLATES.items() for t in texts)
    phrases = ", ".join(f"('{label}', {phrase.split(' ')})" for phrase, label in PHRASES.items())
    return rf"""
WITH doc AS (SELECT row_number() OVER () AS uid, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents),
worded AS (SELECT uid, doc_id, text, list_filter(regexp_split_to_array(text, '{NOT_WORD}'), lambda w: w <> '') AS words FROM doc),
phrase(label, parts) AS (VALUES {phrases}),
place AS (SELECT uid, label, unnest(list_filter(range(0, len(words) - len(parts) + 1), lambda i: words[i + 1 : i + len(parts)] = parts)) AS pos
  FROM worded JOIN phrase ON list_contains(words, parts[1])),
based AS (SELECT uid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS base FROM place GROUP BY uid),
template(label, parts) AS (VALUES {values}),
block AS (
  SELECT uid, 0 AS kind, unnest(regexp_split_to_array(text, '{SENTENCE_END}')) AS block FROM doc
  UNION ALL SELECT uid, 1, unnest(regexp_split_to_array(text, '{PARAGRAPH_END}')) FROM doc),
bag AS (SELECT DISTINCT uid, kind, list_distinct(regexp_split_to_array(block, '{NOT_WORD}')) AS words FROM block),
met AS (SELECT uid, label, len(list_intersect(words, parts)) / len(parts) AS share FROM bag JOIN template
  ON list_has_any(words, parts) AND (kind = 0 OR len(parts) >= {PARAGRAPH_WORDS}) WHERE len(list_intersect(words, parts)) >= {THRESHOLD} * len(parts) - 1e-9),
added AS (SELECT uid, list(DISTINCT label) AS more, max(share) AS share FROM met GROUP BY uid)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0) END AS score
FROM worded LEFT JOIN based USING (uid) LEFT JOIN added USING (uid)
"""
