"""License scan by exact set-similarity join, in DataFrame functions only.

Base labels come from phrases whose words stand consecutively. The method finds whole notices: a block of ``BLOCK``
words (one begins every ``BLOCK / 2`` words, so a notice of up to half a block lies in one) gets a template's label if it
holds at least ``THRESHOLD`` of the template's distinct words.

1. Texts are split into words once; kept are the places of words that occur in a template or phrase, one long a place.
2. Those words are ordered by the number of documents that hold them, rarest first (counted over all documents).
3. With a = ceil(THRESHOLD * size), a template's prefix is its first size - a + 1 words in that order. A block that
   reaches a words of the template holds one of them, so only documents with a prefix word go on (prefix filter).
4. Their words are grouped by block (at most ``BLOCK`` words) as sorted ranks. Blocks of fewer known words than the
   least a go (length filter). A block's prefix words are joined with the templates' by rank, and a pair stays if the
   words after the match, on either side, can still reach a (positional filter). Pairs that stay are compared exactly.

Words: A-Z lower-cased, then ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; places count from 0. The score is 1 where a base phrase
stands, else the greatest share of a template found in a block that reached the threshold, else 0.

Defined results: a null or wordless text has no words, places or labels (score 0, empty strings); rows that repeat an
id and a text share their result, rows that share only an id are judged apart; templates of equal label are one label;
texts are read whole; an empty table gives no rows. Other columns are left unread, whatever their names.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm.common import broadcast_within, settle
from claimflow.llm.winnowing import words_of

BLOCK = 128
THRESHOLD = 0.9
CODE_BITS = 24
MASK = (1 << CODE_BITS) - 1
MAX_BROADCAST_ROWS = 500_000  # of an id, a hash and a few labels

# fixed values of the contract
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# opening passages of well-known license notices, at most BLOCK / 2 words each
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
               "the license you may obtain a copy of the license at"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation either version 3 of the license or at your option any later "
            "version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met redistributions of source code must retain the above copyright notice this list of "
            "conditions and the following disclaimer"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
            "distributed with this file you can obtain one at"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish "
                  "use compile sell or distribute this software"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
]


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def needed(size: int, threshold: float) -> int:
    """Words of a template that a block must hold."""
    return max(1, math.ceil(round(threshold * size, 9)))


def codes(spark: SparkSession, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """A stretch of the words' hashes in which all of them differ: where it begins, and each word's value."""
    hashed = {r[0]: r[1] for r in spark.createDataFrame([(w,) for w in vocabulary], "w string").select("w", F.xxhash64("w")).collect()}
    for shift in range(64 - CODE_BITS + 1):
        got = {w: (h % (1 << 64) >> shift) & MASK for w, h in hashed.items()}
        if len(set(got.values())) == len(vocabulary):
            return shift, got
    raise ValueError("the vocabulary is too large for its codes")


def places(words: Column, vocabulary: list[str], shift: int) -> Column:
    """One long for each word of the vocabulary in the text: its place, then its code."""
    def packed(w, i):
        code = F.shiftrightunsigned(F.xxhash64(w), shift).bitwiseAND(F.lit(MASK))
        return F.when(w.isin(vocabulary), F.shiftleft(i.cast("long"), CODE_BITS).bitwiseOR(code))

    return F.filter(F.transform(words, packed), lambda x: x.isNotNull())


def starts(hits: str, phrase: list[int]) -> Column:
    """Places where the codes of a phrase stand consecutively."""
    def begins(x, j):
        here = x.bitwiseAND(F.lit(MASK)) == phrase[0]
        for k, code in enumerate(phrase[1:], 1):
            here = here & (F.get(F.col(hits), j + k) == x + ((k << CODE_BITS) + code - phrase[0]))
        return F.when(here, F.shiftright(x, CODE_BITS))

    return F.filter(F.transform(hits, begins), lambda x: x.isNotNull())


def joined(known: DataFrame, templates: list[tuple[str, list[str]]], code: dict[str, int], threshold: float) -> DataFrame:
    """(id, t, labels, score) of the texts that hold a block reaching a template's threshold."""
    spark = known.sparkSession
    held = {r[0]: r[1] for r in known.select(F.explode(F.array_distinct(F.transform("hits", lambda x: x.bitwiseAND(F.lit(MASK))))).alias("c"))
            .groupBy("c").count().collect()}  # at most the vocabulary
    order = sorted(code, key=lambda w: (held.get(code[w], 0), w))
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for no, (label, words) in enumerate(templates):
        ranks = sorted(rank[w] for w in set(words))
        rows.append((no, label, ranks, needed(len(ranks), threshold)))
    prefix = [(r, no, i, len(ranks), a) for no, _, ranks, a in rows for i, r in enumerate(ranks[: len(ranks) - a + 1])]
    of_template = {rank[w] for _, words in templates for w in words}
    by_rank = spark.createDataFrame([(code[w], r) for w, r in rank.items() if r in of_template], "c long, r int")
    prefixes = spark.createDataFrame(prefix, "r int, no int, i int, n int, a int")
    whole = spark.createDataFrame(rows, "no int, label string, wanted array<int>, a int")

    rare = sorted({code[order[r]] for r, *_ in prefix})
    some = known.where(F.exists("hits", lambda x: x.bitwiseAND(F.lit(MASK)).isin(rare)))
    half = F.lit(BLOCK // 2)
    place = F.shiftright("x", CODE_BITS)
    blocks = (some.select("id", "t", F.explode("hits").alias("x"))
              .select("id", "t", F.floor(place / half).alias("b"), F.col("x").bitwiseAND(F.lit(MASK)).alias("c"))
              .join(F.broadcast(by_rank), "c")
              .select("id", "t", "r", F.explode(F.array(F.col("b"), F.col("b") - 1)).alias("b")).where("b >= 0")
              .groupBy("id", "t", "b").agg(F.array_sort(F.collect_set("r")).alias("ranks"))
              .where(F.size("ranks") >= min(a for *_, a in rows)))
    left = F.size("ranks") - F.col("j") - 1
    pairs = (blocks.select("id", "t", "b", "ranks", F.posexplode("ranks").alias("j", "r")).join(F.broadcast(prefixes), "r")
             .where(F.least(left, F.col("n") - F.col("i") - 1) + 1 >= F.col("a"))
             .select("id", "t", "b", "no", "ranks").dropDuplicates(["id", "t", "b", "no"]))
    shared = F.size(F.array_intersect("ranks", "wanted"))
    return (pairs.join(F.broadcast(whole), "no").where(shared >= F.col("a"))
            .groupBy("id", "t").agg(F.collect_set("label").alias("labels"), F.max(shared / F.size("wanted")).alias("score")))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES,
         id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    texts = [(label, template_words(t)) for label, t in templates]
    asked = [(template_words(p), label) for p, label in phrases]
    if any(len(words) > BLOCK // 2 or not words for _, words in texts):
        raise ValueError(f"a template has 1 to {BLOCK // 2} words")
    vocabulary = sorted({w for _, words in texts for w in words} | {w for words, _ in asked for w in words})
    shift, code = codes(docs.sparkSession, vocabulary)
    split = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("t"),
                        words_of(F.col(text_col)).alias("words"))
    known = settle(split.select("id", "t", F.size("words").cast("long").alias("n_words"), places(F.col("words"), vocabulary, shift).alias("hits")))
    found = [(f"s{n}", words, label) for n, (words, label) in enumerate(asked)]
    base = known.select("id", "t", "n_words", *[starts("hits", [code[w] for w in words]).alias(s) for s, words, _ in found])
    every = F.concat(*[F.col(s) for s, *_ in found])
    named = F.filter(F.array_distinct(F.array(*[F.when(F.size(s) > 0, F.lit(label)) for s, _, label in found])), lambda x: x.isNotNull())
    base = base.select("id", "t", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).alias("first_word"),
                       F.array_max(every).alias("last_word"), F.array_sort(named).alias("named"))
    notices = joined(known, texts, code, threshold) if texts else None
    if notices is None:
        told = base.withColumns({"found": F.array().cast("array<string>"), "share": F.lit(0.0)})
    else:
        notices = broadcast_within(settle(notices).select(F.col("id").alias("id2"), F.col("t").alias("t2"), F.col("labels").alias("found"),
                                                          F.col("score").alias("share")), MAX_BROADCAST_ROWS)
        told = base.join(notices, (F.col("t") == F.col("t2")) & F.col("id").eqNullSafe(F.col("id2")), "left")
    labels = F.array_sort(F.array_union("named", F.coalesce("found", F.array().cast("array<string>"))))
    return told.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
                       F.array_join("named", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                       F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))


def oracle_sql() -> str:
    """The registered query in DuckDB SQL: every block against every template, without filters."""
    values = []
    for no, (label, text) in enumerate(TEMPLATES):
        words = sorted(set(template_words(text)))
        values += [f"({no}, '{label}', '{w}', {len(words)}, {needed(len(words), THRESHOLD)})" for w in words]
    lists = ", ".join(f"[i for i in range(len(w)) if {' AND '.join(f'w[i + {k}] = {chr(39)}{x}{chr(39)}' for k, x in enumerate(p.split(), 1))}] AS s{n}"
                      for n, (p, _) in enumerate(PHRASES))
    every = " || ".join(f"s{n}" for n in range(len(PHRASES)))
    named = " || ".join(f"CASE WHEN len(s{n}) > 0 THEN ['{label}'] ELSE [] END" for n, (_, label) in enumerate(PHRASES))
    return rf"""
WITH tw(no, label, word, n, a) AS (VALUES {', '.join(values)}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT r, doc_id, len(w) AS n_words, {lists} FROM d),
base AS (SELECT r, doc_id, n_words, {every} AS places, list_sort({named}) AS named FROM s),
p AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
b AS (SELECT DISTINCT r, word, unnest([i // {BLOCK // 2}, i // {BLOCK // 2} - 1]) AS b FROM p WHERE word IN (SELECT word FROM tw)),
o AS (SELECT r, b, no, label, count(*) AS k, any_value(n) AS n FROM b JOIN tw USING (word) WHERE b >= 0 GROUP BY r, b, no, label HAVING count(*) >= any_value(a)),
best AS (SELECT r, list(DISTINCT label) AS found, max(k / n) AS share FROM o GROUP BY r)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
  array_to_string(named, ',') AS base_labels, array_to_string(list_sort(list_distinct(named || coalesce(found, []))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM base LEFT JOIN best USING (r)
"""
