"""License scans: an exact set-similarity join between blocks of text and the templates of licenses.

A template is the set of its words, a block the set of those of its words that any template has. With the
words ordered by their count over all documents, rare first, a block that holds at least c of a template's
n words holds one of the template's first n - c + 1 (prefix filter); the block must have c words (length
filter); and behind the first shared word both must have enough words left (positional filter). What is
left is verified word by word, phrases also place by place. Only DataFrame functions are used.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.tables import column_or, text_of, written

# Fixed value: what separates words once A-Z are lower-cased.
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The phrases that make a base label.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
# Opening words of public licenses and notices, and the percentage of their words that must be there.
NOTICES = (
    ("agpl", "gnu affero general public license", 100),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance"
               " with the license", 80),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"
            " the following conditions are met", 80),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", 90),
    ("cc-by-nc", "licensed under cc by nc", 100),
    ("cc-by-sa", "licensed under cc by sa", 100),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all"
            " of his or her rights to the work worldwide under copyright law", 80),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
            " public license as published by the free software foundation", 80),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
            " granted", 80),
    ("lgpl", "gnu lesser general public license", 100),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
            " documentation files the software to deal in the software without restriction", 80),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was"
            " not distributed with this file you can obtain one at", 80),
    ("unlicense", "this is free and unencumbered software released into the public domain", 90),
)
#: Blocks start every so many words and are twice as long, or more for a longer template.
LEAST_SPAN = 64


@dataclass(frozen=True)
class Template:
    """Words that tell a license: ``percent`` of the different ones in a block, or, for a phrase, all in a row."""

    label: str
    words: tuple[str, ...]
    percent: int
    phrase: bool

    @property
    def span(self) -> int:
        """A power of two: a text of the template's length that starts in one such stretch ends in the next at latest."""
        return max(LEAST_SPAN, 1 << (len(self.words) - 1).bit_length())


TEMPLATES = tuple(Template(label, tuple(text.split()), 100, True) for label, text in PHRASES) + tuple(
    Template(label, tuple(text.split()), percent, False) for label, text, percent in NOTICES)


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, APART, -1), "")


def ranked_words(docs: DataFrame, templates: tuple[Template, ...], text: str = "text") -> list[str]:
    """The words of all templates by their count over all documents, rare first; equal counts in code-point order."""
    known = sorted({w for t in templates for w in t.words})
    found = docs.select(F.explode(words_of(text_of(docs, text))).alias("w")).filter(F.col("w").isin(known))
    # One row for each word of the templates, whatever the input.
    counts = {r["w"]: r["count"] for r in found.groupBy("w").count().collect()}
    return sorted(known, key=lambda w: (counts.get(w, 0), w))


def _index(templates: tuple[Template, ...], rank: dict[str, int]) -> tuple[list[tuple], set[str]]:
    """A row for every prefix word of a template, and these words."""
    rows, prefix_words = [], set()
    order = sorted(rank, key=rank.get)
    for t in templates:
        words = sorted({rank[w] for w in t.words})
        need = max(1, -(-t.percent * len(words) // 100))
        for at, word in enumerate(words[:len(words) - need + 1]):
            rows.append((word, t.label, t.phrase, t.span, at, len(words), need, words, list(t.words)))
            prefix_words.add(order[word])
    return rows, prefix_words


_INDEX = ("word int, label string, phrase boolean, span int, i int, n int, need int, ranks array<int>, said array<string>")


def _blocks(words: Column, spans: list[int], prefix_words: list[str]) -> Column:
    """Blocks (span, at, words) that hold a prefix word; no other block can meet a template."""

    def of(span: int) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(words) - 1) / span).cast("int"))
        every = F.transform(starts, lambda k: F.struct(
            F.lit(span).alias("span"), (k * span).alias("at"), F.slice(words, k * span + 1, F.lit(2 * span)).alias("words")))
        return F.filter(every, lambda b: F.exists(b["words"], lambda w: w.isin(prefix_words)))

    some = F.exists(words, lambda w: w.isin(prefix_words))
    return F.when(some, F.concat(*[of(s) for s in spans]))


def _places(words: Column, said: Column, span: Column) -> Column:
    """Where the phrase starts, of the words that start in the first half of a block."""
    last = F.least(span, F.size(words) - F.size(said) + 1) - 1
    return F.when(last < 0, F.array().cast("array<int>")).otherwise(F.filter(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda p: F.slice(words, p + 1, F.size(said)) == said))


def scanned(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, key: str = "doc_id",
            text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every document as ``row, doc_id, n_words``, and its matches as ``row, label, phrase, at, share, places``.

    ``at`` is the first word of the matching block, from 0; a block is twice the template's span, and the next
    starts a span later, so any text as long as the template is whole in a block. ``share`` is the part of the template's
    different words found there; ``places`` are the words where a phrase starts (null for other templates). A text at
    the seam of two blocks is found in both; a place of a phrase only in one. Null and empty texts have no word and no
    match; rows without an id and repeated rows are documents of their own; a template without words matches nothing;
    other columns are left out.
    """
    templates = tuple(t for t in templates if t.words)
    order = ranked_words(docs, templates, text)
    rows, prefix_words = _index(templates, {w: i for i, w in enumerate(order)})
    spans = sorted({t.span for t in templates})
    spark = docs.sparkSession
    words = words_of(text_of(docs, text))
    blocks = F.array().cast("array<struct<span: int, at: int, words: array<string>>>")
    held = docs.select(F.monotonically_increasing_id().alias("row"), column_or(docs, key, "long").alias("doc_id"),
                       words.alias("_words"))
    base = written(held.select("row", "doc_id", F.size("_words").cast("long").alias("n_words"),
                               (_blocks(F.col("_words"), spans, sorted(prefix_words)) if spans else blocks).alias("blocks")),
                   "blocks")

    known = F.array(*[F.lit(w) for w in order]) if order else F.array().cast("array<string>")
    block = base.filter("blocks is not null").select("row", F.explode("blocks").alias("b")).select("row", "b.*")
    own = F.array_sort(F.transform(F.array_intersect("words", known), lambda w: (F.array_position(known, w) - 1).cast("int")))
    block = block.withColumn("own", own)
    # As many rows as the prefixes of all templates have words.
    index = F.broadcast(spark.createDataFrame(rows, _INDEX))
    met = block.select("*", F.posexplode("own").alias("j", "word")).join(index, ["word", "span"])
    first = F.size(F.array_intersect("own", F.slice("ranks", F.lit(1), F.col("i")))) == 0
    met = met.filter((F.size("own") >= F.col("need"))
                     & (F.least(F.col("n") - F.col("i"), F.size("own") - F.col("j")) >= F.col("need")) & first)
    shared = F.size(F.array_intersect("own", "ranks"))
    places = F.when(F.col("phrase"), F.transform(_places(F.col("words"), F.col("said"), F.col("span")),
                                                 lambda p: (p + F.col("at")).cast("long")))
    matches = (met.withColumn("shared", shared).filter("shared >= need")
               .select("row", "label", "phrase", F.col("at").cast("long").alias("at"), (F.col("shared") / F.col("n")).alias("share"),
                       places.alias("places"))
               .filter("not phrase or size(places) > 0"))
    return base.select("row", "doc_id", "n_words"), matches


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts all places of phrases, ``first_word`` and ``last_word`` are the least and greatest (null without
    any), ``base_labels`` those of phrases, ``labels`` those of all templates (sorted, comma-joined, empty without any);
    ``score`` is the greatest share of a template found, 0 without any. Ties of score need no order: it is a maximum.
    """
    base, matches = scanned(docs, templates)
    joined = lambda labels: F.array_join(F.array_sort(F.coalesce(labels, F.array().cast("array<string>"))), ",")
    # A row's matches are a few; rows are numbered, so no key is hot.
    found = matches.groupBy("row").agg(
        F.sum(F.when(F.col("phrase"), F.size("places")).otherwise(0)).alias("n_base"),
        F.min(F.array_min("places")).alias("first_word"), F.max(F.array_max("places")).alias("last_word"),
        F.collect_set(F.when(F.col("phrase"), F.col("label"))).alias("_base"), F.collect_set("label").alias("_all"),
        F.max("share").alias("score"))
    return base.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        joined(F.col("_base")).alias("base_labels"), joined(F.col("_all")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def query(docs: DataFrame) -> DataFrame:
    """``op13``: the licenses of every document."""
    return scan(docs.select("doc_id", "text"))


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
phrases(label, said) AS (SELECT label, string_split(said, ' ') FROM (VALUES {_values(list(PHRASES))}) v(label, said)),
notices(label, said, percent) AS (
  SELECT label, list_distinct(string_split(said, ' ')), percent FROM (VALUES {_values(list(NOTICES))}) v(label, said, percent)),
starts AS (SELECT r, words, unnest(range(0, len(words))) AS p FROM d),
places AS (
  SELECT r, label, p FROM starts JOIN phrases ON words[p + 1] = said[1] AND words[p + 1:p + len(said)] = said),
blocks AS (SELECT r, words[p + 1:p + {2 * LEAST_SPAN}] AS b FROM starts WHERE p % {LEAST_SPAN} = 0),
shares AS (
  SELECT r, label, percent, len(said) AS n, len(list_intersect(said, list_distinct(b))) AS k FROM blocks CROSS JOIN notices),
hits AS (
  SELECT r, label, true AS phrase, p, CAST(1 AS DOUBLE) AS share FROM places
  UNION ALL SELECT r, label, false, NULL, CAST(k AS DOUBLE) / n FROM shares WHERE 100 * k >= percent * n),
found AS (
  SELECT r, count(p) AS n_base, min(p) AS first_word, max(p) AS last_word,
         list_sort(list_distinct(list(label) FILTER (phrase))) AS base, list_sort(list_distinct(list(label))) AS every,
         max(share) AS score FROM hits GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(base, ','), '') AS base_labels, coalesce(array_to_string(every, ','), '') AS labels,
       coalesce(score, CAST(0 AS DOUBLE)) AS score
FROM d LEFT JOIN found USING (r)
"""
