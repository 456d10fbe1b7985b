"""License scans: phrase places and an exact set-similarity join against license templates.

Built on DataFrame functions only. Words are runs of a-z, 0-9 and non-ASCII
characters of the text with A-Z lower-cased.

Base scan: the places where the words of a known phrase stand one after
another. They are matched in the text and counted off by the words of the parts
between them, so no list of words is built.

Similarity join: a block is any run of consecutive words of the whole text, as
long as the template plus a quarter (at least two words, ten more for a "..."),
at every position; line breaks and comment marks are no words, so a wrapped
notice is one run, and words scattered over a long text are none. A block meets
a template if it holds at least ``containment`` of the template's distinct words
and the template's required phrases (in brackets), each word by word: they are
what tells sibling licenses apart. The join is exact. Template words are ordered
by their frequency over the pieces of all texts, rarest first; with the least
overlap a = ceil(containment * |T|),
- prefix filter: a block that meets T holds one of the first |T| - a + 1 words
  of T, so only blocks around places of these words are looked at;
- positional filter: a block is looked for from its rarest common word. If that
  is T's k-th, all it has in common are words of T from the k-th on, and a of
  them must lie less than a block's length to either side of the place;
- length filter: a block has a or more words (the last blocks of a text are
  short), and no more than the template allows.
The blocks that are left are verified one by one.

Long texts are read in pieces of PIECE_WORDS words, each with the words around
it that a block can reach, so what is held at once does not grow with the text.
Only words of the templates count, so the frequency table has at most as many
rows as the templates have words; it is the only result that passes the driver.

Defined cases: null and empty texts have no words and no labels (empty
strings), null first_word and last_word, score 0; very long and repetitive texts
are scanned whole; rows that repeat an id and text are scanned alike, rows with
one id and different texts separately; an empty table gives an empty result;
other columns of the input are not read.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_APART = r"\x00-\x2F\x3A-\x60\x7B-\x7F"  # between words, once A-Z are lower-cased
SEPARATORS, WORD = f"[{_APART}]+", f"[^{_APART}]+"

# Base phrases and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# Notices and grant sentences of public licenses. Words in brackets must stand in a block one after another;
# "..." leaves room for more words.
TEMPLATES = [
    ("mit", "Released under the [MIT License]"),
    ("mit", "[Permission is hereby granted], free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("apache-2", "Licensed under the [Apache License, Version 2].0"),
    ("apache-2", "You may obtain a copy of the License at http://www.apache.org/[licenses/LICENSE-2].0"),
    ("apache-2", "Unless [required by applicable law] or agreed to in writing, software distributed under the License "
                 "is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("cc-by-nc", "Licensed under [CC BY-NC 4].0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons [Attribution-NonCommercial 4].0 International License"),
    ("cc-by", "This work is licensed under a Creative [Commons Attribution 4].0 International License"),
    ("cc0", "To the [extent possible under law], the author has waived all copyright and related or neighboring rights"),
    ("gpl-2", "under the terms of the [GNU General Public License] as published by the Free Software Foundation; "
              "[either version 2] of the License"),
    ("gpl-3", "under the terms of the [GNU General Public License] as published by the Free Software Foundation, "
              "[either version 3] of the License"),
    ("lgpl", "under the terms of the [GNU Lesser General Public License] as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the [Mozilla Public License, v. 2.0]"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    # Short notices: up to nine distinct words, so all of them are needed.
    ("mit", "Licensed under the [MIT License]"),
    ("mit", "[MIT License] Copyright (c)"),
    ("apache-2", "[Apache License 2.0]"),
    ("apache-2", "[Apache License, Version 2.0]"),
    ("cc-by", "Creative [Commons Attribution 4.0]"),
    ("cc-by", "[CC BY 4.0]"),
    ("cc-by-nc", "Creative Commons [Attribution-NonCommercial 4.0]"),
    ("cc-by-nc", "Creative Commons [Attribution-Non-Commercial 4.0]"),
    ("cc-by-nc", "[CC BY-NC 4.0]"),
    ("cc0", "[CC0 1.0]"),
    ("cc0", "[Creative Commons Zero]"),
    ("cc0", "[Creative Commons CC0]"),
    ("gpl-2", "[GNU General Public License, version 2]"),
    ("gpl-2", "[version 2 of the GNU General Public License]"),
    ("gpl-2", "[GNU General Public License v2]"),
    ("gpl-2", "[GNU GPL version 2]"),
    ("gpl-2", "[GNU GPL v2]"),
    ("gpl-2", "[under the GPLv2]"),
    ("gpl-3", "[GNU General Public License, version 3]"),
    ("gpl-3", "[version 3 of the GNU General Public License]"),
    ("gpl-3", "[GNU General Public License v3]"),
    ("gpl-3", "[GNU GPL version 3]"),
    ("gpl-3", "[GNU GPL v3]"),
    ("gpl-3", "[under the GPLv3]"),
    ("lgpl", "[GNU Lesser General Public License]"),
    ("lgpl", "[GNU Library General Public License]"),
    ("lgpl", "[GNU LGPL]"),
    ("lgpl", "[under the LGPL]"),
    ("mpl-2", "[Mozilla Public License, version 2.0]"),
    ("mpl-2", "[Mozilla Public License, v. 2.0]"),
    ("mpl-2", "[Mozilla Public License 2.0]"),
    ("bsd", "under the [BSD License]"),
    ("bsd", "BSD [2-Clause] License"),
    ("bsd", "BSD [3-Clause] License"),
]
# Names of licenses in tags and in short notices.
NAMES = {
    "mit": ["MIT"], "apache-2": ["Apache-2.0"], "bsd": ["BSD"], "gpl-2": ["GPL-2.0", "GPLv2"], "gpl-3": ["GPL-3.0", "GPLv3"],
    "lgpl": ["LGPL"], "mpl-2": ["MPL-2.0"], "cc0": ["CC0-1.0"], "cc-by": ["CC-BY-4.0"], "cc-by-nc": ["CC-BY-NC-4.0"],
}
# The forms in which a name stands as the license, or as one of several.
FORMS = ["SPDX-License-[Identifier: {}]", "SPDX-License-Identifier: ... [OR {}]", "SPDX-License-Identifier: ... [AND {}]",
         "[Licensed under {}]", "[License: {}]"]
TEMPLATES += [(label, form.format(name)) for label, names in NAMES.items() for name in names for form in FORMS]
CONTAINMENT = 0.9
PIECE_WORDS = 512  # more than any block has
SHORT_CHARS = 1 << 14  # a text of so few characters is one piece
_PIECE = f"(?:[{_APART}]*+[^{_APART}]++){{1,{PIECE_WORDS}}}+"


def words_of(text: str) -> list[str]:
    """The words of a template, as the column expressions find them."""
    return [w for w in re.split(SEPARATORS, text.translate(str.maketrans(UPPER, LOWER))) if w]


def required_phrases(text: str) -> list[str]:
    """What stands in brackets, as words with a blank between them."""
    return [" ".join(words_of(phrase)) for phrase in re.findall(r"\[(.*?)\]", text)]


def block_words(text: str) -> int:
    """Words of a block for a template: a quarter more than the template has, at least two more, and ten for each "..."."""
    n = len(words_of(text))
    return n + max(2, -(-n // 4)) + 10 * text.count("...")


def _lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _words(lowered: Column) -> Column:
    spaced = F.trim(F.regexp_replace(lowered, SEPARATORS, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def _literals(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def template_table(frequency: dict[str, int], templates=None, containment: float = CONTAINMENT):
    """Per template: label, distinct words (rarest first), least overlap, prefix length, words of a block, required phrases."""
    rows = []
    for label, text in templates or TEMPLATES:
        words = sorted(set(words_of(text)), key=lambda w: (frequency.get(w, 0), w))
        least = math.ceil(containment * len(words) - 1e-9)
        rows.append((label, words, least, len(words) - least + 1, block_words(text), required_phrases(text)))
    if any(r[4] > PIECE_WORDS for r in rows):
        raise ValueError("a template's block is longer than a piece")
    return rows


def _pieces(lowered: Column) -> Column:
    """The text as strings of PIECE_WORDS words each (the last may have fewer); a short text as one."""
    return F.when(F.length(lowered) <= SHORT_CHARS, F.array(lowered)).otherwise(F.regexp_extract_all(lowered, F.lit(_PIECE), F.lit(0)))


def word_frequency(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Number of pieces that hold each of these words, over all texts."""
    pieces = docs.select(F.explode(_pieces(_lowered(F.col("text")))).alias("piece"))
    found = pieces.select(F.explode(F.array_intersect(_words(F.col("piece")), _literals(vocabulary))).alias("word"))
    return {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}


def similar_blocks(docs: DataFrame, templates=None, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, text_hash, at (first word), template, label and score of every block that meets a template."""
    spark = docs.sparkSession
    vocabulary = sorted({w for _, text in templates or TEMPLATES for w in words_of(text)})
    rows = template_table(word_frequency(docs, vocabulary), templates, containment)
    starters = sorted({w for _, words, _, prefix, _, _ in rows for w in words[:prefix]})
    reach = max(r[4] for r in rows) - 1
    # At most one row per template word: bounded by the templates. ``rest``: the words from this one on.
    prefixes = spark.createDataFrame(
        [(w, t, label, words, words[k:], least, size, phrases) for t, (label, words, least, prefix, size, phrases) in enumerate(rows)
         for k, w in enumerate(words[:prefix])],
        "starter string, template int, label string, t_words array<string>, rest array<string>, least int, block_size int, "
        "phrases array<string>")
    any_starter = rf"(?<![^{_APART}])(?:{'|'.join(map(re.escape, starters))})(?![^{_APART}])"
    held = (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _lowered(F.col("text")).alias("lowered"))
            .where(F.col("lowered").rlike(any_starter)))
    nothing = F.lit("")
    pieces = held.select("doc_id", "text_hash", _pieces(F.col("lowered")).alias("pieces")).select(
        "doc_id", "text_hash", F.posexplode(F.transform("pieces", lambda p, i: F.struct(
            F.coalesce(F.get("pieces", i - 1), nothing).alias("before"), p.alias("own"),
            F.coalesce(F.get("pieces", i + 1), nothing).alias("after")))).alias("number", "p"))
    pieces = pieces.where(F.col("p.own").rlike(any_starter)).select(
        "doc_id", "text_hash", "number", _words(F.col("p.own")).alias("own"), _words(F.col("p.before")).alias("before"),
        _words(F.col("p.after")).alias("after"))
    # The words of a piece with as many around it as a block can reach.
    lead = F.least(F.size("before"), F.lit(reach))
    pieces = pieces.select(
        "doc_id", "text_hash", (F.col("number") * PIECE_WORDS - lead).alias("base"), lead.alias("lead"), F.size("own").alias("n"),
        F.concat(F.slice("before", F.size("before") - lead + 1, lead), "own", F.slice("after", 1, reach)).alias("words"))
    places = F.filter(F.sequence(F.col("lead"), F.col("lead") + F.col("n") - 1), lambda i: F.get("words", i).isin(starters))
    # Each place goes on with the words within reach only.
    near = pieces.select("doc_id", "text_hash", "base", F.explode(F.transform(places, lambda i: F.struct(
        F.get("words", i).alias("starter"), i.alias("place"), F.greatest(i - reach, F.lit(0)).alias("low"),
        F.slice("words", F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)) + reach + 1).alias("near")))).alias("n"))
    first = F.greatest(F.col("place") - F.col("block_size") + 1, F.lit(0))
    met = (near.select("doc_id", "text_hash", "base", "n.*").join(F.broadcast(prefixes), "starter")
           .withColumn("near", F.slice("near", first - F.col("low") + 1, F.col("place") - first + F.col("block_size")))
           .where(F.size(F.array_intersect("near", "rest")) >= F.col("least"))  # positional filter
           .select("doc_id", "text_hash", "base", "template", "label", "t_words", "least", "block_size", "phrases", "near", first.alias("first"),
                   F.explode(F.sequence(first, F.col("place"))).alias("at"))
           .withColumn("block", F.slice("near", F.col("at") - F.col("first") + 1, F.col("block_size")))
           .where(F.size("block") >= F.col("least")))  # length filter
    overlap = F.size(F.array_intersect("t_words", "block"))
    spelled = F.concat(F.lit(" "), F.array_join("block", " "), F.lit(" "))
    told = F.forall("phrases", lambda phrase: F.contains(spelled, F.concat(F.lit(" "), phrase, F.lit(" "))))
    return (met.where((overlap >= F.col("least")) & told)
            .select("doc_id", "text_hash", (F.col("base") + F.col("at")).alias("at"), "template", "label",
                    (overlap / F.size("t_words")).alias("score")).distinct())


def _places(lowered: Column, phrase: str) -> Column:
    """Number, first and last word of the places of a phrase (which can't overlap itself), counted off by the words before."""
    words = phrase.split(" ")
    found = rf"(?<![^{_APART}])" + f"[{_APART}]+".join(words) + rf"(?![^{_APART}])"
    likely = lowered.rlike(found)
    for w in words:  # cheaper than the pattern where a word is missing
        likely = F.contains(lowered, F.lit(w)) & likely
    parts = F.transform(F.split(lowered, found, -1), lambda part: F.regexp_count(part, F.lit(WORD)))
    n = F.size(parts) - 1
    before_last = F.aggregate(F.slice(parts, 1, n), F.lit(0), lambda total, count: total + count)
    return F.when(likely, F.struct(n.alias("n"), F.get(parts, F.lit(0)).alias("first"), (before_last + (n - 1) * len(words)).alias("last")))


def scan(docs: DataFrame, templates=None, containment: float = CONTAINMENT, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per document: words, base places and labels, and the labels and score of the similarity join."""
    docs = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"coalesce(`{text_col}`, '') text")
    found = (similar_blocks(docs, templates, containment).groupBy("doc_id", "text_hash")
             .agg(F.collect_set("label").alias("more"), F.max("score").alias("best"))
             .withColumnRenamed("doc_id", "found_id").withColumnRenamed("text_hash", "found_hash"))
    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _lowered(F.col("text")).alias("lowered"))
    base = base.select("doc_id", "text_hash", F.regexp_count("lowered", F.lit(WORD)).cast("long").alias("n_words"),
                       *[_places(F.col("lowered"), p).alias(f"at{i}") for i, (p, _) in enumerate(PHRASES)])
    at = [F.col(f"at{i}") for i in range(len(PHRASES))]
    labels = F.array_compact(F.array(*[F.when(place.isNotNull(), label) for place, (_, label) in zip(at, PHRASES, strict=True)]))
    base = base.select("doc_id", "text_hash", "n_words", reduce(add, [F.coalesce(place["n"], F.lit(0)) for place in at]).alias("n_base"),
                       F.least(*[place["first"] for place in at]).alias("first_word"),
                       F.greatest(*[place["last"] for place in at]).alias("last_word"), F.array_distinct(labels).alias("base"))
    joined = base.join(found, F.col("doc_id").eqNullSafe(F.col("found_id"))
                       & (F.col("text_hash") == F.col("found_hash")), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id", "n_words", *[F.col(c).cast("long").alias(c) for c in ("n_base", "first_word", "last_word")],
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def oracle(templates=None, containment: float = CONTAINMENT) -> str:
    """DuckDB SQL of ``scan`` over the table documents: every block of words, at every position, against every template."""
    def words_sql(text):
        return rf"regexp_extract_all({text}, '{WORD}')"

    def places(phrase):
        test = " AND ".join(f"words[i + {k + 1}] = '{w}'" for k, w in enumerate(phrase.split(" ")))
        return f"list_filter(range(len(words)), lambda i: {test})"

    rows = template_table({}, templates, containment)
    values = ", ".join(f"({t}, '{label}', {sorted(words)}, {least}, {size}, {phrases}::VARCHAR[])"
                       for t, (label, words, least, _, size, phrases) in enumerate(rows))
    arrays = ", ".join(f"{places(p)} AS at{i}" for i, (p, _) in enumerate(PHRASES))
    every = "at0"
    for i in range(1, len(PHRASES)):
        every = f"list_concat({every}, at{i})"
    base = "[" + ", ".join(f"CASE WHEN len(at{i}) > 0 THEN '{label}' END" for i, (_, label) in enumerate(PHRASES)) + "]"
    return f"""
WITH t(template, label, words, least, size, phrases) AS (VALUES {values}),
w AS (SELECT row_number() OVER () AS r, doc_id, {words_sql(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS words FROM documents),
b AS (SELECT r, doc_id, words, {arrays} FROM w),
known AS (SELECT list_distinct(flatten(list(words))) AS words FROM t),
d AS MATERIALIZED (SELECT r, w.words, list_intersect(list_distinct(w.words), known.words) AS held FROM w, known),
c AS MATERIALIZED (SELECT r, d.words, template FROM d JOIN t ON len(list_intersect(held, t.words)) >= t.least),
k AS (SELECT r, words, template, unnest(range(len(words))) AS place FROM c),
blocks AS (SELECT r, t.*, k.words[k.place + 1:k.place + t.size] AS block FROM k JOIN t USING (template)),
hits AS (SELECT r, label, len(list_intersect(list_distinct(block), words)) / len(words) AS score FROM blocks
         WHERE len(list_intersect(list_distinct(block), words)) >= least
           AND len(list_filter(phrases, lambda p: NOT contains(' ' || array_to_string(block, ' ') || ' ', ' ' || p || ' '))) = 0),
best AS (SELECT r, list_distinct(list(label)) AS more, max(score) AS score FROM hits GROUP BY r),
p AS (SELECT r, doc_id, len(words) AS n_words, {every} AS places, list_filter({base}, lambda x: x IS NOT NULL) AS base FROM b)
SELECT p.doc_id, p.n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
       array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ',') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(best.score, 0)::DOUBLE END AS score
FROM p LEFT JOIN best USING (r)"""
