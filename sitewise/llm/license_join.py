r"""License scan as an exact set-similarity join of text windows with templates.

A template is the text of a licence notice.  A document meets it where some
window of running words, as long as the template's words over CONTAINMENT
percent, holds at least that share of its distinct words; lines do not matter.
Every text is taken into words once.  A text that holds too few of every
template's words anywhere is done with; the words of the others are cut into
overlapping blocks, so that every window lies in one.  Words have one global
order, from the rarest in the corpus, and three filters leave few pairs of a
block and a template to verify window by window:

* prefix: a qualifying block holds one of the template's first
  size - need + 1 words in that order;
* length: it has at least need distinct words;
* position: words that the block lacks ahead of the rarest one it has count
  against the template, the rest must still reach need.

The join alone decides what is found.  Licences of a family share most of
their words, so a find is named by its MARK, words that only this template has
among its relatives: with the mark in a qualifying window it has the
template's label; without one in the family, neither found nor a base phrase,
it is named as like the family (``bsd-like``); beside a named relative it is
that relative's text.  DataFrame expressions only.
"""

from __future__ import annotations

import re
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, materialize

CONTAINMENT = 80

# fixed values: the phrases and labels of the contract
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# fixed values: opening words of common licence notices
TEMPLATES = [
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
]

# what tells a template from its relatives, in words joined by a blank; one a template
MARKS = [
    "gnu general public license", "gnu general public license", "gnu lesser general public license",
    "apache license", "except in compliance with the license", "mit", "associated documentation files",
    "source and binary forms", "with or without fee", "mozilla public license",
    "creative commons attribution (?:[0-9]+|international|license)", "cc by nc", "cc by (?:nc )?sa",
]

# labels whose texts are near each other; any other label is a family of its own
FAMILIES = {"gpl": "gpl", "lgpl": "gpl", "cc-by": "cc", "cc-by-nc": "cc", "cc-by-sa": "cc"}

_SEP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_IN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> list[str]:
    return re.findall(f"{_IN}+", text.translate(str.maketrans(_UPPER, _LOWER)))


def _any_of(phrases: list[str]) -> str:
    each = "|".join(f"{_SEP}+".join(p.split()) for p in phrases)
    return f"(?i)(?<!{_IN})(?:{each})(?!{_IN})"


def count_words(text: "F.Column") -> "F.Column":
    return F.coalesce(F.regexp_count(text, F.lit(f"{_IN}+")).cast("long"), F.lit(0).cast("long"))


def word_list(text: "F.Column") -> "F.Column":
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(f"({_IN}+)"), 1)


def _label(place: "F.Column") -> "F.Column":
    out = F.lit(None).cast("string")
    for phrase, name in PHRASES.items():  # their first letters differ
        out = F.when(F.lower(F.substring(place, 1, 1)) == phrase[0], name).otherwise(out)
    return out


def phrase_places(text: "F.Column", n_words: "F.Column") -> list["F.Column"]:
    """n_base, first_word, last_word and phrase_labels of a text.  Phrases
    cannot overlap: none begins with a word that another ends with."""
    pattern = _any_of(list(PHRASES))
    # a cheap test decides which texts the pattern runs on; each phrase has one of these
    may = text.rlike(r"[Ll][Ii][Cc][Ee][Nn][Ss][Ee]|[Cc][Cc]" + _SEP + "+[Bb][Yy]")
    found = F.when(may, F.regexp_extract_all(text, F.lit(f"({pattern})"), 1))
    hit = F.coalesce(F.size(found) > 0, F.lit(False))
    parts = F.when(hit, F.split(text, pattern, -1))
    final = count_words(F.element_at(parts, -1)) + count_words(F.element_at(found, -1))
    return [F.when(hit, F.size(found)).otherwise(0).cast("long").alias("n_base"), F.when(hit, count_words(F.element_at(parts, 1))).alias("first_word"),
            F.when(hit, n_words - final).alias("last_word"), F.when(hit, F.array_distinct(F.transform(found, _label))).otherwise(F.array().cast("array<string>")).alias("phrase_labels")]


def window_words(template: str) -> int:
    """Words that a notice may spread over: CONTAINMENT percent of them can be the template's."""
    return -(-len(_words(template)) * 100 // CONTAINMENT)


def needs() -> list[tuple[list[str], int]]:
    """Distinct words of each template and how many of them a window must hold."""
    out = []
    for _, t in TEMPLATES:
        words = sorted(set(_words(t)))
        out.append((words, -(-len(words) * CONTAINMENT // 100)))
    return out


def _list(words: list[str]) -> "F.Column":
    return F.array(*map(F.lit, words))


def taken_apart(docs: DataFrame) -> DataFrame:
    """A written table: doc_id, rk, n_words, the phrase columns, known (the
    template words in the text) and, where the whole text holds enough words
    of some template, its words in order."""
    every = sorted({w for words, _ in needs() for w in words})
    rows = docs.select("doc_id", "rk", "text", F.coalesce(word_list(F.col("text")), F.array().cast("array<string>")).alias("all"))
    rows = rows.select("*", F.size("all").cast("long").alias("n_words"), F.array_intersect("all", _list(every)).alias("known"))
    reach = F.lit(False)
    for words, need in needs():
        reach = reach | (F.size(F.array_intersect("known", _list(words))) >= need)
    return materialize(rows.select("doc_id", "rk", "n_words", *phrase_places(F.col("text"), F.col("n_words")), "known", F.when(reach, F.col("all")).alias("words")))


def template_order(rows: DataFrame) -> dict[str, int]:
    """Place of each template word in the order of document frequency, counted
    over all documents; as many rows as the templates have words."""
    count = {r["w"]: r["n"] for r in rows.select(F.explode("known").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    known = sorted({w for words, _ in needs() for w in words})
    return {w: k for k, w in enumerate(sorted(known, key=lambda w: (count.get(w, 0), w)))}


def template_matches(rows: DataFrame) -> DataFrame:
    """doc_id, rk, template, share (words of the template that the best window
    holds) and marked (its mark stands in a window that holds enough), for
    every template that a text of ``taken_apart`` meets."""
    stride = max(window_words(t) for _, t in TEMPLATES)
    begins = F.sequence(F.lit(1), F.greatest(F.size("words") - stride, F.lit(1)), F.lit(stride))
    blocks = rows.where("words IS NOT NULL").select("doc_id", "rk", F.explode(F.transform(begins, lambda b: F.slice("words", b, F.lit(2 * stride)))).alias("block"))
    pairs = _candidates(blocks, template_order(rows))
    pairs = pairs.withColumn("size", F.element_at(F.array(*[F.lit(window_words(t)) for _, t in TEMPLATES]), F.col("template") + 1))
    pairs = pairs.withColumn("mark", F.element_at(F.array(*[F.lit(f" (?:{m}) ") for m in MARKS]), F.col("template") + 1))

    def held(begin: "F.Column") -> "F.Column":
        return F.size(F.array_intersect("words", F.slice("block", begin, F.col("size"))))

    def marked(begin: "F.Column") -> "F.Column":
        window = F.slice("block", begin, F.col("size"))
        return F.regexp_like(F.concat(F.lit(" "), F.array_join(window, " "), F.lit(" ")), F.col("mark"))

    starts = F.sequence(F.lit(1), F.greatest(F.size("block") - F.col("size") + 1, F.lit(1)))
    pairs = pairs.withColumn("at", F.filter(F.transform(starts, lambda b: F.struct(b.alias("b"), held(b).alias("share"))), lambda x: x["share"] >= F.col("need"))).where(F.size("at") > 0)
    return pairs.select("doc_id", "rk", "template", F.array_max(F.transform("at", lambda x: x["share"])).alias("share"), F.exists("at", lambda x: marked(x["b"])).alias("marked")).groupBy(
        "doc_id", "rk", "template").agg(F.max("share").alias("share"), F.max("marked").alias("marked"))


def _candidates(blocks: DataFrame, order: dict[str, int]) -> DataFrame:
    """Pairs of a block (doc_id, rk, block: words in order) and a template whose words it holds in the share needed."""
    index, prefixes = [], set()
    for k, (known, need) in enumerate(needs()):
        words = sorted(known, key=order.__getitem__)
        for place, w in enumerate(words[:len(words) - need + 1]):
            index.append(F.struct(F.lit(w).alias("word"), F.lit(k).alias("template"), _list(words).alias("words"), F.lit(need).alias("need"), F.lit(place).alias("place")))
            prefixes.add(w)
    inverted = blocks.sparkSession.range(1).select(F.inline(F.array(*index)))  # a few rows a template
    blocks = blocks.withColumn("tokens", F.array_distinct("block"))
    blocks = blocks.withColumn("hit", F.array_intersect("tokens", _list(sorted(prefixes)))).where(F.size("hit") > 0)
    pairs = blocks.withColumn("token", F.explode("hit")).join(inverted, F.col("token") == F.col("word"))
    pairs = pairs.where(F.size("tokens") >= F.col("need"))  # length
    # position: this is the block's rarest word of the template, and what follows it is enough
    rarest = F.size(F.array_intersect(F.slice("words", F.lit(1), F.col("place")), "tokens")) == 0
    pairs = pairs.where(rarest & (F.size("words") - F.col("place") >= F.col("need")))
    return pairs.where(F.size(F.array_intersect("words", "tokens")) >= F.col("need"))


def _family(label: str) -> str:
    return FAMILIES.get(label, label)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document with the contract's columns.  Null counts as an
    empty text: no words, no places, empty labels, score 0.  Repeated rows get
    the same values; the score is the best containment, 1 where a phrase stands."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("rk"))
    rows = taken_apart(keyed)
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("template") + 1)
    found = template_matches(rows).select("doc_id", "rk", of([label for label, _ in TEMPLATES]).alias("label"), of([_family(label) for label, _ in TEMPLATES]).alias("family"),
                                          "marked", (F.col("share") / of([len(w) for w, _ in needs()])).alias("best"))
    found = found.groupBy("doc_id", "rk").agg(
        F.collect_set(F.when(F.col("marked"), F.col("label"))).alias("named"), F.collect_set(F.when(F.col("marked"), F.col("family"))).alias("told"), F.collect_set("family").alias("met"), F.max("best").alias("best"))
    found = found.select(F.col("doc_id").alias("m_id"), F.col("rk").alias("m_rk"), "named", "told", "met", "best")
    rows = rows.drop("known", "words").join(found, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("rk") == F.col("m_rk")), "left")
    none = F.array().cast("array<string>")
    base_family = F.transform("phrase_labels", lambda x: F.coalesce(*[F.when(x == label, fam) for label, fam in FAMILIES.items()], x))
    like = F.transform(F.array_except("met", F.array_union("told", base_family)), lambda f: F.concat(f, F.lit("-like")))
    every = F.array_sort(F.array_union("phrase_labels", F.coalesce(F.array_union("named", like), none)))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("phrase_labels"), ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def op7_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def _oracle() -> str:
    """Brute force over word lists: every window against every template, every start against every phrase."""
    templates = " UNION ALL ".join(
        f"SELECT {k} AS tk, '{label}' AS label, '{_family(label)}' AS fam, {words} AS t, {window_words(text)} AS size, {need} AS need, ' (?:{mark}) ' AS mark"
        for k, ((label, text), (words, need), mark) in enumerate(zip(TEMPLATES, needs(), MARKS, strict=True)))
    starts = " UNION ALL ".join(
        f"SELECT k, i, '{label}' AS label, '{_family(label)}' AS fam FROM p WHERE " + " AND ".join(f"w[i + {j}] = '{x}'" for j, x in enumerate(phrase.split()))
        for phrase, label in PHRASES.items())
    sep = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH w AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{sep}') AS w FROM documents),
p AS (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE list_has_any(w, ['gnu', 'apache', 'cc', 'mit'])),
s AS ({starts}),
b AS (SELECT k, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word, list(DISTINCT label) AS l, list(DISTINCT fam) AS f FROM s GROUP BY k),
tt AS ({templates}),
c AS (SELECT w.k, w.w, tt.* FROM w JOIN tt ON len(list_intersect(t, w.w)) >= need),
v AS (SELECT *, unnest(range(1, greatest(len(w) - size + 2, 2))) AS i FROM c),
x AS (SELECT *, len(list_intersect(t, w[i:i + size - 1])) AS share FROM v),
m AS (SELECT k, tk, label, fam, max(share) / max(len(t)) AS best, bool_or(regexp_matches(concat(' ', array_to_string(w[i:i + size - 1], ' '), ' '), mark)) AS marked
  FROM x WHERE share >= need GROUP BY ALL),
g AS (SELECT k, max(best) AS best, coalesce(list(DISTINCT label) FILTER (WHERE marked), []) AS named, coalesce(list(DISTINCT fam) FILTER (WHERE marked), []) AS told, list(DISTINCT fam) AS met FROM m GROUP BY k),
e AS (SELECT w.doc_id, len(w.w) AS n_words, b.*, g.named, g.best, [f || '-like' FOR f IN coalesce(g.met, []) IF NOT list_contains(g.told, f) AND NOT list_contains(coalesce(b.f, []), f)] AS alike
  FROM w LEFT JOIN b ON b.k = w.k LEFT JOIN g ON g.k = w.k)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(l), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(l, []), coalesce(named, []), alike))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS score
FROM e
"""


ORACLE = _oracle()
