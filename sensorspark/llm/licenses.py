"""Licence texts in files, by a positional index of rare words.

Templates are indexed word by word with their positions. Each template is looked up by its own
words with the highest inverse document frequency in the corpus, as many as hold more than the
share of its weight that may disagree: a start at which none of them stands cannot reach AGREEMENT,
so no start is lost. Each of their places in the file, less the word's place in the template, is a
start to try; there all words of the template are compared by relative position. A template counts
where the share of its words (weighted by IDF) that agree reaches AGREEMENT and all of its key
phrases stand in the file.

Base labels come from four phrases, whose words must stand consecutively.

Built-in expressions only: documents are not shuffled and each is scored in its row. Document
frequencies are counted for template words alone, so the table on the driver is as small as
the templates. Words are runs of ASCII letters and digits and of all other characters beyond
ASCII, in ASCII lower case.

Edge cases: a missing text is an empty one without words; ids may be missing or repeated; other
columns are never read; a template may be cut by either end of a file, its missing words disagree;
an empty corpus has no frequencies and gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark.llm.common import documents

AGREEMENT = 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


@dataclass(frozen=True)
class Template:
    """A notice as lower-case words, and phrases that must stand in a file for it to count."""

    label: str
    words: str
    keys: tuple[str, ...]


# Short public notices of common licences.
TEMPLATES = (
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3",
             ("gnu general public license", "version 3")),
    Template("gpl-2.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
             "public license as published by the free software foundation version 2", ("gnu general public license", "version 2")),
    Template("gpl-3.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
             "public license as published by the free software foundation either version 3 of the license or at your option "
             "any later version", ("gnu general public license", "version 3", "any later version")),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("mit-notice", "released under the mit license", ("released under the mit license",)),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files the software to deal in the software without restriction",
             ("permission is hereby granted free of charge", "without restriction")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
             "following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
             "granted", ("permission to use copy modify", "with or without fee")),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license v 2 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software", "public domain")),
)


def words_of(text: Column) -> Column:
    """Words of a text; splitting leaves at most one empty piece at either end."""
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), _BREAK), lambda w: w != "")


def _possible(text: Column, phrases: Sequence[str]) -> Column:
    """Whether any phrase can stand in the text: necessary and sufficient, without cutting it into words."""
    joined = "|".join("(?:" + _BREAK.join(p.split()) + ")" for p in phrases)
    return text.rlike(rf"(?i)(?<![0-9a-z]|[^\x00-\x7f])(?:{joined})(?![0-9a-z]|[^\x00-\x7f])")


def _places(words: Column, phrase: str) -> Column:
    """Starts of a phrase in an array of words, in order."""
    first, *rest = phrase.split()
    starts = F.filter(F.transform(words, lambda w, i: F.when(w == first, i)), lambda i: i.isNotNull())

    def follows(i: Column) -> Column:
        same = F.lit(True)
        for k, word in enumerate(rest, 1):
            same = same & F.coalesce(F.get(words, i + k) == word, F.lit(False))
        return same
    return F.filter(starts, follows)


def frequencies(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> tuple[int, dict[str, int]]:
    """Documents in all, and how many have each template word; as many rows as template words."""
    vocabulary = sorted({w for t in templates for w in t.words.split()})
    has = F.array_intersect(words_of(F.col("text")), F.array(*[F.lit(w) for w in vocabulary]))
    rows = docs.select(F.explode(F.concat(has, F.array(F.lit("")))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()
    found = {r["w"]: r["n"] for r in rows}
    return found.pop("", 0), found


def idf_weights(total: int, found: Mapping[str, int], templates: Sequence[Template] = TEMPLATES) -> dict[str, float]:
    return {w: math.log((total + 1) / (found.get(w, 0) + 1)) + 1e-3 for t in templates for w in t.words.split()}


def _added(weights: Sequence[float]) -> float:
    """Sum from left to right without compensation, as the engine adds; so a whole match is exactly 1."""
    total = 0.0
    for w in weights:
        total += w
    return total


def anchor_words(template: Template, idf: Mapping[str, float], agreement: float = AGREEMENT) -> list[str]:
    """The rarest words of a template, as many as together weigh more than what may disagree."""
    words = template.words.split()
    spare = (1 - agreement) * _added([idf[w] for w in words]) * (1 + 1e-9)
    chosen: list[str] = []
    for word in sorted(set(words), key=lambda w: (-idf[w], w)):
        chosen.append(word)
        spare -= idf[word] * words.count(word)
        if spare < 0:
            break
    return chosen


def _agreement(words: Column, template: Template, idf: Mapping[str, float], agreement: float) -> Column:
    """Largest share of the template's weight that agrees on one start, exact from `agreement` upwards."""
    indexed = list(enumerate(template.words.split()))
    anchors = anchor_words(template, idf, agreement)

    def array(places: Sequence[tuple[int, str]]) -> Column:
        return F.array(*[F.struct(F.lit(w).alias("w"), F.lit(i).alias("pos"), F.lit(idf[w]).alias("weight")) for i, w in places])

    hits = F.filter(F.transform(words, lambda w, i: F.when(w.isin(*anchors), F.struct(w.alias("w"), i.alias("i")))), lambda h: h.isNotNull())
    rare = array([(i, w) for i, w in indexed if w in set(anchors)])
    starts = F.array_distinct(F.flatten(F.transform(hits, lambda h: F.transform(
        F.filter(rare, lambda p: p["w"] == h["w"]), lambda p: h["i"] - p["pos"]))))
    agreed = F.transform(starts, lambda s: F.aggregate(array(indexed), F.lit(0.0), lambda a, p: a + F.when(
        F.get(words, s + p["pos"]) == p["w"], p["weight"]).otherwise(0.0)))
    return F.coalesce(F.array_max(agreed), F.lit(0.0)) / _added([idf[w] for _, w in indexed])


def scan(df: DataFrame, text: str = "text", doc_id: str = "doc_id", templates: Sequence[Template] = TEMPLATES,
         agreement: float = AGREEMENT) -> DataFrame:
    """(doc_id, n_words, places, base_labels, found): one row per row of the input.

    `places` are (label, start, size) of the base phrases by start, `found` are (label, score) of the templates.
    """
    docs = documents(df, text, doc_id)
    total, counted = frequencies(docs, templates)
    idf = idf_weights(total, counted, templates)
    words, possible = F.col("_words"), F.col("_possible")
    phrases = [*PHRASES, *sorted({t.keys[0] for t in templates})]
    none = F.array().cast("array<struct<label:string,start:int,size:int>>")
    cut = docs.select("doc_id", words_of(F.col("text")).alias("_words"), _possible(F.col("text"), phrases).alias("_possible"))
    places = F.concat(*[F.transform(_places(words, p), lambda i: F.struct(
        i.alias("start"), F.lit(label).alias("label"), F.lit(len(p.split())).alias("size"))) for p, label in PHRASES.items()])
    based = cut.select("doc_id", "_words", F.size("_words").cast("bigint").alias("n_words"), "_possible", F.when(possible, F.transform(
        F.array_sort(places), lambda s: F.struct(s["label"], s["start"], s["size"]))).otherwise(none).alias("places"))
    scores = []
    for t in templates:
        verified = F.lit(True)
        for phrase in t.keys:
            verified = verified & (F.size(_places(words, phrase)) > 0)
        scores.append(F.struct(F.lit(t.label).alias("label"), F.when(verified, _agreement(words, t, idf, agreement)).otherwise(0.0).alias("score")))
    empty = F.array().cast("array<struct<label:string,score:double>>")
    found = F.when(possible, F.filter(F.array(*scores), lambda s: s["score"] >= agreement)).otherwise(empty)
    return based.select("doc_id", "n_words", "places",
                      F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"]))).alias("base_labels"), found.alias("found"))
