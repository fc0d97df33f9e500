"""Operator 13 - license scan by a positional index of rare words
(DataFrames only).

Templates are short passages of public licences, each with its label and the
key phrases that must stand in it.  Their distinct words are the licence
words.  One pass counts in how many documents each licence word stands (the
counts are aggregated before the shuffle, one row a word at the end), which
ranks them by IDF.  A second, narrow pass looks at each text by itself:

1. its licence words, and of each template that it can hold at all (a passage
   with ``share`` of its words in place needs most of its distinct words) the
   ``rare`` words of highest IDF found;
2. the postings of these words in text and template, intersected by relative
   position: a place counts when ``agree`` words put the passage there;
3. the passage laid on that place: ``share`` of its words must match, and its
   key phrases must stand there word for word.

The word order is the only thing that goes to the driver: as many rows as the
templates have words, whatever the input.  Nothing is joined, so a word or a
passage found in every document moves no rows.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z.  Base
phrases are consecutive words; every place counts.  The score is 1 with a base
phrase, else the greatest share of a passage found, else 0.  Defined results:
null and empty texts have no words; passages may overlap; rows that repeat a
doc_id, or have none, are scanned each by itself (and each counts in the IDF);
other columns are ignored.
"""

from __future__ import annotations

import json
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Label, passage and key phrases of public licences.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
     ["any person obtaining a copy of this software", "without restriction"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies",
     ["with or without fee is hereby granted"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met", ["redistribution and use in source and binary forms"]),
    ("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written "
                     "permission", ["endorse or promote products"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at",
     ["except in compliance with the license"]),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-2.0-or-later", "you can redistribute it and or modify it under the terms of the gnu general public license as "
                         "published by the free software foundation either version 2 of the license or at your option any "
                         "later version", ["gnu general public license", "version 2 of the license"]),
    ("gpl-3.0-or-later", "you can redistribute it and or modify it under the terms of the gnu general public license as "
                         "published by the free software foundation either version 3 of the license or at your option any "
                         "later version", ["gnu general public license", "version 3 of the license"]),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
             "by the free software foundation", ["gnu lesser general public license"]),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published "
             "by the free software foundation", ["gnu affero general public license"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
                "not distributed with this file you can obtain one at", ["mozilla public license v 2 0"]),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license "
                "2 0", ["eclipse public license 2 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution 4 0"]),
    ("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of "
                "his or her rights to the work worldwide", ["dedicated the work to the public domain"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["unencumbered software released into the public domain"]),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
                "accompanying documentation covered by this license", ["any person or organization obtaining a copy"]),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use of this software permission is "
             "granted to anyone to use this software for any purpose", ["held liable for any damages"]),
]

GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Scan:
    rare: int = 6  # words of highest IDF looked up for a template
    agree: int = 3  # of them, so many must name the same place
    share: float = 0.8  # of the passage's words in place


def vocabulary(templates: list[tuple[str, str, list[str]]] | None = None) -> list[str]:
    """Distinct licence words."""
    return sorted({w for _, passage, _ in templates or TEMPLATES for w in passage.split()})


def words(text: Column) -> Column:
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(F.coalesce(lower, F.lit("")), GAP, -1), "")


def _array(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def word_counts(docs: DataFrame, found: list[str]) -> DataFrame:
    """(word, n): the rows that hold each of the words."""
    return docs.select(F.explode(F.array_intersect(_array(found), words(F.col("text")))).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))


def by_idf(docs: DataFrame, templates: list[tuple[str, str, list[str]]] | None = None) -> list[str]:
    """Licence words, the rarest first; equal ones by the word."""
    have = vocabulary(templates)
    counts = {r["word"]: r["n"] for r in word_counts(docs, have).collect()}  # a row a licence word
    return sorted(have, key=lambda w: (counts.get(w, 0), w))


def _index(templates: list[tuple[str, str, list[str]]], order: list[str], how: Scan) -> list[dict]:
    """The templates as (label, text, rare, need, must): words in place,
    distinct words by IDF, how many of them a text must hold at least, and the
    positions of the key phrases."""
    rank = {w: i for i, w in enumerate(order)}
    out = []
    for label, passage, phrases in templates:
        text = passage.split()
        distinct = sorted(set(text), key=rank.__getitem__)
        must = set()
        for phrase in phrases:
            p = phrase.split()
            at = next(i for i in range(len(text)) if text[i:i + len(p)] == p)
            must |= set(range(at, at + len(p)))
        least = next(k for k in range(len(text) + 1) if k / len(text) >= how.share)
        need = max(how.agree, len(distinct) - (len(text) - least))
        out.append({"label": label, "text": text, "rare": distinct, "need": need, "must": sorted(must)})
    return out


def _upto(n: Column) -> Column:
    """0..n-1; empty for 0."""
    return F.slice(F.sequence(F.lit(0), n), 1, n)


def _places(t: Column, how: Scan) -> Column:
    """Relative positions that ``agree`` of the template's rarest words in the
    text name."""
    def postings(w: Column) -> Column:
        here = F.filter(_upto(F.size("__words")), lambda i: F.get("__words", i) == w)
        there = F.filter(_upto(F.size(t["text"])), lambda j: F.get(t["text"], j) == w)
        return F.array_distinct(F.flatten(F.transform(F.array(there), lambda js: F.flatten(
            F.transform(here, lambda i: F.transform(js, lambda j: i - j))))))

    rare = F.slice(F.array_intersect(t["rare"], F.col("__present")), 1, how.rare)
    named = F.array(F.array_sort(F.flatten(F.transform(rare, postings))))
    return F.array_distinct(F.flatten(F.transform(named, lambda s: F.filter(
        s, lambda x, i: F.get(s, i + F.lit(how.agree - 1)) == x))))


def _shares(t: Column, how: Scan) -> Column:
    """Share of the passage's words in place, for each place that holds."""
    def in_place(o: Column, j: Column) -> Column:
        return F.coalesce(F.get("__words", o + j) == F.get(t["text"], j), F.lit(False))

    verified = F.filter(_places(t, how), lambda o: F.forall(t["must"], lambda j: in_place(o, j)))
    share = F.transform(verified, lambda o: F.size(F.filter(_upto(F.size(t["text"])), lambda j: in_place(o, j))) / F.size(t["text"]))
    return F.filter(share, lambda x: x >= how.share)


def _base(text: Column) -> Column:
    """array of (start, label) of the base phrases' places."""
    gate = "|".join(GAP.join(p.split()) for p, _ in BASE)

    def of(phrase: str, label: str) -> Column:
        p = phrase.split()
        here = F.filter(_upto(F.size("__words")), lambda i: F.forall(
            F.array(*[F.struct(F.lit(k).alias("k"), F.lit(w).alias("w")) for k, w in enumerate(p)]),
            lambda x: F.coalesce(F.get("__words", i + x["k"]) == x["w"], F.lit(False))))
        return F.transform(here, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))

    return F.when(text.rlike(f"(?i)(?:{gate})"), F.concat(*[of(*x) for x in BASE])).otherwise(
        F.array().cast("array<struct<start:long,label:string>>"))


def scan_licenses(docs: DataFrame, how: Scan | None = None, templates: list[tuple[str, str, list[str]]] | None = None) -> DataFrame:
    """(doc_id, n_words, base, found) per row: places of base phrases, and the
    label and share of each passage found."""
    how, templates = how or Scan(), templates or TEMPLATES
    order = by_idf(docs, templates)
    index = _index(templates, order, how)
    table = F.from_json(F.lit(json.dumps(index)), "array<struct<label:string,text:array<string>,rare:array<string>,need:int,must:array<int>>>")
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("__text"), words(F.col("text")).alias("__words"))
        .withColumn("__present", F.array_intersect(_array(order), F.col("__words")))
    )
    may = F.filter(table, lambda t: F.size(F.array_intersect(t["rare"], F.col("__present"))) >= t["need"])
    found = F.filter(F.transform(may, lambda t: F.struct(t["label"].alias("label"), F.array_max(_shares(t, how)).alias("share"))),
                     lambda x: x["share"].isNotNull())
    least = min(t["need"] for t in index)
    return rows.select(
        "doc_id", F.size("__words").cast("long").alias("n_words"), _base(F.col("__text")).alias("base"),
        F.when(F.size("__present") >= least, found).otherwise(F.array().cast("array<struct<label:string,share:double>>")).alias("found"))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, first and last place, labels and score."""
    base = F.array_sort(F.array_distinct(F.transform("base", lambda x: x["label"])))
    both = F.array_sort(F.array_distinct(F.concat(F.transform("base", lambda x: x["label"]), F.transform("found", lambda x: x["label"]))))
    starts = F.transform("base", lambda x: x["start"])
    best = F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0))
    return scanned.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_join(base, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(best).alias("score"))
