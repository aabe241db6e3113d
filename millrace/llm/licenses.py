"""License scan: exact phrases, and text blocks that contain most of a notice template.

The second part is a set-similarity join. Blocks of a text are overlapping windows of its words, across lines, sized by the
template: windows of twice its length that start at every multiple of it, so each run of as many words lies in one. A
block is found if it has at least ``PERCENT`` per cent of the template's different words, all that tell it from similar
notices, and none that belong to another one. Template words are ordered by how often the corpus holds them, rarest first:

* Prefix filter: only the blocks around a word of a template's prefix, the first few of its words, meet the template.
* Positional filter: the prefix is one word longer than a first shared word needs; without a second word of it in the
  block, the words left in the order cannot make up the threshold.
* Length filter: a block at the end of a text may have too few words.

What is left is compared word by word. The templates are a fixed list, so their order is all that the corpus adds, and all
of this happens inside a row; nothing is shuffled but the counts of template words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases of the base scan and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Wordings of well-known notices, by label.
# Label, wording, words that must be there, words that must not.
TEMPLATES = (
    ("mit", "released under the mit license", "mit", ""),
    ("mit", "licensed under the mit license", "mit", ""),
    ("mit", "this project is licensed under the terms of the mit license", "mit", ""),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "", ""),
    ("apache-2", "licensed under the apache license version 2 0", "apache 2", ""),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
     "with the license", "apache 2", ""),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu 3", "lesser affero"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation either version 3 of the license", "gnu 3", "lesser affero"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", "gnu 2", "lesser affero"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser", ""),
    ("agpl-3", "licensed under the gnu affero general public license version 3", "affero 3", ""),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "", ""),
    ("bsd", "licensed under the bsd 3 clause license", "bsd", ""),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla 2", ""),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc nc", "sa nd"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license",
     "commons noncommercial", "sharealike noderivatives"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc sa", "nc"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license",
     "commons sharealike", "noncommercial"),
    ("cc-by", "licensed under cc by 4 0", "cc", "nc sa nd"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     "commons attribution", "noncommercial sharealike noderivatives"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
     "waived", ""),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered", ""),
    ("proprietary", "all rights reserved", "", ""),
)
PERCENT = 85

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def need(size: int, percent: int) -> int:
    """Words of a template of ``size`` different ones that a block must hold."""
    return max(1, math.ceil(size * percent / 100))


def base_scan(spaced: Column) -> dict[str, Column]:
    """Columns of the phrase search in a text of words with one space before, between and after them."""

    def before(head: Column) -> Column:
        """Words in the head of such a text: its spaces, but for the one at the start."""
        return (F.length(head) - F.length(F.translate(head, " ", "")) - 1).cast("long")

    count, first, last = F.lit(0).cast("long"), [], []
    for phrase in PHRASES:
        # The space after a place may be the space before the next one.
        places = F.regexp_count(spaced, F.lit(f" {phrase}(?= )")).cast("long")
        at = F.instr(spaced, f" {phrase} ")
        has = at > 0
        count = count + places
        first.append(F.when(has, before(F.substring(spaced, F.lit(1), at))))
        back = F.instr(F.reverse(spaced), f" {phrase} "[::-1])
        end = F.length(spaced) - back + 1  # of the last place, its closing space included
        last.append(F.when(has, before(F.substring(spaced, F.lit(1), end - len(phrase) - 1))))
    labels = F.array(*(F.when(F.contains(spaced, F.lit(f" {p} ")), F.lit(label)) for p, label in PHRASES.items()))
    return {
        "n_base": count,
        "first_word": F.least(*first),
        "last_word": F.greatest(*last),
        "base": F.array_sort(F.array_distinct(F.array_compact(labels))),
    }


def word_counts(words: DataFrame, templates) -> dict[str, int]:
    """How often the corpus holds each template word; a row per such word comes to the driver. Runs a job."""
    known = sorted({w for _, wording, _, _ in templates for w in wording.split()})
    held = words.select(F.explode(F.filter("words", lambda w: w.isin(known))).alias("word"))
    return {word: n for word, n in held.groupBy("word").agg(F.count("*").alias("n")).collect()}


def _literals(words) -> Column:
    return F.array(*(F.lit(w) for w in words)) if words else F.array().cast("array<string>")


def best_shares(words: Column, near: Column, templates, prefixes, percent: int) -> list[Column]:
    """For each template, the largest share of its words in a block that is found, or null.

    ``near`` has the places of all prefix words in ``words``.
    """

    def best(template, prefix) -> Column:
        _, wording, must, without = template
        length, own = len(wording.split()), sorted(set(wording.split()))
        least = need(len(own), percent)

        def block(k: Column) -> Column:
            # Word by word, since ``slice`` inside a lambda copies the whole array first.
            start = (k * length).cast("int")
            places = F.sequence(start, F.least(start + 2 * length, F.size(words)) - 1, F.lit(1))
            return F.transform(places, lambda i: F.get(words, i))

        places = F.filter(near, lambda i: F.get(words, i).isin(prefix))
        turns = F.transform(places, lambda i: F.array(F.floor(i / length) - 1, F.floor(i / length)))
        starts = F.filter(F.array_distinct(F.flatten(turns)), lambda k: k >= 0)
        blocks = F.transform(starts, block)
        met = F.filter(
            blocks, lambda b: (F.size(b) >= least) & (F.size(F.array_intersect(_literals(prefix), b)) >= min(2, least))
        )

        def share(b: Column) -> Column:
            shared = F.size(F.array_intersect(_literals(own), b))
            told = F.size(F.array_except(_literals(must.split()), b)) == 0
            other = F.arrays_overlap(_literals(without.split()), b) if without else F.lit(False)
            return F.when((shared >= least) & told & ~other, shared / F.lit(len(own)))

        return F.array_max(F.transform(met, share))

    return [best(t, p) for t, p in zip(templates, prefixes, strict=True)]


def prefix_words(template, counts: dict[str, int], percent: int) -> list[str]:
    """The rarest words of a template, two of which (one, if one is enough) are in every block that is found."""
    ordered = sorted(set(template[1].split()), key=lambda w: (counts.get(w, 0), w))
    least = need(len(ordered), percent)
    return ordered[: len(ordered) - least + min(2, least)]


def license_scan(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` per row of ``docs(doc_id, text)``.

    Words are ASCII letters and digits and all other characters beyond ASCII, with A-Z lower-cased.
    Base columns are about the places of ``PHRASES``; ``labels`` adds those of templates found in a block, a window of
    words that holds ``percent`` per cent of the template's, with all words that tell it apart. ``score`` is 1 with a
    place, else the largest such share, else 0. A null text counts as empty. Repeated rows stay; other columns are
    ignored. Runs a job.
    """
    templates = [t for t in templates if t[1].split()]
    spaced = F.concat(F.lit(" "), F.regexp_replace(lowered(F.coalesce("text", F.lit(""))), _APART, " "), F.lit(" "))
    spaced = F.regexp_replace(spaced, " +", " ")
    texts = docs.select("doc_id", spaced.alias("spaced")).withColumn("words", F.split(F.trim("spaced"), " "))
    counts = word_counts(texts, templates)
    prefixes = [prefix_words(t, counts, percent) for t in templates]
    every = sorted({w for p in prefixes for w in p})
    near = F.array_compact(F.transform("words", lambda w, i: F.when(w.isin(every), i)))
    scanned = texts.select(
        "doc_id",
        F.greatest(F.length("spaced") - F.length(F.translate("spaced", " ", "")) - 1, F.lit(0)).cast("long").alias("n_words"),
        *(c.alias(n) for n, c in base_scan(F.col("spaced")).items()),
        "words",
        near.alias("near"),
    )
    shares = best_shares(F.col("words"), F.col("near"), templates, prefixes, percent)
    found = scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base", F.array(*shares).alias("shares"))
    labels = F.zip_with(_literals([t[0] for t in templates]), "shares", lambda label, share: F.when(share.isNotNull(), label))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.array_compact(labels))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(F.array_max("shares"), F.lit(0.0))).alias("score"),
    )
