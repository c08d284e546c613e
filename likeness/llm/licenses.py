"""Operator 5: license scans by an exact set-similarity join.

Base: places where the words of a license's name stand consecutively.

The method: each license notice is a template, and the blocks of a document are
all its runs of |T| / ``containment`` consecutive words (|T|: the words of the
template with repetitions; rounded up), whatever lines they stand on.  A block
matches if it contains at least ``containment`` of the template's words (as
sets).  Words are ordered by how many documents have them, rarest first.  A
document must hold o words of the template at all (o: the words that must be
common; length filter), a matching block one of the first |T| - o + 1 of them
(prefix filter), and around that place, as far as blocks reach, there must be o
of them (positional filter).  Blocks there that begin with a word of the
template are compared exactly; others hold no more than the next of these, so
the best block of every match is found.

Templates are a parameter, a few short notices, and unrolled into the plan;
word counts are taken over all documents.  DataFrame functions only; documents
are never shuffled.  Nulls: a null text is empty; rows with a null id and
repeated rows get their own result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases and labels of the base search
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Public license notices and the labels the method gives
TEMPLATES = {
    "notice:mit": "Released under the MIT License",
    "notice:mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "notice:apache-2.0": "Licensed under the Apache License, Version 2.0",
    "notice:apache-2.0-header": "you may not use this file except in compliance with the License",
    "notice:gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "notice:gpl-free-software": "redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "notice:bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "notice:cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "notice:cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
}
#: the contract's words, with capitals, so that text need not be lowered first
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NO_BLOCKS = "cast(array() as array<struct<word:int,label:string,containment:double>>)"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, SMALL), F.lit(WORD), F.lit(0))


def _tokens(text: str) -> list[str]:
    return sorted(set(re.findall("[a-z0-9]+", text.lower())))


def _array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _holds(words: list[str]) -> Column:
    """Whether the text has one of the words at all (whole words, any case)."""
    edge = WORD[:-1]
    return F.col("text").rlike(f"(?i)(?<!{edge})(?:{'|'.join(map(re.escape, words))})(?!{edge})")


def word_order(docs: DataFrame, templates: dict[str, str]) -> list[str]:
    """The templates' words, those in the fewest documents first."""
    vocabulary = sorted({w for t in templates.values() for w in _tokens(t)})
    has = docs.select(F.explode(F.array_intersect(_words(F.col("text")), _array(vocabulary))).alias("word"))
    counts = {r.word: r.n for r in has.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _matches(label: str, template: list[str], prefix: list[str], need: int, span: int) -> Column:
    """The runs of ``span`` words of a document that hold ``need`` words of the
    template and begin with one of them."""
    full, first, size = _array(template), _array(prefix), len(template)

    def held(start: Column, length: int) -> Column:
        return F.size(F.array_intersect(full, F.slice("w", start + 1, F.lit(length))))

    def near(p: Column) -> Column:  # a prefix word, and enough words within the blocks that have this place
        return F.array_contains(first, F.get("w", p)) & (held(F.greatest(p - (span - 1), F.lit(0)), 2 * span - 1) >= need)

    places = F.filter(F.sequence(F.lit(0), F.size("w") - 1), near)
    starts = F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(F.greatest(p - (span - 1), F.lit(0)), p))))
    starts = F.filter(starts, lambda i: F.array_contains(full, F.get("w", i)))
    blocks = F.transform(starts, lambda i: F.struct(i.alias("word"), F.lit(label).alias("label"), (held(i, span) / F.lit(float(size))).alias("containment")))
    blocks = F.filter(blocks, lambda x: F.round(x.containment * size) >= need)
    return F.coalesce(F.when(F.size(F.array_intersect(full, "vocabulary")) >= need, blocks), F.expr(NO_BLOCKS))


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] = TEMPLATES, containment: float = 0.9,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, blocks) of every row; blocks lists the matches (word, label, containment)
    by the number of their first word, overlapping ones too."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = word_order(docs, templates)
    rank = {w: i for i, w in enumerate(order)}
    sets = {label: sorted(_tokens(t), key=rank.get) for label, t in templates.items()}
    need = {label: max(1, math.ceil(containment * len(t) - 1e-9)) for label, t in sets.items()}
    prefix = {label: t[: len(t) - need[label] + 1] for label, t in sets.items()}
    span = {label: math.ceil(len(re.findall("[a-z0-9]+", t.lower())) / containment - 1e-9) for label, t in templates.items()}

    lasts = sorted({p.split()[-1] for p in PHRASES})
    df = docs.withColumn("n_words", F.expr("regexp_count(text, :w)".replace(":w", "r'" + WORD + "'")).cast("long"))
    # words of documents that hold the last word of a phrase or a prefix word
    df = df.withColumn("w", F.when(_holds(sorted({*lasts, *(w for p in prefix.values() for w in p)})), _words(F.col("text"))))
    df = df.withColumn("vocabulary", F.array_intersect(_array(order), "w"))
    for i, phrase in enumerate(PHRASES):
        at = " and ".join(f"get(w, i + {j}) = '{x}'" for j, x in enumerate(phrase.split()))
        df = df.withColumn(f"at{i}", F.when(F.array_contains("w", phrase.split()[-1]), F.expr(f"filter(sequence(0, size(w) - 1), i -> {at})")))
        df = df.withColumn(f"at{i}", F.coalesce(f"at{i}", F.expr("cast(array() as array<int>)")))

    found = [_matches(label, t, prefix[label], need[label], span[label]) for label, t in sets.items()]
    df = df.withColumn("blocks", F.concat(*found))
    starts = F.concat(*[F.col(f"at{i}") for i in range(len(PHRASES))])
    base = F.array_compact(F.array(*[F.when(F.size(f"at{i}") > 0, F.lit(x)) for i, x in enumerate(PHRASES.values())]))
    best = F.array_max(F.transform("blocks", lambda x: x.containment))
    return df.withColumn("starts", starts).withColumn("base", base).select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.concat_ws(",", F.array_sort("base")).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("base", F.transform("blocks", lambda x: x.label)))).alias("labels"),
        F.when(F.size("starts") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"), "blocks")
