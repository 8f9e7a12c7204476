"""License scans: an exact set-similarity join of word windows with templates of license notices."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

#: Words of a lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrase and label.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Label and notice; a text with a window that holds enough of a notice's words gets its label.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("agpl", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("public-domain", "This is free and unencumbered software released into the public domain"),
)
#: Least share of a template's words that a window must hold.
THRESHOLD = 0.85
#: Words of a window for each word of its template: as many others may stand between them.
SPAN = 2


@dataclass(frozen=True)
class Template:
    label: str
    ranks: tuple[int, ...]  # rarest word first
    need: int  # least number of shared words
    span: int  # words of a window

    @property
    def prefix(self) -> tuple[int, ...]:
        return self.ranks[: len(self.ranks) - self.need + 1]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def _set(text: str) -> list[str]:
    return sorted(set(re.findall(WORD, text.lower())))


def plan(words: DataFrame, templates: tuple[tuple[str, str], ...], threshold: float) -> tuple[dict[str, int], list[Template]]:
    """Ranks of the templates' words by the number of documents that hold them (rarest first), and the templates by rank.

    words: one column `words` with each document's words. What comes back to the driver is a count for each word of a template.
    """
    vocabulary = sorted({w for _, t in templates for w in _set(t)})
    seen = words.select(F.explode(F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary)))).alias("w")).groupBy("w").count()
    count = {r["w"]: r["count"] for r in seen.collect()}
    rank = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (count.get(w, 0), w)))}
    return rank, [Template(label, tuple(sorted(rank[w] for w in _set(t))), math.ceil(threshold * len(_set(t)) - 1e-9), SPAN * len(re.findall(WORD, t.lower()))) for label, t in templates]


def containment(block: Column, t: Template) -> Column:
    """Share of the template's words in the block (sorted ranks), null where the filters or the threshold rule the pair out.

    Length filter: the block has as many words as needed. Prefix filter: it holds one of the template's rarest words.
    Positional filter: from the first shared word on, enough words are left on both sides. Then the shared words are counted.
    """
    first = F.array_min(F.array_intersect(block, F.array(*map(F.lit, t.prefix))))
    left = F.size(F.filter(block, lambda r: r >= first))
    shared = F.size(F.array_intersect(block, F.array(*map(F.lit, t.ranks))))
    return F.when((F.size(block) >= t.need) & first.isNotNull() & (left >= t.need), F.when(shared >= t.need, shared / F.lit(float(len(t.ranks)))))


def windows(t: Template) -> Column:
    """Sorted ranks of the windows of `ranks` that can reach the template, each of t.span words, line breaks or not.

    They hold a word of the prefix; around its place, as far as such windows go, enough of the template's words must stand.
    """
    ranks, span = F.col("ranks"), F.lit(t.span)
    own, rare = F.array(*map(F.lit, t.ranks)), list(t.prefix)
    start = lambda p: F.greatest(p - span + 1, F.lit(0))
    places = F.filter(F.transform(ranks, lambda r, i: F.when(r.isin(rare), i)), lambda p: p.isNotNull())
    near = F.filter(places, lambda p: F.size(F.array_intersect(F.slice(ranks, start(p) + 1, 2 * span - 1), own)) >= t.need)
    starts = F.array_distinct(F.flatten(F.transform(near, lambda p: F.sequence(start(p), p))))
    return F.transform(starts, lambda s: F.array_sort(F.array_distinct(F.filter(F.slice(ranks, s + 1, span), lambda r: r >= 0))))


def license_scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """keep, n_words, n_base, first_word, last_word, base_labels, labels, score for every row of docs.

    Blocks are all windows of SPAN times a template's words that follow one another in a text, across line breaks; each that
    holds threshold of the template's words gives its label, in any order. score: the greatest such share, 1.0 with a base phrase, else 0.0. Null and empty texts have no words,
    null places and empty labels. Repeated rows are scanned one by one; an empty table gives none; other columns are ignored.
    """
    narrow = docs.select(*keep, lower_ascii(F.coalesce(F.col(text), F.lit(""))).alias("__t"))
    tokenised = narrow.withColumn("words", _words(F.col("__t")))
    rank, compiled = plan(tokenised, templates, threshold)
    by_rank = F.create_map(*(x for w, k in rank.items() for x in (F.lit(w), F.lit(k))))
    columns, starts, names = {}, [], []
    for k, (phrase, label) in enumerate(PHRASES):
        parts = phrase.split()
        columns[f"p{k}"] = F.when(F.array_contains("words", parts[-1]), _places(parts)).otherwise(F.array().cast("array<int>"))
        starts.append(F.col(f"p{k}"))
        names.append(F.when(F.size(f"p{k}") > 0, F.lit(label)))
    rare = sorted({w for w, k in rank.items() if any(k in t.prefix for t in compiled)})
    vocabulary = sorted(rank)
    ranked = F.transform("words", lambda w: F.when(w.isin(vocabulary), F.element_at(by_rank, w)).otherwise(F.lit(-1)))
    columns["ranks"] = F.when(F.arrays_overlap("words", F.array(*map(F.lit, rare))), ranked)
    x = tokenised.withColumns(columns).withColumn("starts", F.concat(*starts))
    x = x.withColumns({f"t{k}": F.array_max(F.transform(windows(t), _against(t))) for k, t in enumerate(compiled)})
    joined = lambda xs: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*xs)))), ",")
    own = [F.when(F.col(f"t{k}").isNotNull(), F.lit(t.label)) for k, t in enumerate(compiled)]
    score = F.when(F.size("starts") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.array(*(F.col(f"t{k}") for k in range(len(compiled))))), F.lit(0.0)))
    return x.select(*keep, F.size("words").cast("long").alias("n_words"), F.size("starts").cast("long").alias("n_base"), F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"), joined(names).alias("base_labels"), joined(names + own).alias("labels"), score.alias("score"))


def _places(parts: list[str]) -> Column:
    """Starts of the places in `words` where parts stand one after another."""
    def at(w: Column, i: Column) -> Column:
        fits = w == parts[0]
        for k, p in enumerate(parts[1:], 1):
            fits = fits & (F.get(F.col("words"), i + k) == p)
        return F.when(fits, i)

    return F.array_compact(F.transform("words", at))


def _against(t: Template):
    return lambda block: containment(block, t)
