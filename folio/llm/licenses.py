"""Licence scan: units of a text against licence templates by the Dice coefficient.

A text is normalised (lower case, runs of anything but letters and digits, so
line breaks and comment signs too, become one space).  Its windows of words are
compared with every template by the Dice coefficient over distinct word bigrams,
``2 |A & B| / (|A| + |B|)``.  So a notice counts wherever it stands: wrapped over
lines, in a comment block, or inside a longer sentence.  The best window of a
template begins and ends with one of its bigrams, as others at the ends only
lower the coefficient; every such window of up to ``(2 - t) / t`` times the
template's length is scored.  The whole text, its lines and the sentences of its
lines are units of any length besides, as they may repeat bigrams.

Licences share wording, so one notice can match templates of several.  Of templates
of different licences whose best windows overlap only the one with the greatest
coefficient is kept, from the best downwards; a template that has no window but
matches a unit is kept as it is.  Two bounds prune without loss:

* size: a coefficient of ``t`` needs ``|A|`` between ``t / (2 - t)`` and
  ``(2 - t) / t`` times ``|B|``;
* prefix: it also needs ``t / (2 - t)`` of B's bigrams to be shared, so any set
  that holds more than the remaining part of B must be hit.  The longest
  words of each template give that set, and a text that holds none of the
  set's words is passed over.  For windows, as many of the text's bigrams must
  be B's and stand close enough.

Everything is built-in functions; the templates are a fixed table.

Defined cases: null, empty and one-word texts match nothing.  Ties between
templates go to the first in the table.  Rows are scanned one by one, so
repeated rows give repeated results, and null ids pass through.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.base import unused
from folio.operators.chunking import let

# --- fixed values -----------------------------------------------------------
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("BSD", "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)
LEAST_DICE = 0.8
# ----------------------------------------------------------------------------


def _words(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def _template_bigrams(text: str) -> list[str]:
    w = _words(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def _gate(templates, least: float) -> tuple[list[str], list[str]]:
    """Words and bigrams one of which is in every matching unit, for any template.

    For each template they touch more bigrams than a match can lack.  Long
    words come first; bigrams stand in where a template has too few.
    """
    words: list[str] = []
    pairs: list[str] = []
    for _, text in templates:
        grams = _template_bigrams(text)
        lack = len(grams) - math.ceil(len(grams) * least / (2 - least) - 1e-9)
        long = sorted({w for g in grams for w in g.split() if len(w) >= 5}, key=lambda w: (-len(w), w))
        left = sorted(grams, key=lambda g: (-len(g), g))
        touched = lambda: sum(g in pairs or any(w in g.split() for w in words) for g in grams)
        while touched() <= lack:
            if long:
                words += [w for w in [long.pop(0)] if w not in words]
            else:
                pairs += [g for g in [left.pop(0)] if g not in pairs]
    return words, pairs


def _passes(text: Column, gate: tuple[list[str], list[str]]) -> Column:
    words, pairs = gate
    ok = F.lit(False)
    for w in words:
        ok = ok | F.contains(text, F.lit(w))
    if pairs:
        ok = ok | text.rlike("|".join(g.replace(" ", r"[^\p{L}\p{N}]+") for g in pairs))
    return ok


def _normal(unit: Column) -> Column:
    return F.trim(F.regexp_replace(unit, r"[^\p{L}\p{N}]+", " "))


def _bigrams(words: Column) -> Column:
    n = F.size(words)
    return F.array_distinct(F.zip_with(F.slice(words, 1, n - 1), F.slice(words, 2, n - 1), lambda a, b: F.concat_ws(" ", a, b)))


def _units(text: Column) -> Column:
    """The whole text, its lines, and the sentences of lines with several."""
    lines = F.split(text, "\n", -1)
    sentences = F.flatten(F.transform(lines, lambda s: F.split(s, r"(?<=[.!?;:])\s+", -1)))
    return F.array_distinct(F.concat(F.array(text), lines, sentences))


def _window_scores(text: Column, templates, least: float) -> Column:
    """(dice, template, first and last bigram) of the best window of each template that has one; the first of equals."""
    sets = [_template_bigrams(t) for _, t in templates]
    every = sorted({g for grams in sets for g in grams})

    def of_template(grams: Column, marked: Column, i: int) -> Column:
        own, n = sets[i], len(sets[i])
        need = max(1, math.ceil(n * least / (2 - least) - 1e-9))
        longest = math.floor((len(_words(templates[i][1])) - 1) * (2 - least) / least + 1e-9)

        def best(m: Column) -> Column:
            """Best coefficient of the windows from one of the marks ``m`` to another."""
            at = lambda k: F.element_at(m, k.cast("int"))["i"]
            close = lambda lo, hi: at(hi) - at(lo) < longest

            def dice(lo: Column, hi: Column) -> Column:
                shared = F.size(F.array_distinct(F.transform(F.slice(m, lo, hi - lo + 1), lambda x: x["g"])))
                size = F.size(F.array_distinct(F.slice(grams, at(lo) + 1, at(hi) - at(lo) + 1)))
                return F.lit(2.0) * shared / (size + F.lit(n))

            begins = F.filter(F.sequence(F.lit(1), F.size(m) - (need - 1)), lambda k: close(k, k + (need - 1)))
            from_one = lambda k: F.array_max(F.transform(
                F.filter(F.sequence(k + (need - 1), F.least(F.size(m), k + (longest - 1))), lambda e: close(k, e)),
                lambda e: F.struct(dice(k, e).alias("dice"), (-at(k)).alias("lo"), (-at(e)).alias("hi"))))
            return F.when(F.size(m) >= need, F.array_max(F.transform(begins, from_one)))

        return F.transform(F.array(F.filter(marked, lambda x: x["g"].isin(own))), best)[0]

    def of_text(grams: Column) -> Column:
        marks = F.filter(F.transform(grams, lambda g, i: F.struct(i.alias("i"), g.alias("g"))), lambda x: x["g"].isin(every))
        one = lambda m, i: let(of_template(grams, m, i), lambda b: F.struct(
            b["dice"].alias("dice"), F.lit(i).alias("i"), (-b["lo"]).alias("lo"), (-b["hi"]).alias("hi")))
        each = lambda m: F.array(*[one(m, i) for i in range(len(sets))])
        return F.transform(F.array(marks), each)[0]

    pairs = lambda w: F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat_ws(" ", a, b))
    grams = F.transform(F.array(F.split(_normal(text), " ")), pairs)[0]
    return F.filter(F.transform(F.array(grams), of_text)[0], lambda s: s["dice"] >= least)


def _best_of_spans(hits: Column, templates) -> Column:
    """``hits`` without those whose window overlaps a better one of another licence; as many as templates at most."""
    names = list(dict.fromkeys(n for n, _ in templates))
    licence = lambda x: F.get(F.lit([names.index(n) for n, _ in templates]), x["i"])
    beats = lambda y, x: (licence(y) != licence(x)) & (y["lo"] <= x["hi"]) & (x["lo"] <= y["hi"])

    def choose(hs: Column) -> Column:
        placed = F.array_sort(F.transform(F.filter(hs, lambda h: h["lo"].isNotNull()), lambda h: F.struct(
            (-h["dice"]).alias("low"), h["i"].alias("i"), h["lo"].alias("lo"), h["hi"].alias("hi"))))
        none = F.array().cast("array<struct<low:double,i:int,lo:int,hi:int>>")
        kept = let(placed, lambda ps: F.aggregate(ps, none, lambda acc, x: F.when(
            F.exists(acc, lambda y: beats(y, x)), acc).otherwise(F.concat(acc, F.array(x)))))
        lost = lambda ks, h: F.exists(hs, lambda g: (g["i"] == h["i"]) & g["lo"].isNotNull()) & ~F.exists(ks, lambda k: k["i"] == h["i"])
        return let(kept, lambda ks: F.filter(hs, lambda h: ~lost(ks, h)))

    return let(hits, choose)


def licences(docs: DataFrame, text: str = "text", templates=TEMPLATES, least: float = LEAST_DICE, every: bool = False) -> DataFrame:
    """``docs`` with ``licences``: array of (licence, dice), the best unit or window of each licence found.

    With ``every``, licences whose windows overlap a better one's are listed too.
    """
    grams = [(name, _template_bigrams(t)) for name, t in templates]
    low = min(len(g) for _, g in grams) * least / (2 - least)
    ratio = (2 - least) / least

    gate, nowhere = _gate(templates, least), F.lit(None).cast("int")

    def scores(words: Column) -> Column:
        """(dice, template) of every template within the size bound."""
        def one(b: Column) -> Column:
            n = F.size(b)
            each = [F.when(n.between(math.ceil(len(g) / ratio - 1e-9), math.floor(len(g) * ratio + 1e-9)),
                           F.lit(2.0) * F.size(F.array_intersect(b, F.array(*map(F.lit, g)))) / (n + F.lit(len(g))))
                    for _, g in grams]
            return F.array(*[F.struct(F.coalesce(e, F.lit(0.0)).alias("dice"), F.lit(i).alias("i"), nowhere.alias("lo"), nowhere.alias("hi"))
                             for i, e in enumerate(each)])
        return F.transform(F.array(_bigrams(words)), one)[0]

    t_, h_ = unused(docs, "lowered", "hits")
    units = F.filter(_units(F.col(t_)), lambda u: _passes(u, gate))
    sized = F.filter(F.transform(units, lambda u: F.split(_normal(u), " ")), lambda w: (F.size(w) > 1) & (F.size(w) > low))
    # a unit with more words than the bound can still have few distinct bigrams, so only the lower bound applies to words
    hits = F.filter(F.flatten(F.transform(sized, scores)), lambda s: s["dice"] >= least)
    hits = F.concat(hits, _window_scores(F.col(t_), templates, least))
    hits = hits if every else _best_of_spans(hits, templates)
    empty = F.array().cast("array<struct<dice:double,i:int,lo:int,hi:int>>")
    out = docs.select("*", F.inline(F.array(F.struct(F.lower(F.col(f"`{text}`")).alias(t_)))))
    out = out.select("*", F.inline(F.array(F.struct(F.when(_passes(F.col(t_), gate), hits).otherwise(empty).alias(h_)))))
    names = list(dict.fromkeys(n for n, _ in grams))

    def best_of(name: str) -> Column:
        own = [i for i, (n, _) in enumerate(grams) if n == name]
        dice = F.transform(F.filter(F.col(h_), lambda s: s["i"].isin(own)), lambda s: s["dice"])
        return F.struct(F.lit(name).alias("licence"), F.array_max(dice).alias("dice"))

    best = [best_of(n) for n in names]
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "licences"]
    return out.select(*rest, F.when(F.size(h_) > 0, F.filter(F.array(*best), lambda b: b["dice"].isNotNull())).otherwise(
        F.array().cast("array<struct<licence:string,dice:double>>")).alias("licences"))


def op6_licences(spark, sf_dir: str) -> DataFrame:
    """One row per document: licences found, and the best coefficient (null when none)."""
    out = licences(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    first = F.array_max(F.transform("licences", lambda x: F.round(x["dice"], 6)))
    return out.select("doc_id", F.array_join(F.transform("licences", lambda x: x["licence"]), ",").alias("licences"),
                      F.size("licences").cast("bigint").alias("n_licences"), first.alias("best_dice"))
