"""Licence scan by Dice coefficient over word bigrams, in DataFrame functions only.

Texts and templates are normalised alike: lower case, words are runs of
``[0-9a-z]`` and of characters beyond ASCII.  A unit is a line, a paragraph
(between blank lines) or the whole text.  With A and T the sets of word bigrams
of a unit and a template, Dice = 2 |A n T| / (|A| + |T|).

Two bounds prune, neither of which loses a match.  Dice >= t needs
t |T| / (2 - t) <= |A| <= (2 - t) |T| / t, so a unit meets only templates of
fitting size, by an equi-join on the size.  And it needs at least
m = ceil(t |T| / (2 - t)) shared bigrams: the anchor words of a template touch
so many of its bigrams that fewer than m are left, so a text without any anchor
word holds no match.  Texts are tested for anchors before they are cut into units.

The result has one row per document and licence that some unit matches, with
the best Dice.  Defined results: null, empty and one-word texts match nothing;
rows that repeat a doc_id (null too) count as one document; an empty table gives
no rows; columns beside ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Wording of public licences and of the notices that name them.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
     file except in compliance with the License. You may obtain a copy of the License at
     http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
     software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
     CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
     permissions and limitations under the License."""),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are
     permitted provided that the following conditions are met: 1. Redistributions of source code must retain
     the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in
     binary form must reproduce the above copyright notice, this list of conditions and the following
     disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are
     permitted provided that the following conditions are met: 1. Redistributions of source code must retain
     the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in
     binary form must reproduce the above copyright notice, this list of conditions and the following
     disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the
     name of the copyright holder nor the names of its contributors may be used to endorse or promote products
     derived from this software without specific prior written permission."""),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0
     International License."""),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0
     International License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of
     the GNU General Public License as published by the Free Software Foundation, either version 3 of the
     License, or (at your option) any later version."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or
     without fee is hereby granted, provided that the above copyright notice and this permission notice appear
     in all copies."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
     and associated documentation files (the "Software"), to deal in the Software without restriction,
     including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
     and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
     subject to the following conditions: The above copyright notice and this permission notice shall be
     included in all copies or substantial portions of the Software."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
     copy of the MPL was not distributed with this file, You can obtain one at
     http://mozilla.org/MPL/2.0/."""),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

#: What separates words (a line feed too).
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def template_words(text: str) -> list[str]:
    return [w for w in re.split(GAP, text.lower()) if w]


def template_bigrams(text: str) -> list[str]:
    w = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def sizes(n: int, t: float) -> range:
    """Sizes of bigram sets that can reach Dice ``t`` with a set of size ``n``."""
    f = Fraction(str(t))
    return range(max(1, math.ceil(f * n / (2 - f))), math.floor((2 - f) * n / f) + 1)


def anchors(text: str, t: float) -> list[str]:
    """Words of which every unit that matches the template has at least one:
    longest first, until fewer bigrams than a match needs are untouched."""
    f = Fraction(str(t))
    left = set(template_bigrams(text))
    need = math.ceil(f * len(left) / (2 - f))
    chosen = []
    for w in sorted(set(template_words(text)), key=lambda w: (-len(w), w)):
        if len(left) < need:
            break
        touched = {b for b in left if w in b.split()}
        if touched:
            left -= touched
            chosen.append(w)
    return chosen


def words(text: Column) -> Column:
    """The words of a lowered text."""
    return F.filter(F.split(text, GAP), lambda w: w != "")


def bigrams(w: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    return F.array_distinct(F.zip_with(
        F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
        F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b)))


def units(text: Column) -> Column:
    """Lines, paragraphs and the whole of a lowered text, each once."""
    return F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, "\n[ \t\r]*\n"),
                                     F.array(text)))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, dice: the best Dice of each licence that a document matches."""
    every = sorted({w for _, text in templates for w in anchors(text, threshold)})
    fixed = [(name, grams, len(grams), k) for name, text in templates
             for grams in [template_bigrams(text)] for k in sizes(len(grams), threshold)]
    known = docs.sparkSession.createDataFrame(
        fixed, "license string, template array<string>, n_template int, size int")
    has_anchor = lambda w: F.arrays_overlap(w, F.array(*map(F.lit, every)))
    lowered = docs.select("doc_id", F.lower(F.col("text").cast("string")).alias("text"))
    near = lowered.where(has_anchor(F.split("text", GAP)))
    cut = near.select("doc_id", F.explode(units(F.col("text"))).alias("unit"))
    held = cut.select("doc_id", words(F.col("unit")).alias("w")).where(has_anchor(F.col("w")))
    sets = held.select("doc_id", bigrams(F.col("w")).alias("a")).withColumn("size", F.size("a"))
    # the template list is a constant of this module or the caller's literal list
    met = sets.join(F.broadcast(known), "size")
    dice = 2.0 * F.size(F.array_intersect("a", "template")) / (F.col("size") + F.col("n_template"))
    return (met.select("doc_id", "license", dice.alias("dice")).where(F.col("dice") >= threshold)
            .groupBy("doc_id", "license").agg(F.max("dice").alias("dice")))
