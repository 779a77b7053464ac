"""Licence texts and notices found by Dice coefficient over word bigrams, with DataFrame functions only.

The units compared are the whole text, its paragraphs and its lines. A Dice coefficient of at least *t* bounds the
sizes of what is compared, so a unit meets only the templates whose size is near its own, and most units meet none.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
PARAGRAPH_END = r"\n[\x20\t\r]*\n"

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions:")
_MIT_KEEP = ("The above copyright notice and this permission notice shall be included in all copies or substantial "
             "portions of the Software.")
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
    "SOFTWARE.")
_BSD_GRANT = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
              "that the following conditions are met:")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.")
_APACHE_HEADER = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
    "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
    "specific language governing permissions and limitations under the License.")
_GPL_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version {} of the License, or (at your option) any "
    "later version.")

#: Licence identifiers and the texts or notices that stand for them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", _APACHE_HEADER),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", _MIT_GRANT),
    ("MIT", _MIT_KEEP),
    ("MIT", _MIT_WARRANTY),
    ("MIT", f"{_MIT_GRANT} {_MIT_KEEP} {_MIT_WARRANTY}"),
    ("BSD", _BSD_GRANT),
    ("ISC", _ISC),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", _GPL_HEADER.format(2)),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _GPL_HEADER.format(3)),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def template_bigrams(text: str) -> list[str]:
    """Different word bigrams of a normalised text, in order."""
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def matches(df: DataFrame, text: str = "text", found: str = "matches", threshold: float = THRESHOLD,
            templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``df`` with the column ``found`` (replaced if there is one): array of (dice, license, unit), one entry per
    different unit that reaches ``threshold`` for some template, with its best one.

    Units are the whole text, paragraphs and lines; those with the same words count once. Bigrams count once per
    unit. Of templates that fit equally well the smaller identifier is taken. Null and empty texts, and units of
    fewer than two words, match nothing. One row per row of ``df``; no shuffle.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be over 0 and at most 1")
    sets = [(name, template_bigrams(said)) for name, said in templates]
    ratio = (2 - threshold) / threshold
    least, most = min(len(b) for _, b in sets) / ratio, max(len(b) for _, b in sets) * ratio

    def best(unit: Column, bigrams: Column) -> Column:
        scores = []
        for name, known in sets:
            literal = F.array(*(F.lit(b) for b in known))
            near = F.size(bigrams).between(len(known) / ratio - 1e-9, len(known) * ratio + 1e-9)
            dice = 2 * F.size(F.array_intersect(bigrams, literal)) / (F.size(bigrams) + len(known))
            scores.append(F.when(near, F.struct((-dice).alias("rank"), F.lit(name).alias("license"))))
        return _bound(F.array_min(F.array(*scores)), lambda s: F.struct(
            (-s["rank"]).alias("dice"), s["license"].alias("license"), unit.alias("unit")))

    plain = F.coalesce(F.col(text), F.lit(""))
    given = F.array_distinct(F.concat(F.array(plain), F.split(plain, PARAGRAPH_END, -1), F.split(plain, "\n", -1)))
    units = F.array_distinct(F.transform(
        given, lambda u: F.trim(F.regexp_replace(F.lower(u), "[^a-z0-9]+", " "))))
    worded = F.transform(F.filter(units, lambda u: F.length(u) > 2), lambda u: F.struct(
        u.alias("unit"), F.split(u, " ").alias("words")))
    sized = F.filter(worded, lambda u: F.size(u["words"]) > least)
    paired = F.transform(sized, lambda u: F.struct(u["unit"], F.array_distinct(F.zip_with(
        F.slice(u["words"], F.lit(1), F.size(u["words"]) - 1), F.slice(u["words"], F.lit(2), F.size(u["words"]) - 1),
        lambda a, b: F.concat_ws(" ", a, b))).alias("bigrams")))
    near = F.filter(paired, lambda u: F.size(u["bigrams"]).between(least, most))
    scored = F.transform(near, lambda u: best(u["unit"], u["bigrams"]))
    return df.withColumn(found, F.filter(scored, lambda m: m["dice"] >= threshold))
