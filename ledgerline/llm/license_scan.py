"""Licence scan, in DataFrame expressions only.

Texts are cut into lines and into paragraphs of several lines. A unit is
normalised (lower case; everything but letters and digits reads as one space)
and compared with licence templates by the Dice coefficient of their sets of
word bigrams, 2|A n B| / (|A| + |B|).

Two tests come before any set is built or compared, and neither can lose a
match. Size: a unit of a bigrams reaches Dice t with a template of b only if
t/(2-t) <= a/b <= (2-t)/t. Words: a match shares so many bigrams with the
template that it cannot avoid all of a chosen few; a unit without any of their
key words is dropped.

Templates are constants of the plan. Nothing is broadcast, and only the hits of
a document are shuffled, added up per licence before and after.

Defined results: null and empty texts match nothing; repeated rows count as one
document's further hits; a unit of fewer than two words has no bigram and
matches nothing; an empty table gives no rows. Lines of any length are read
whole. Only the named columns are read, so extra ones cannot clash.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, functions as F

DICE = 0.8

# Public licence notices and the opening passages of public licences.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "BSD": (
        "Licensed under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC0-1.0": ("This work is dedicated to the public domain under CC0 1.0 Universal.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "All-Rights-Reserved": ("All rights reserved.",),
}


def bigrams(text: str) -> list[str]:
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Sizes that a set can have to reach the threshold with one of n bigrams."""
    return math.ceil(n * threshold / (2 - threshold) - 1e-9), math.floor(n * (2 - threshold) / threshold + 1e-9)


def key_words(grams: list[str], threshold: float) -> set[str]:
    """Words of which a match with the template holds one at least.

    A match shares at least as many bigrams as the least size allows, so it
    cannot miss all of any (size - least + 1); those with the longest words
    are chosen, and of each its longer word.
    """
    least = size_bounds(len(grams), threshold)[0]
    longest = sorted(grams, key=lambda g: (-max(map(len, g.split())), g))
    return {max(g.split(), key=lambda w: (len(w), w)) for g in longest[:len(grams) - least + 1]}


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, threshold: float = DICE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and licence: doc_id, license_id, dice (the best),
    n_hits (units that match a template of it)."""
    known = [(name, bigrams(t)) for name, ts in templates.items() for t in ts]
    known = [(name, g) for name, g in known if g]
    bounds = [size_bounds(len(g), threshold) for _, g in known]
    keys = sorted(set().union(*(key_words(g, threshold) for _, g in known)))
    literal = F.array(*[F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, g)).alias("grams"),
                                 F.lit(len(g)).alias("n"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
                        for (name, g), (lo, hi) in zip(known, bounds)])
    texts = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    paragraphs = F.filter(F.split("t", r"\n[ \t\r]*\n"), lambda p: p.contains("\n"))
    units = texts.select("doc_id", F.explode(F.concat(F.split("t", "\n"), paragraphs)).alias("unit"))
    words = units.select("doc_id", F.split(
        F.trim(F.regexp_replace(F.lower("unit"), r"[^\p{L}\p{N}]+", " ")), " ").alias("w"))
    # repeated bigrams make the set smaller than the words, never larger
    near = words.filter(F.size("w") > min(lo for lo, _ in bounds)).filter(
        F.arrays_overlap("w", F.array(*map(F.lit, keys))))
    grams = near.select("doc_id", F.expr(
        "array_distinct(transform(sequence(0, size(w) - 2), i -> concat(w[i], ' ', w[i + 1])))").alias("g"))
    fits = F.filter(literal, lambda x: F.size("g").between(x["lo"], x["hi"]))
    pairs = grams.select("doc_id", "g", F.explode(fits).alias("x"))
    dice = 2.0 * F.size(F.array_intersect("g", F.col("x.grams"))) / (F.size("g") + F.col("x.n"))
    hits = pairs.select("doc_id", F.col("x.name").alias("license_id"), dice.alias("dice")).filter(
        F.col("dice") >= threshold)
    return hits.groupBy("doc_id", "license_id").agg(F.max("dice").alias("dice"), F.count("*").alias("n_hits"))


def op2_oracle() -> str:
    """The plain comparison of every unit with every template, in DuckDB SQL."""
    rows = ", ".join("('{}', [{}])".format(name, ", ".join(f"'{x}'" for x in bigrams(t)))
                     for name, ts in TEMPLATES.items() for t in ts)
    return f"""
WITH l(license_id, b) AS (VALUES {rows}),
d AS (SELECT doc_id, text AS t FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS u FROM d
      UNION ALL SELECT doc_id, p FROM (SELECT doc_id, unnest(regexp_split_to_array(t, '\\n[ \\t\\r]*\\n')) AS p FROM d)
      WHERE contains(p, chr(10))),
w AS (SELECT doc_id, string_split(trim(regexp_replace(lower(u), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w FROM u),
g AS (SELECT doc_id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
      FROM w WHERE len(w) >= 2),
h AS (SELECT doc_id, license_id, 2.0::DOUBLE * len(list_intersect(g, b)) / (len(g) + len(b)) AS dice FROM g, l
      WHERE len(g) <= 2 * len(b) AND len(b) <= 2 * len(g))
SELECT doc_id, license_id, max(dice) AS dice, count(*) AS n_hits FROM h WHERE dice >= {DICE} GROUP BY ALL"""
