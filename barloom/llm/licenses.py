"""Licence scan: normalised text against licence templates, by Dice coefficient over word bigrams.

Everything is a DataFrame expression: a text is cut into units (lines, paragraphs, the whole), a
unit's distinct word bigrams are compared with those of each template whose size allows the asked
similarity. Dice = 2 * shared / (|A| + |B|) can reach d only if |A| lies in |B| * d / (2 - d) ..
|B| * (2 - d) / d. Templates are literals in the plan; only matches are shuffled.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices and permission texts of public licences.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _template_bigrams(text: str) -> list[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def _words(unit: Column) -> Column:
    plain = F.regexp_replace(F.translate(unit, _UPPER, _LOWER), "[^a-z0-9]+", " ")
    return F.split(F.trim(plain), " ")


def license_scan(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`id_col`, license, dice (best of the document, 6 decimals) and n_units (units that match) for each match of at least `least`.

    Words are runs of a-z and 0-9 after A-Z are lower-cased. A unit or template of fewer than two
    words has no bigrams and matches nothing; null and empty texts give no row. Several templates
    may share a name; a unit counts once per name. Equal units of one text count once, and equal
    scores need no rule since only the best score is kept. Null ids form one group, repeated rows
    add up. Other columns are not read.
    """
    known = [(name, bigrams) for name, text in templates if (bigrams := _template_bigrams(text))]
    low, high = least / (2 - least), (2 - least) / least
    sizes = [len(b) for _, b in known]
    shortest, longest = math.ceil(min(sizes) * low), math.floor(max(sizes) * high)
    text = F.col("text")
    units = F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, "\n[ \t\r]*\n"), F.array(text)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).select("id", F.explode(units).alias("unit"))
    rows = rows.where(F.length("unit") >= 2 * shortest + 1)  # so many words need as many letters and blanks between
    # explode(array(x)) computes x once; a plain column would be put into every expression that uses it
    rows = rows.select("id", F.explode(F.array(_words(F.col("unit")))).alias("words")).where(F.size("words") > shortest)
    pairs = F.transform(F.slice("words", 2, F.size("words") - 1), lambda w, k: F.concat(F.element_at("words", (k + 1).cast("int")), F.lit(" "), w))
    # a unit has at least as many bigrams as its distinct words less one, so a longer unit of many words cannot match
    rows = rows.where(F.size(F.array_distinct("words")) - 1 <= longest)
    rows = rows.select("id", F.explode(F.array(F.array_distinct(pairs))).alias("bigrams")).where(F.size("bigrams").between(shortest, longest))
    rows = rows.where(F.arrays_overlap("bigrams", F.array(*[F.lit(x) for x in sorted({x for _, b in known for x in b})])))
    size = F.size("bigrams")

    def dice(bigrams: list[str]) -> Column:
        shared = F.size(F.array_intersect("bigrams", F.array(*[F.lit(x) for x in bigrams])))
        possible = size.between(math.ceil(len(bigrams) * low), math.floor(len(bigrams) * high))
        return F.when(possible, F.round(2.0 * shared / (size + len(bigrams)), 6))

    scores: dict[str, list[Column]] = {}
    for name, bigrams in known:
        scores.setdefault(name, []).append(F.coalesce(dice(bigrams), F.lit(0.0)))
    best = [F.struct(F.lit(name).alias("license"), (F.greatest(*x) if len(x) > 1 else x[0]).alias("dice")) for name, x in scores.items()]
    rows = rows.select("id", F.explode(F.array(*best)).alias("m")).where(F.col("m.dice") >= least)
    out = rows.groupBy("id", F.col("m.license").alias("license")).agg(F.max("m.dice").alias("dice"), F.count(F.lit(1)).alias("n_units"))
    return out.withColumnRenamed("id", id_col)


def license_sql(templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = 0.8) -> str:
    """The scan of `documents` in SQL: every unit against every template, without bounds."""
    values = ", ".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(templates))
    words = "string_split(trim(regexp_replace(translate({}, '" + _UPPER + "', '" + _LOWER + "'), '[^a-z0-9]+', ' ', 'g'), ' '), ' ')"
    bigrams = "list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))"
    return f"""
WITH t AS (SELECT k, license, {bigrams} AS b FROM (SELECT k, license, {words.format('body')} AS w FROM (VALUES {values}) v(k, license, body))),
units AS (SELECT doc_id, row_id, unnest(list_distinct(list_concat(list_concat(string_split(text, chr(10)), regexp_split_to_array(text, '\\n[ \\t\\r]*\\n')), [text]))) AS unit
          FROM (SELECT doc_id, text, row_number() OVER () AS row_id FROM documents WHERE text IS NOT NULL)),
numbered AS (SELECT doc_id, row_number() OVER () AS unit_id, {words.format('unit')} AS w FROM units),
grams AS (SELECT doc_id, unit_id, {bigrams} AS b FROM numbered WHERE len(w) > 1),
tg AS (SELECT k, license, unnest(b) AS g, len(b) AS size FROM t),
ug AS (SELECT doc_id, unit_id, unnest(b) AS g, len(b) AS size FROM grams),
hits AS (SELECT ug.doc_id, unit_id, k, license, round(2.0 * count(*) / (max(ug.size) + max(tg.size)), 6) AS dice
         FROM ug JOIN tg USING (g) GROUP BY ALL),
best AS (SELECT doc_id, unit_id, license, max(dice) AS dice FROM hits GROUP BY ALL HAVING max(dice) >= {least})
SELECT doc_id, license, max(dice) AS dice, count(*) AS n_units FROM best GROUP BY doc_id, license"""
