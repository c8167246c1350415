"""Licence scan: lines and sentences of documents against licence sentences, by Dice's coefficient over word bigrams.

A unit is a line, or a sentence wherever its line breaks stand: sentences end at a blank line, at a colon that ends
a line, and at a full stop, exclamation or question mark before white space (or a comment's marks) and a capital, quote mark or bracket. So a notice that shares
its line with prose is found as a sentence, one without a full stop as a line, one that is wrapped over lines or
stands in a comment as a sentence, and a whole licence by its sentences.

A unit is normalised: A-Z in lower case, every run of other characters than a-z and 0-9 one space. Its distinct
word bigrams are compared with those of each template: 2 x common / (own + template's). A unit reaches a
coefficient of t only if its number of bigrams lies between t / (2 - t) and (2 - t) / t times the template's, so
only such templates are candidates; and as it must then hold more than two thirds of the template's bigrams (for
t = 0.8), it holds one of any third of them. Documents, and then units, that hold none of those are left out before any
bigram is built. Both conditions are exact, and all are plain column expressions: the whole operator runs in the JVM,
without a join or a shuffle. The normalised text goes through a generator of one row, so that it is computed once and
not once for each bigram that is looked for.

Defined results: a null or empty text has no units; a unit of fewer than two words has no bigrams and matches
nothing; an SPDX tag without a name reaches 0.8 with every tag of a one-word name; of templates that tie the one with the first name is reported; a unit that is both a line and a sentence is
reported as both; repeated rows are reported each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import whole_text

# Notices, tags and sentences of public licences.
TEMPLATES: dict[str, list[str]] = {
    "0BSD": ["SPDX-License-Identifier: 0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-or-later", "SPDX-License-Identifier: AGPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "BSD-2-Clause": [
        "Released under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0.", "SPDX-License-Identifier: BSL-1.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0"],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        "SPDX-License-Identifier: ISC", "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-or-later", "SPDX-License-Identifier: LGPL-2.1-only",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "MIT": [
        "Released under the MIT License.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
    "Zlib": ["SPDX-License-Identifier: Zlib", "This software is provided 'as-is', without any express or implied warranty."],
}

#: Letters from which on a bigram is long.
_LONG = 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Where sentences end; both engines read these alike. The mark between sentences.
_BLANK, _END, _MARK = r"[\n:][ \t\r]*\n", r"""([.!?])[ \t\r\n#*/;-]+([A-Z("'\[])""", "\x01"


def bigrams_of(text: str) -> list[str]:
    """Distinct word bigrams of a text, sorted."""
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def _known(templates: dict[str, list[str]]) -> list[tuple[str, list[str]]]:
    return [(name, own) for name, texts in sorted(templates.items()) for t in texts if (own := bigrams_of(t))]


def _sizes(n: int, t: float) -> tuple[int, int]:
    """Least and most bigrams of a unit that can reach t with a template of n."""
    return math.ceil(t / (2 - t) * n - 1e-9), math.floor((2 - t) / t * n + 1e-9)


def sure_bigrams(known: list[tuple[str, list[str]]], threshold: float) -> list[str]:
    """Of each template so many bigrams that a match has one of them: long ones that many templates share, so that there are
    few in all, then the longest, as those are rare in prose."""
    shared, some = Counter(b for _, own in known for b in own if len(b) >= _LONG), set()
    for _, own in known:
        wanted = math.floor(len(own) - threshold * len(own) / (2 - threshold) + 1e-9) + 1
        some.update(sorted(own, key=lambda b: (-shared[b], -len(b), b))[:wanted])
    return sorted(some)


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), "[^a-z0-9]+", " "))


def _bigrams(unit: Column) -> Column:
    words = F.split(unit, " ")
    pairs = F.transform(F.slice(words, 1, F.size(words) - 1), lambda w, k: F.concat_ws(" ", w, F.element_at(words, k + 2)))
    return F.array_distinct(pairs)


def scan(docs: DataFrame, threshold: float = 0.8, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """(doc_id, unit, place, license, dice): the best template of each line or sentence that reaches ``threshold``; both
    count from 1."""
    known = _known(templates or TEMPLATES)
    sure = F.array(*map(F.lit, sure_bigrams(known, threshold)))
    holds_some = lambda c: F.exists(sure, lambda pair: F.contains(F.col(c), pair))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    # a generator of one row: what stands behind it is computed once
    rows = rows.select("doc_id", "text", F.explode(F.array(_plain(F.col("text")))).alias("plain")).filter(holds_some("plain"))
    marked = F.regexp_replace(F.regexp_replace("text", _BLANK, _MARK), _END, f"$1{_MARK}$2")
    units = F.array(F.struct(F.lit("line").alias("unit"), F.split("text", "\n").alias("texts")), F.struct(F.lit("sentence").alias("unit"), F.split(marked, _MARK).alias("texts")))
    parts = rows.select("doc_id", F.inline(units)).select("doc_id", "unit", F.posexplode(F.transform("texts", _plain)).alias("at", "own_text"))
    # a unit of w words has at most w - 1 distinct bigrams, so its words bound its size from above before any are built
    n_words = F.length("own_text") - F.length(F.replace("own_text", F.lit(" "), F.lit(""))) + 1
    least = min(_sizes(len(own), threshold)[0] for _, own in known)
    parts = parts.filter(n_words - 1 >= least).filter(holds_some("own_text"))
    parts = parts.select("doc_id", "unit", (F.col("at") + 1).alias("place"), F.explode(F.array(_bigrams(F.col("own_text")))).alias("own"))
    table = F.array(*(
        F.struct(F.lit(-k).alias("rank"), F.array(*map(F.lit, own)).alias("other"), *(F.lit(s).alias(c) for c, s in zip(("low", "high"), _sizes(len(own), threshold), strict=True)))
        for k, (_, own) in enumerate(known)
    ))
    n = F.size("own")

    def score(t: Column) -> Column:
        dice = F.lit(2.0) * F.size(F.array_intersect("own", t["other"])) / (n + F.size(t["other"]))
        return F.struct(F.when((n >= t["low"]) & (n <= t["high"]), dice).otherwise(F.lit(0.0)).alias("dice"), t["rank"].alias("rank"))

    best = parts.select("doc_id", "unit", "place", F.explode(F.array(F.array_max(F.transform(table, score)))).alias("best")).filter(F.col("best.dice") >= threshold)
    names = F.array(*(F.lit(name) for name, _ in known))
    return best.select("doc_id", "unit", "place", F.element_at(names, F.lit(1) - F.col("best.rank")).alias("license"), F.col("best.dice").alias("dice"))


def scan_sql(threshold: float = 0.8) -> str:
    """The same rows in plain SQL, every line and every sentence against every template."""
    text = lambda t: "'" + t.replace("'", "''") + "'"
    values = ", ".join(f"({text(name)}, {k}, [{', '.join(map(text, own))}])" for k, (name, own) in enumerate(_known(TEMPLATES)))
    end = _END.replace("'", "''")
    return f"""
with texts as (select cast(doc_id as bigint) as doc_id, coalesce(text, '') as text from documents),
raw as (
  select doc_id, 'line' as unit, string_split(text, chr(10)) as parts from texts
  union all
  select doc_id, 'sentence', string_split(regexp_replace(regexp_replace(text, '{_BLANK}', chr(1), 'g'), '{end}', '\\1' || chr(1) || '\\2', 'g'), chr(1)) from texts),
spread as (select doc_id, unit, unnest(range(1, len(parts) + 1)) as place, unnest(parts) as raw from raw),
plain as (
  select doc_id, unit, place, string_split(trim(regexp_replace(translate(raw, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ') as words from spread),
own as (select doc_id, unit, place, list_distinct([words[k] || ' ' || words[k + 1] for k in range(1, len(words))]) as own from plain where len(words) > 1),
known(license, rank, other) as (values {values}),
scored as (
  select doc_id, unit, place, license, rank, 2.0::double * len(list_intersect(own, other)) / (len(own) + len(other)) as dice from own, known
  where list_has_any(own, other)),
ranked as (select *, row_number() over (partition by doc_id, unit, place order by dice desc, rank) as nth from scored)
select doc_id, unit, cast(place as integer) as place, license, dice from ranked where nth = 1 and dice >= {threshold}"""
