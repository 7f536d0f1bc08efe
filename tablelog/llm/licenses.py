"""Licences in texts by sentence rules (operator 8).

A text is cut into sentences, which are normalised: lower case, only letters and digits, single
spaces. Known sentences map to identifiers; the identifiers of a text, in order, are a sequence, with a
marker where other sentences stand between. A rule is a sequence too, and a licence is found where its
rule stands in the text's sequence. Longer rules go first, and what a rule has matched no other uses.

Sentences end at signs and empty lines, and may end at any line end: a known sentence begins and ends at
either kind of cut and goes over line ends, so that wrapped notices and single lines are both found.

A text can hold a known sentence only if it holds the sentence's words. ``_triggers`` picks a few
words such that every known sentence has one; texts without any are done at once.

Only DataFrame functions run here. Sentences and rules are small tables of parameters.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelog.llm.storage import column

# Sentences of well-known licences and notices, as these print them.
SENTENCES: dict[str, str] = {
    "apache-line": "Licensed under the Apache License, Version 2.0.",
    "apache-head": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-asis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "mit-line": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "gpl3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-fitness": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-nc4-line": "Licensed under CC BY-NC 4.0.",
    "cc-by4-line": "Licensed under CC BY 4.0.",
    "cc-by-sa4-line": "Licensed under CC BY-SA 4.0.",
    "cc0-line": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

# Licence and the sentences that state it, in order.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache-line",)),
    ("Apache-2.0", ("apache-head", "apache-use")),
    ("Apache-2.0", ("apache-head", "apache-use", "apache-copy", "apache-asis")),
    ("MIT", ("mit-line",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-grant", "mit-notice")),
    ("ISC", ("isc-grant",)),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("GPL-3.0-only", ("gpl3-line",)),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope", "gpl-fitness")),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-hope", "gpl-fitness")),
    ("MPL-2.0", ("mpl2",)),
    ("CC-BY-NC-4.0", ("cc-by-nc4-line",)),
    ("CC-BY-4.0", ("cc-by4-line",)),
    ("CC-BY-SA-4.0", ("cc-by-sa4-line",)),
    ("CC0-1.0", ("cc0-line",)),
    ("Unlicense", ("unlicense",)),
]

#: A sentence ends at a sign that white space or a quote follows, or at an empty line.
SIGN_END = r"(?<=[.;:!?])(?=[\s\"')]|$)"
SENTENCE_END = SIGN_END + r"|\n\s*\n"
#: A line of nothing but comment marks, white space and the like is an empty one.
EMPTY_LINE = r"\n[\x00-\x09\x0b-/:-@\[-`{-\x7f]*(?=\n)"
#: What stands alone before the sentences of a list.
NUMBER = r"(?:[0-9]{1,3}|[a-z]|[ivx]{1,5})"
#: In the sequence, other sentences.
OTHER = "\x01"


def _plain(x: str) -> str:
    return " ".join(re.sub(r"[^a-z0-9\u0080-\U0010ffff]+", " ", x.lower()).split())


def _cut(low: Column) -> Column:
    """A lower-case text as words with one sign between: a space, a line end, or ``\\x01`` for the end
    of a sentence, which also stands before and after."""
    out = F.regexp_replace(F.translate(low, "\x01", " "), SIGN_END, "\x01")
    out = F.concat(F.lit("\x01"), F.regexp_replace(out, EMPTY_LINE, "\x01"), F.lit("\x01"))
    out = F.regexp_replace(out, r"[^a-z0-9\n\x01\x{80}-\x{10ffff}]+", " ")
    return F.regexp_replace(F.regexp_replace(out, r" ?\n[ \n]*", "\n"), r"[ \n]?\x01[ \n\x01]*", "\x01")


def _pattern(known: Mapping[str, str]) -> str:
    """Known sentences between cuts, the longest that begins at a place first."""
    every = "|".join(x.replace(" ", r"[ \n]") for x in sorted(known, key=lambda x: -len(x)))
    return rf"(?<=[\n\x01])({every})(?=[\n\x01])"


def _known(sentences: Mapping[str, str]) -> tuple[dict[str, str], dict[str, list[str]]]:
    """Identifier by normalised sentence, and identifiers by name: a text that the cut divides has
    one for each part, and equal parts of different texts share theirs."""
    known: dict[str, str] = {}
    parts: dict[str, list[str]] = {}
    for name, text in sentences.items():
        cut = [x for x in map(_plain, re.split(SENTENCE_END, text)) if x]
        parts[name] = [known.setdefault(x, name if len(cut) == 1 else f"{name}/{i}") for i, x in enumerate(cut, 1)]
    return known, parts


def _triggers(sentences: Sequence[str]) -> list[str]:
    """A few words such that every sentence has one: again and again the word that most of the
    sentences without one have. Words of six letters or more are preferred, being rarer."""
    left, chosen = list(sentences), []
    while left:
        words = {w for x in left for w in ([w for w in x.split() if len(w) > 5] or x.split())}
        chosen.append(max(words, key=lambda w: (sum(w in x for x in left), len(w), w)))
        left = [x for x in left if chosen[-1] not in x]
    return chosen


def scan_licenses(
    docs: DataFrame,
    *,
    sentences: Mapping[str, str] | None = None,
    rules: Sequence[tuple[str, Sequence[str]]] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, sentences, licenses)`` for every row of ``docs``.

    ``sentences`` are the identifiers of known sentences in the order of the text, repeated as often
    as they stand there. A line end is read as a space or as the end of a sentence, whichever makes the
    longer known one at that place. A rule does not match over other sentences, which numbers of a list
    are not. ``licenses`` are the licences found, each once, sorted. A NULL or empty text
    has neither. Equal rows give equal rows. Of rules with equal sequences the first counts. An empty
    table gives no rows. Other columns are ignored.
    """
    known, parts = _known(SENTENCES if sentences is None else sentences)
    rules = [(name, [i for x in ids for i in parts[x]]) for name, ids in (RULES if rules is None else rules)]
    rules = sorted(rules, key=lambda x: -len(x[1]))
    rows = docs.select(column(docs, key).alias("doc_id"), F.coalesce(column(docs, text), F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    if not known:
        return rows.select("doc_id", none.alias("sentences"), none.alias("licenses"))
    low, may = F.lower("text"), F.lit(False)
    for word in _triggers(list(known)):
        may |= low.contains(word)
    names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    out = rows.withColumn("may", may).withColumn("cut", F.when(F.col("may"), _cut(low))).drop("text")
    pattern = _pattern(known)
    out = out.withColumn("held", F.regexp_extract_all("cut", F.lit(pattern), F.lit(1)))
    out = out.withColumn("sentences", F.coalesce(F.transform("held", lambda x: F.element_at(names, F.translate(x, "\n", " "))), none))
    out = out.withColumn("gaps", F.when(F.size("held") > 1, F.split("cut", pattern, -1)))
    other = lambda i: F.regexp_replace(F.get("gaps", i), rf"(?<=[\n\x01]){NUMBER}(?=[\n\x01])", "").rlike(r"[^\n\x01]")
    marked = F.flatten(F.transform("sentences", lambda x, i: F.when((i > 0) & other(i), F.array(F.lit(OTHER), x)).otherwise(F.array(x))))

    # The sequence as text, one sign per end of a name, so that a rule is found as a stretch of it.
    sequence = F.concat(F.lit("\n"), F.array_join(F.transform(marked, lambda x: F.concat(x, F.lit("\n\n"))), "\n"))
    asked = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("\n" + "\n\n\n".join(ids) + "\n\n").alias("ids")) for name, ids in rules if ids])

    def match(done, rule):
        here = F.contains(done["rest"], rule["ids"])
        return F.struct(
            F.when(here, F.replace(done["rest"], rule["ids"], F.lit("\n-"))).otherwise(done["rest"]).alias("rest"),
            F.when(here, F.concat(done["found"], F.array(rule["name"]))).otherwise(done["found"]).alias("found"),
        )

    start = F.struct(sequence.alias("rest"), none.alias("found"))
    matched = F.aggregate(asked, start, match, lambda x: F.array_sort(F.array_distinct(x["found"]))) if rules else none
    return out.withColumn("licenses", F.when(F.size("sentences") > 0, matched).otherwise(none)).select("doc_id", "sentences", "licenses")
