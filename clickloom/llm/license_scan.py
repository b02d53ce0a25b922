"""Licence scan by sentence rules.

A text loses comment marks and list numbers at the beginning of its lines and is cut into
sentences, each is normalised and looked up among known licence
sentences, which gives a sequence of identifiers. Ordered rules are sequences of
identifiers; where several match at a place the earlier rule wins. Only texts that hold a
word every known sentence has one of are cut at all.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import full_text, put

# Sentences of public licences and of their usual notices. A letter names each.
SENTENCES = {
    "A": "Licensed under the Apache License, Version 2.0",
    "B": "You may not use this file except in compliance with the License",
    "C": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "D": "Released under the MIT License",
    "E": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    'software and associated documentation files (the "Software"), to deal in the Software '
    "without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
    "to whom the Software is furnished to do so, subject to the following conditions:",
    "F": "The above copyright notice and this permission notice shall be included in all copies "
    "or substantial portions of the Software",
    "G": "This work is licensed under the GNU General Public License, version 3",
    "H": "This program is free software: you can redistribute it and/or modify it under the "
    "terms of the GNU General Public License as published by the Free Software Foundation, "
    "either version 3 of the License, or (at your option) any later version",
    "I": "This program is free software; you can redistribute it and/or modify it under the "
    "terms of the GNU General Public License as published by the Free Software Foundation; "
    "either version 2 of the License, or (at your option) any later version",
    "J": "Licensed under CC BY-NC 4.0",
    "K": "Licensed under CC BY 4.0",
    "L": "Licensed under CC BY-SA 4.0",
    "M": "All rights reserved",
    "N": "Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer",
    "O": "Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution",
    "P": "Neither the name of the copyright holder nor the names of its contributors may be used "
    "to endorse or promote products derived from this software without specific prior written "
    "permission",
    "Q": "Permission to use, copy, modify, and/or distribute this software for any purpose with "
    "or without fee is hereby granted, provided that the above copyright notice and this "
    "permission notice appear in all copies",
    "R": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "S": "This is free and unencumbered software released into the public domain",
    "T": "This work is dedicated to the public domain under CC0 1.0",
    "U": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
    "file except in compliance with the License",
    "V": "You may obtain a copy of the License at",
    "W": "http://www.apache.org/licenses/LICENSE-2.0",
    "X": "Unless required by applicable law or agreed to in writing, software distributed under "
    'the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
    "KIND, either express or implied",
    "Y": "See the License for the specific language governing permissions and limitations under "
    "the License",
}
# Sequences of sentences, most telling first; names are SPDX identifiers where there is one.
RULES = [
    ("Apache-2.0", "UVWXY"),
    ("Apache-2.0", "UCXY"),
    ("Apache-2.0", "UVW"),
    ("Apache-2.0", "UC"),
    ("Apache-2.0", "U"),
    ("Apache-2.0", "ABC"),
    ("Apache-2.0", "AB"),
    ("BSD-3-Clause", "NOP"),
    ("BSD-2-Clause", "NO"),
    ("MIT", "EF"),
    ("Apache-2.0", "A"),
    ("MIT", "E"),
    ("MIT", "D"),
    ("GPL-3.0-or-later", "H"),
    ("GPL-2.0-or-later", "I"),
    ("GPL-3.0-only", "G"),
    ("CC-BY-NC-4.0", "J"),
    ("CC-BY-4.0", "K"),
    ("CC-BY-SA-4.0", "L"),
    ("ISC", "Q"),
    ("MPL-2.0", "R"),
    ("Unlicense", "S"),
    ("CC0-1.0", "T"),
    ("all-rights-reserved", "M"),
]
# every known sentence has one of these, each a part of one word, so no line break is in it
ANCHORS = ("licen", "permission", "reserved", "redistribut", "endorse", "domain")
# what is dropped at the beginning of lines: comment marks, then numbers of a list
LINE_STARTS = (
    r"(?m)^[ \t]*(?:/\*+|\*+/|\*+|//+|#+|;+|--+|%+)",
    r"(?m)^[ \t]*\(?[0-9]{1,2}[.)][ \t]+",
)

_NOISE = r"[^a-z0-9]+"


def normal(sentence: str) -> str:
    """Lower-case ASCII words and numbers, one space between."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in sentence)
    return re.sub(_NOISE, " ", lowered).strip(" ")


def letters() -> dict[str, str]:
    """Letter of each known sentence by its normalised text."""
    return {normal(text): letter for letter, text in SENTENCES.items()}


def licence_rules() -> str:
    """One pattern of all rules; alternatives are tried in order."""
    return "|".join(f"({sequence})" for _, sequence in RULES)


def _clean(piece: Column) -> Column:
    return F.trim(F.regexp_replace(piece, _NOISE, " "))


def _sentences(low: Column, known: Column) -> Column:
    """Normalised sentences of a lower-case text.

    A sentence ends with its mark or at an empty line. One that is not known and has
    several lines may be a heading or notice run together with its neighbours: its lines
    then count one by one.
    """
    for start in LINE_STARTS:
        low = F.regexp_replace(low, start, "")
    cut = F.split(low, r"[.!?]+[ \t\r\n]+|[.!?]+\z|\n[ \t\r]*\n", -1)
    lines = F.transform(
        cut,
        lambda s: F.when(F.element_at(known, _clean(s)).isNotNull(), F.array(_clean(s))).otherwise(
            F.transform(F.split(s, "\n", -1), _clean)
        ),
    )
    return F.filter(F.flatten(lines), lambda s: s != "")


def scan_licences(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``licence_sentences`` and ``licences``.

    ``licence_sentences`` lists the known sentences of the text in order, as (position
    among its sentences from 0, letter). ``licences`` lists the rules matched from left to
    right, without overlap; a rule matches known sentences that directly follow each other.

    Null and empty texts, and texts without a known sentence, have empty arrays. Very long
    texts are scanned whole. Rows that
    repeat each other each get their result. An empty table gives an empty table. Columns
    named like a result are replaced.
    """
    value = full_text(text)
    known = F.create_map(*[F.lit(x) for pair in letters().items() for x in pair])
    low = F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    named = F.filter(
        F.transform(
            _sentences(low, known),
            lambda s, i: F.struct(
                i.cast("long").alias("position"), F.element_at(known, s).alias("letter")
            ),
        ),
        lambda x: x["letter"].isNotNull(),
    )
    empty = F.array().cast("array<struct<position:bigint,letter:string>>")
    found = put(
        docs,
        {"licence_sentences": F.when(low.rlike("|".join(ANCHORS)), named).otherwise(empty)},
    )
    return put(found, {"licences": matched_rules(F.col("licence_sentences"))})


def matched_rules(sentences: Column) -> Column:
    """Names of the rules that match a sequence of (position, letter)."""
    # a gap in the positions separates letters, so no rule spans an unknown sentence
    spelled = F.array_join(
        F.transform(
            sentences,
            lambda x, i: F.concat(
                F.when(
                    (i > 0) & (x["position"] - sentences[i - F.lit(1)]["position"] > 1), F.lit("-")
                ).otherwise(""),
                x["letter"],
            ),
        ),
        "",
    )
    names = F.create_map(*[F.lit(x) for name, seq in RULES for x in (seq, name)])
    hits = F.regexp_extract_all(spelled, F.lit(licence_rules()), F.lit(0))
    return F.transform(hits, lambda s: F.element_at(names, s))
