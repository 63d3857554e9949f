"""Licence scans by sentence rules: normalised sentences become identifiers, sequences of them become licences.

A text is cut into sentences; a sentence that equals a known one after normalisation (ASCII lower case, only letters
and digits, single spaces) gives its identifier. A sentence may start and end with a line and may run over line breaks
and comment leaders, but not over a blank line; of two that start at the same place, the longer counts. Unknown
sentences are skipped. The rules are tried in order on the
sequence of identifiers; what a rule matches is taken, so that a later, shorter rule does not match it again.
"""

from collections import Counter

from pyspark.sql import DataFrame, functions as F

from chatterscope.llm.common import ascii_lower

# Sentences of public licence notices (texts of the licences and their recommended notices).
SENTENCES = [
    ("MIT-REF", "Released under the MIT License."),
    ("MIT-REF", "Licensed under the MIT License."),
    ("MIT-REF", "This project is licensed under the MIT License."),
    ("MIT-GRANT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT-NOTICE", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("AS-IS", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("APACHE2-REF", "Licensed under the Apache License, Version 2.0."),
    ("APACHE2-REF", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("APACHE2-USE", "you may not use this file except in compliance with the License."),
    ("APACHE2-COPY", "You may obtain a copy of the License at"),
    ("GPL3-REF", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL3-REF", "Licensed under the GNU General Public License, version 3."),
    ("GPL2-REF", "Licensed under the GNU General Public License, version 2."),
    ("GPL-FREE", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-NOWARRANTY", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"),
    ("LGPL-REF", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-GRANT", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-SOURCE", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD-BINARY", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-ENDORSE", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("MPL2-REF", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-REF", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-REF", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-REF", "Licensed under CC BY-NC 4.0."),
    ("CC0-REF", "Dedicated to the public domain under CC0 1.0."),
    ("RESERVED", "All rights reserved."),
]
RULES = [
    ("BSD-3-Clause", ["BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE"]),
    ("BSD-2-Clause", ["BSD-GRANT", "BSD-SOURCE", "BSD-BINARY"]),
    ("MIT", ["MIT-GRANT", "MIT-NOTICE", "AS-IS"]),
    ("MIT", ["MIT-REF"]),
    ("Apache-2.0", ["APACHE2-REF", "APACHE2-USE", "APACHE2-COPY"]),
    ("Apache-2.0", ["APACHE2-REF"]),
    ("GPL-3.0-or-later", ["GPL-FREE", "GPL-NOWARRANTY"]),
    ("GPL-3.0-or-later", ["GPL-FREE"]),
    ("GPL-3.0-only", ["GPL3-REF"]),
    ("GPL-2.0-only", ["GPL2-REF"]),
    ("LGPL-3.0-only", ["LGPL-REF"]),
    ("MPL-2.0", ["MPL2-REF"]),
    ("CC-BY-NC-4.0", ["CC-BY-NC-REF"]),
    ("CC-BY-SA-4.0", ["CC-BY-SA-REF"]),
    ("CC-BY-4.0", ["CC-BY-REF"]),
    ("CC0-1.0", ["CC0-REF"]),
    ("Proprietary", ["RESERVED"]),
]
# Marks put into a text: LINE where a line ends, END where a sentence or a paragraph does. Marks that a text holds itself
# become commas, which belong to no sentence.
LINE, END = "\u0001", "\u0002"
# A line break goes with the blanks before it and the comment leader or list mark after it.
LINE_BREAK = r"[ \t\r]*+\n[^0-9A-Za-z\n]*+"
# A blank line, or white space after a closing mark, but not before a number; a colon closes before a capital.
SENTENCE_END = r"\u0001{2,}|(?<=[.;!?])[ \t\r\u0001]++(?![0-9])|(?<=:)[ \t\r\u0001]++(?=[A-Z])"
OTHER = r"[^0-9a-z\u0001\u0002]+"

def cues(sentences):
    """A pattern for words of which each known sentence (in normal form) holds one; texts without any are not cut.

    The words that most sentences share are taken first, the longest of equals.
    """
    left, words = {s: set(s.split(" ")) for s in sentences}, []
    while left:
        votes = Counter(w for ws in left.values() for w in ws)
        best = max(votes, key=lambda w: (votes[w] * (len(w) > 4), len(w), w))
        words.append(best)
        left = {s: ws for s, ws in left.items() if best not in ws}
    return "(?i)" + "|".join(sorted(words))


def marked(text):
    """The normal form of a text, with marks where lines and sentences end and at both ends."""
    lines = F.regexp_replace(F.translate(text, LINE + END, ",,"), LINE_BREAK, LINE)
    sentences = ascii_lower(F.regexp_replace(lines, SENTENCE_END, END))
    tight = F.regexp_replace(F.regexp_replace(sentences, OTHER, " "), " ?([\\u0001\\u0002]) ?", "$1")
    return F.concat(F.lit(END), F.trim(tight), F.lit(END))


def plain_normalised(sentence):
    """The normal form of one sentence."""
    kept = "".join(c.lower() if c.isascii() and c.isalnum() else " " for c in sentence)
    return " ".join(kept.split())


def licences(docs: DataFrame, sentences=SENTENCES, rules=RULES, name="licence") -> DataFrame:
    """docs with a struct column: sentence_ids (comma-joined, in order of the text), licences (distinct, in order of
    the rules, comma-joined), n_licences.

    Everything is an expression over one row: nothing is shuffled. A null or empty text has no sentences. All columns
    and rows stay; a column called `name` is replaced.
    """
    known = {}
    for number, sentence in sentences:
        known.setdefault(plain_normalised(sentence), number)
    known.pop("", None)
    lookup = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    # Between two marks, the longest first; a line may end at any of the spaces.
    longest = sorted(known, key=len, reverse=True)
    pattern = "[\\u0001\\u0002](" + "|".join(s.replace(" ", "[ \\u0001]") for s in longest) + ")(?=[\\u0001\\u0002])"
    hits = F.regexp_extract_all(marked(F.col("text")), F.lit(pattern), F.lit(1))
    cut = F.when(F.col("text").rlike(cues(known)), hits).otherwise(F.array().cast("array<string>"))
    ids = F.transform(cut, lambda s: F.element_at(lookup, F.translate(s, LINE, " ")))
    ordered = F.array(*[
        F.struct(F.lit(licence).alias("licence"), F.lit("|" + "|".join(order) + "|").alias("pattern"))
        for licence, order in rules
    ])

    def apply(state, rule):
        rest = state["rest"]
        taken = F.replace(F.replace(rest, rule["pattern"], F.lit("|-|")), rule["pattern"], F.lit("|-|"))  # neighbours share a bar
        found = F.when(F.contains(rest, rule["pattern"]), F.concat(state["found"], F.array(rule["licence"])))
        return F.struct(taken.alias("rest"), F.coalesce(found, state["found"]).alias("found"))

    nothing, sentence_ids = F.array().cast("array<string>"), F.col(name)
    start = F.struct(F.concat(F.lit("|"), F.array_join(sentence_ids, "|"), F.lit("|")).alias("rest"), nothing.alias("found"))
    named = F.aggregate(ordered, start, apply, lambda state: F.array_distinct(state["found"]))
    # One step after the other in the same column, so that the sentences of a text are worked out once.
    found = docs.withColumn(name, ids).withColumn(
        name, F.struct(sentence_ids.alias("ids"), F.when(F.size(sentence_ids) > 0, named).otherwise(nothing).alias("named"))
    )
    return found.withColumn(
        name,
        F.struct(
            F.array_join(F.col(name)["ids"], ",").alias("sentence_ids"),
            F.array_join(F.col(name)["named"], ",").alias("licences"),
            F.size(F.col(name)["named"]).cast("long").alias("n_licences"),
        ),
    )
