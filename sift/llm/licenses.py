"""Licence scan by sentence rules.

Texts are cut into sentences; a normalised sentence (lower case, anything but
letters and digits one space) that is known maps to a sentence identifier, and
the sequence of identifiers of a document is matched against ordered licence
rules. A rule is a sequence of identifiers that must follow each other among
the known sentences (unknown ones between them are passed over). Rules are
tried in order, longer ones first, and consume what they match, so a full
licence text is not reported again through one of its sentences.

Line ends are sentence ends in the first reading and spaces (single line ends,
as in wrapped texts) in the second; the reading with more known sentences
counts, the first on a tie.

A licence tag of several identifiers (``MIT OR Apache-2.0``) is one sentence
for each; a ``+`` behind an identifier is not seen, and exceptions are no
licences.

Everything is DataFrame expressions on the row: nothing is shuffled, and only
texts that hold an anchor word, which every known sentence has, are cut; with
sentences of the caller all texts are.

Defined results: null and empty texts have no sentences; repeated rows and
ids are scanned row by row; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence names as they are referred to, and their identifiers.
NAMES = {
    "the mit license": "MIT", "the mit licence": "MIT", "mit license": "MIT",
    "the apache license version 2 0": "Apache-2.0", "apache license 2 0": "Apache-2.0",
    "the apache license 2 0": "Apache-2.0",
    "the gnu general public license version 2": "GPL-2.0",
    "the gnu general public license version 3": "GPL-3.0",
    "the gnu lesser general public license version 2 1": "LGPL-2.1",
    "the gnu lesser general public license version 3": "LGPL-3.0",
    "the gnu affero general public license version 3": "AGPL-3.0",
    "the bsd 2 clause license": "BSD-2-Clause", "the bsd 3 clause license": "BSD-3-Clause",
    "the mozilla public license version 2 0": "MPL-2.0", "the isc license": "ISC",
    "the eclipse public license version 2 0": "EPL-2.0",
    "cc by 4 0": "CC-BY-4.0", "cc by sa 4 0": "CC-BY-SA-4.0", "cc by nc 4 0": "CC-BY-NC-4.0",
    "cc by nd 4 0": "CC-BY-ND-4.0", "cc by nc sa 4 0": "CC-BY-NC-SA-4.0",
    "cc by nc nd 4 0": "CC-BY-NC-ND-4.0", "cc by 3 0": "CC-BY-3.0", "cc by sa 3 0": "CC-BY-SA-3.0",
}
REFERENCES = ("licensed under", "released under the terms of", "released under",
              "distributed under", "available under", "this work is licensed under",
              "this software is licensed under", "this program is licensed under",
              "this file is licensed under", "this project is licensed under",
              "licensed under the terms of", "distributed under the terms of",
              "available under the terms of", "made available under",
              "this software is released under", "this project is released under")
MARK = "SPDX-License-Identifier"
TAG = "spdx license identifier"
# Identifiers that tags use beside those of NAMES.
TAGGED = ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only",
          "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later",
          "BSL-1.0", "CC0-1.0", "EPL-1.0", "MIT-0", "Python-2.0", "Unlicense", "Zlib", "0BSD")
OPERATORS = r"\s(?:OR|AND|WITH)\s"  # between the identifiers of a tag

def sentences_of(wording: str) -> list[str]:
    """The normalised sentences into which the scan cuts a text read by line."""
    cut = re.sub("([.!?;])[ \\t\\r\\x0B\\f]+", "\\1\n", wording).split("\n")
    return [p for p in (re.sub("[^a-z0-9]+", " ", c.lower()).strip() for c in cut) if p]


# Wordings of licence texts, cut as the scan cuts them; of each
# sentence its identifier, or None if it is too common to count. Where licences
# are written with other marks, so that the cuts differ, each form is listed.
_GPL_TERMS = ("you can redistribute it and/or modify it under the terms of the GNU General Public License "
              "as published by the Free Software Foundation")
_LATER = "either version {} of the License, or (at your option) any later version."
WORDINGS = (
    ("All rights reserved.", ("all-rights-reserved",)),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     'associated documentation files (the "Software"), to deal in the Software without restriction, '
     "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
     "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
     "subject to the following conditions:", ("mit-grant",)),
    ("The above copyright notice and this permission notice shall be included in all copies or substantial "
     "portions of the Software.", ("mit-notice",)),
    ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
     "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
     ("mit-warranty",)),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
     "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
     "copies.", ("isc-grant",)),
    ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
     "compliance with the License.", ("apache-header", "apache-compliance")),
    ("You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0",
     ("apache-obtain", "apache-url")),
    ("You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ("apache-copy",)),
    # Head of the licence text, centred on lines of their own, or on one.
    ("Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/",
     ("apache-name", "apache-version", "apache-site")),
    ("Apache License Version 2.0, January 2004", ("apache-title",)),
    ("Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", ("apache-title",)),
    *((f"This program is free software{a} {_GPL_TERMS}{b} {_LATER.format(n)}", ids)
      for n in (2, 3) for a, b, ids in (
          (":", ",", (f"gpl{n}-later",)), (";", ",", (None, f"gpl{n}-later")),
          (":", ";", ("gpl-terms", f"gpl{n}-version")), (";", ";", (None, "gpl-terms", f"gpl{n}-version")))),
    ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
     "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
     ("gpl-warranty", "gpl-implied")),
    ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY, without even "
     "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.", ("gpl-warranty",)),
    ("Redistributions of source code must retain the above copyright notice, this list of conditions and the "
     "following disclaimer.", ("bsd-source",)),
    ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
     "the following disclaimer in the documentation and/or other materials provided with the distribution.",
     ("bsd-binary",)),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
     "promote products derived from this software without specific prior written permission.",
     ("bsd-endorse",)),
    # Only version 2.0 speaks of a Source Code Form.
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
     ("mpl2-header", None)),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v.2.0.", ("mpl2-header",)),
    ("This is free and unencumbered software released into the public domain.", ("unlicense",)),
)
SENTENCES = {sentence: i for wording, ids in WORDINGS
             for sentence, i in zip(sentences_of(wording), ids, strict=True) if i}
RULES = (
    ("Apache-2.0", ("apache-header", "apache-compliance", "apache-obtain", "apache-url")),
    ("GPL-3.0-or-later", ("gpl-terms", "gpl3-version", "gpl-warranty", "gpl-implied")),
    ("GPL-2.0-or-later", ("gpl-terms", "gpl2-version", "gpl-warranty", "gpl-implied")),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-warranty", "gpl-implied")),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-warranty", "gpl-implied")),
    ("GPL-3.0-or-later", ("gpl-terms", "gpl3-version", "gpl-warranty")),
    ("GPL-2.0-or-later", ("gpl-terms", "gpl2-version", "gpl-warranty")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("BSD-3-Clause", ("bsd-source", "bsd-binary", "bsd-endorse")),
    ("Apache-2.0", ("apache-header", "apache-compliance", "apache-copy")),
    ("Apache-2.0", ("apache-name", "apache-version", "apache-site")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("BSD-2-Clause", ("bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-header", "apache-compliance")),
    ("Apache-2.0", ("apache-name", "apache-version")),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-warranty")),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-warranty")),
    ("GPL-3.0-or-later", ("gpl-terms", "gpl3-version")),
    ("GPL-2.0-or-later", ("gpl-terms", "gpl2-version")),
    ("MIT", ("mit-grant",)), ("ISC", ("isc-grant",)), ("Apache-2.0", ("apache-header",)),
    ("Apache-2.0", ("apache-title",)),
    ("GPL-3.0-or-later", ("gpl3-later",)), ("GPL-2.0-or-later", ("gpl2-later",)),
    ("MPL-2.0", ("mpl2-header",)), ("Unlicense", ("unlicense",)),
    ("All-Rights-Reserved", ("all-rights-reserved",)),
)
ANCHORS = ("licen", "reserved", "permission", "redistribut", "warrant", "unencumbered", "cc", "january 2004")


def known_sentences() -> dict[str, str]:
    """Normalised sentence to identifier: the fixed sentences, and for every
    licence name its references and its tag."""
    known = dict(SENTENCES)
    for name, licence in NAMES.items():
        known |= {f"{start} {name}": f"ref-{licence}" for start in REFERENCES}
    for licence in _referred():
        tag = "".join(c if c.isalnum() else " " for c in licence.lower())
        known[f"{TAG} {tag}"] = f"ref-{licence}"
    return known


def _referred() -> list[str]:
    return list(dict.fromkeys([*NAMES.values(), *TAGGED]))


def licence_rules() -> list[tuple[str, tuple[str, ...]]]:
    """The ordered rules; references stand last, one sentence each."""
    return [*RULES, *((licence, (f"ref-{licence}",)) for licence in _referred())]


def _sentences(text: Column) -> Column:
    marked = F.regexp_replace(text, F.lit("([.!?;])[ \\t\\r\\x0B\\f]+"), F.lit("$1\n"))
    sentences = F.split(marked, F.lit("\n"))

    def tags(sentence: Column) -> Column:
        each = F.split(F.regexp_replace(sentence, F.lit(OPERATORS), F.lit(f"\n{MARK}: ")), F.lit("\n"))
        return F.when(F.contains(sentence, F.lit(MARK)), each).otherwise(F.array(sentence))

    return F.when(F.contains(text, F.lit(MARK)), F.flatten(F.transform(sentences, tags))).otherwise(sentences)


def _identify(text: Column, known: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])

    def identify(sentence: Column) -> Column:
        plain = F.trim(F.regexp_replace(F.lower(sentence), F.lit("[^a-z0-9]+"), F.lit(" ")))
        return F.try_element_at(table, plain)

    return F.filter(F.transform(_sentences(text), identify), lambda i: i.isNotNull())


def scan(docs: DataFrame, *, known: dict[str, str] | None = None,
         rules: list[tuple[str, tuple[str, ...]]] | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``sentence_ids`` (array, in text
    order) and ``licences`` (array, in rule order, distinct)."""
    anchors = () if known else ANCHORS  # these cover the fixed sentences only
    known, rules = known or known_sentences(), rules or licence_rules()
    text = F.col(text_col)
    lowered = F.lower(text)
    anchored = F.lit(not anchors)
    for anchor in anchors:
        anchored = anchored | F.contains(lowered, F.lit(anchor))
    unwrapped = F.regexp_replace(text, F.lit("([^\\n])\\r?\\n(?=[^\\r\\n])"), F.lit("$1 "))
    none = F.array().cast("array<string>")
    both = docs.select(F.col(id_col).alias("doc_id"), F.when(
        anchored, F.array(_identify(text, known), _identify(unwrapped, known))
    ).otherwise(F.array(none, none)).alias("readings"))
    by_line, wrapped = F.col("readings")[0], F.col("readings")[1]
    ids = both.select("doc_id", F.when(F.size(wrapped) > F.size(by_line), wrapped)
                      .otherwise(by_line).alias("sentence_ids"))
    patterns = F.array(*[F.struct(F.lit(licence).alias("licence"),
                                  F.lit("".join(f"<{i}>" for i in seq)).alias("pattern"))
                         for licence, seq in rules])
    start = F.struct(
        F.array_join(F.transform("sentence_ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
        .alias("left"), none.alias("found"))

    def apply(at: Column, rule: Column) -> Column:
        hit = F.contains(at["left"], rule["pattern"])
        return F.struct(
            F.when(hit, F.replace(at["left"], rule["pattern"], F.lit("<>"))).otherwise(at["left"]).alias("left"),
            F.when(hit, F.concat(at["found"], F.array(rule["licence"]))).otherwise(at["found"]).alias("found"))

    found = F.array_distinct(F.aggregate(patterns, start, apply, lambda at: at["found"]))
    return ids.select("doc_id", "sentence_ids",
                      F.when(F.size("sentence_ids") > 0, found).otherwise(none).alias("licences"))
