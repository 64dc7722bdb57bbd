from sift.llm.licenses import ANCHORS, known_sentences, licence_rules, scan

SCHEMA = "doc_id long, text string, licences string"  # licences: a clashing extra column
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""


def test_every_known_sentence_has_an_anchor_and_a_rule():
    known = known_sentences()
    assert all(any(a in s for a in ANCHORS) for s in known)
    assert all(s == " ".join(s.split()) and s == s.lower() for s in known)
    used = {i for _, seq in licence_rules() for i in seq}
    assert used <= set(known.values())


def test_cases(spark):
    rows = [(1, "Prose here.\nReleased under the MIT License.\nMore.", "x"), (2, MIT, "x"), (3, None, "x"), (4, "", "x"),
            (5, "All rights reserved. Licensed under CC BY-NC 4.0. licensed UNDER  cc-by-nc 4.0!", "x"),
            (6, "We talk about a license and copyright only.", "x"), (None, "SPDX-License-Identifier: Apache-2.0", None),
            (7, "SPDX-License-Identifier: Apache-2.0", "x"),
            (8, "This work is licensed under the GNU General Public License, version 3.", "x"),
            (9, "word " * 100_000 + ".\nReleased under the MIT License.", "x"), (1, "All rights\nreserved", "x")]
    got = [(r.doc_id, r.sentence_ids, r.licences) for r in scan(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()]
    assert [x[0] for x in got] == [r[0] for r in rows]
    assert [x[2] for x in got] == [
        ["MIT"], ["MIT"], [], [], ["All-Rights-Reserved", "CC-BY-NC-4.0"], [], ["Apache-2.0"], ["Apache-2.0"], ["GPL-3.0"], ["MIT"],
        ["All-Rights-Reserved"]]
    assert got[1][1] == ["mit-grant", "mit-notice"]
    assert got[4][1] == ["all-rights-reserved", "ref-CC-BY-NC-4.0", "ref-CC-BY-NC-4.0"]


def test_empty_table(spark):
    assert scan(spark.createDataFrame([], SCHEMA)).collect() == []


# Licence headers and texts in their original wording, line by line.
GPL_WARRANTY = """This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
GPL_2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

""" + GPL_WARRANTY
GPL_3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

""" + GPL_WARRANTY
MPL_2 = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
APACHE_2 = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
"""
BSD_2 = """1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = BSD_2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
MIT_WHOLE = MIT + """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
"""
UNLICENSE = "This is free and unencumbered software released into the public domain.\n"
ORIGINALS = [
    (GPL_2, "GPL-2.0-or-later", ["gpl-terms", "gpl2-version", "gpl-warranty", "gpl-implied"]),
    (GPL_3, "GPL-3.0-or-later", ["gpl3-later", "gpl-warranty", "gpl-implied"]),
    (GPL_2.replace("version 2", "version 3"), "GPL-3.0-or-later",
     ["gpl-terms", "gpl3-version", "gpl-warranty", "gpl-implied"]),
    (GPL_3.replace("version 3", "version 2"), "GPL-2.0-or-later", ["gpl2-later", "gpl-warranty", "gpl-implied"]),
    (GPL_2.split("\n\n")[0], "GPL-2.0-or-later", ["gpl-terms", "gpl2-version"]),
    (MPL_2, "MPL-2.0", ["mpl2-header"]),
    (APACHE_2, "Apache-2.0", ["apache-header", "apache-compliance", "apache-obtain", "apache-url"]),
    (BSD_2, "BSD-2-Clause", ["bsd-source", "bsd-binary"]),
    (BSD_3, "BSD-3-Clause", ["bsd-source", "bsd-binary", "bsd-endorse"]),
    (ISC, "ISC", ["isc-grant"]), (MIT_WHOLE, "MIT", ["mit-grant", "mit-notice", "mit-warranty"]),
    (UNLICENSE, "Unlicense", ["unlicense"]), ("All rights reserved.\n", "All-Rights-Reserved", ["all-rights-reserved"]),
]


def test_original_wordings_plain_on_one_line_and_as_comments(spark):
    rows, expected = [], []
    for text, licence, ids in ORIGINALS:
        rows += [(len(rows), text, "x"), (len(rows) + 1, text.replace("\n", "\r\n"), "x")]
        expected += [([licence], ids)] * 2
        if text.startswith(("This program is free", "This Source")):
            rows.append((len(rows), "".join(f" * {line}\n" if line else "\n" for line in text.split("\n")), "x"))
            rows.append((len(rows), " ".join(text.split()), "x"))
            expected += [([licence], ids)] * 2
    got = {r.doc_id: (r.licences, r.sentence_ids) for r in scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[k] for k in range(len(rows))] == expected


APACHE_HEAD = """
                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION
"""
WRITTEN = [  # by hand: what a reader finds in each text
    ("SPDX-License-Identifier: GPL-2.0-only", {"GPL-2.0-only"}),
    ("// SPDX-License-Identifier: GPL-2.0-or-later\nint x;", {"GPL-2.0-or-later"}),
    ("/* SPDX-License-Identifier: LGPL-2.1-or-later */", {"LGPL-2.1-or-later"}),
    ("# SPDX-License-Identifier: MIT OR Apache-2.0\nimport x\n", {"MIT", "Apache-2.0"}),
    ("SPDX-License-Identifier: (MIT AND BSD-3-Clause) OR ISC", {"MIT", "BSD-3-Clause", "ISC"}),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", {"GPL-2.0-only"}),
    ("SPDX-License-Identifier: CC0-1.0", {"CC0-1.0"}), ("SPDX-License-Identifier: Unknown-1.0 OR MIT", {"MIT"}),
    ("This is prose. Licensed under the terms of the MIT license. More prose.", {"MIT"}),
    ("Distributed under the terms of the Apache License, Version 2.0.", {"Apache-2.0"}),
    (APACHE_HEAD, {"Apache-2.0"}), (" ".join(APACHE_HEAD.split()[:6]) + "\n\nTERMS", {"Apache-2.0"}),
    ("Choose MIT OR Apache-2.0 as you like.", set()), ("SPDX-License-Identifier:", set()),
    ("Version 2.0, January 2004 of our journal", set()),
]


def test_tags_expressions_and_references_as_written(spark):
    rows = [(k, text, "x") for k, (text, _) in enumerate(WRITTEN)]
    rows += [(100 + k, text.replace("\n", "\r\n"), "x") for k, (text, _) in enumerate(WRITTEN)]
    got = {r.doc_id: r.licences for r in scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    for k, (text, want) in enumerate(WRITTEN):
        assert set(got[k]) == want and len(got[k]) == len(want), text
        assert got[100 + k] == got[k], text


def test_the_sql_reads_tags_alike(spark):
    import duckdb
    from sift.llm.oracle import _licence_sql
    texts = [text for text, _ in WRITTEN] + [t for t, _, _ in ORIGINALS]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    sql = {r[0]: (r[2], r[3]) for r in con.execute(_licence_sql()).fetchall()}
    got = scan(spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], SCHEMA)).collect()
    assert {r.doc_id: (",".join(r.sentence_ids), ",".join(r.licences)) for r in got} == sql


def test_the_lesser_licence_is_not_taken_for_the_general_one(spark):
    lesser = GPL_2.replace("GNU General", "GNU Lesser General").replace("version 2", "version 3")
    assert [r.licences for r in scan(spark.createDataFrame([(1, lesser, "x")], SCHEMA)).collect()] == [[]]


def test_sentences_of_the_caller_need_no_anchor(spark):
    df = spark.createDataFrame([(1, "Prose. Do as you please. More.", "x"), (2, "Prose.", "x")], SCHEMA)
    found = scan(df, known={"do as you please": "please"}, rules=[("Free", ("please",))]).collect()
    assert [(r.doc_id, r.sentence_ids, r.licences) for r in found] == [(1, ["please"], ["Free"]), (2, [], [])]
