import duckdb
from smudgelex.llm import license_rules as r

TEXTS = [
    "Intro. Licensed under the Apache License, Version 2.0.\nMore",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License; either version 2 of the License, or (at your option) any later version.",
    "This program is free software.\nReleased under the MIT License.\nEither version 3 of the license",
    "released  under the MIT licence", "Released under the MIT License. Released under the MIT License!",
    "", None, "x" * 200_000, "...", "LICENSED UNDER CC BY-NC 4.0.\n\nAll rights reserved.",
]
WANT = [["Apache-2.0"], ["GPL-2.0-or-later"], ["MIT"], [], ["MIT"], [], [], [], [], ["CC-BY-NC-4.0", "Proprietary"]]


def test_rules_and_sql(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, licenses string")
    out = r.scan_licenses(df)
    got = sorted((x.doc_id, x.n_sentences, " ".join(x.sequence), ",".join(x.licenses)) for x in out.collect())
    assert [g[3] for g in got] == [",".join(w) for w in WANT for _ in range(2)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [row[:2] for row in rows])
    assert sorted(con.execute(r.op3_sql()).fetchall()) == got


def test_longer_rules_use_up_their_sentences(spark):
    known = {"a": "a", "b": "b"}
    rules = (("AB", ("a", "b")), ("A", ("a",)), ("BA", ("b", "a")))
    df = spark.createDataFrame([(1, "a. b. a. b"), (2, "b. a. x. a"), (3, "a. x. b")], "doc_id int, text string")
    got = {x.doc_id: x.licenses for x in r.scan_licenses(df, known=known, rules=rules).collect()}
    assert got == {1: ["AB"], 2: ["A"], 3: ["A"]}


def test_empty(no_docs):
    assert r.scan_licenses(no_docs).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

BSD2 = """Copyright (c) 2020, Jane Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

THIRD = """
3. Neither the name of %s nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""

APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

GNU = """This %s is free software%s you can redistribute it and/or modify
it under the terms of the GNU %s Public License as published by
the Free Software Foundation%s either version %s of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU %s Public License for more details."""

MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


def gnu(what, name, version, marks):
    return GNU % (what, marks[0], name, marks[1], version, name)


REAL = [
    (MIT, ["MIT"]),
    (BSD2 % "", ["BSD-2-Clause"]),
    *((BSD2 % (THIRD % who), ["BSD-3-Clause"]) for who in ("the copyright holder", "Jane Doe", "Google Inc.")),
    (APACHE, ["Apache-2.0"]),
    (gnu("program", "General", "2", ";;"), ["GPL-2.0-or-later"]),
    (gnu("program", "General", "3", ":,"), ["GPL-3.0-or-later"]),
    (gnu("library", "Lesser General", "2.1", ";;"), ["LGPL-2.1-or-later"]),
    (gnu("library", "Lesser General", "3", ":,"), ["LGPL-3.0-or-later"]),
    (gnu("program", "Affero General", "3", ":,"), ["AGPL-3.0-or-later"]),
    (MPL, ["MPL-2.0"]),
]


def test_real_licences_wrapped_and_unwrapped(spark):
    texts, want = [], []
    for text, names in REAL:
        paragraphs = [" ".join(p.split()) for p in text.split("\n\n")]
        forms = [
            text,
            "\n\n".join(paragraphs),
            " ".join(paragraphs),
            "\n".join(" * " + line for line in text.split("\n")),
            "\r\n".join(text.split("\n")),
            "Some words\n\n" + text + "\n\nand more",
        ]
        texts += forms
        want += [names] * len(forms)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {x.doc_id: x.licenses for x in r.scan_licenses(df).collect()}
    assert [(texts[i], got[i]) for i in got if got[i] != want[i]] == []


def test_a_line_that_is_known_by_itself_stays_known(spark):
    texts = ["Released under the MIT License\nby its authors", "1. Released under\n   the MIT License", "a\nb. c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {x.doc_id: (x.n_sentences, x.licenses) for x in r.scan_licenses(df).collect()}
    assert got == {0: (2, ["MIT"]), 1: (3, ["MIT"]), 2: (3, [])}
