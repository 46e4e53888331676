"""Find licences by their sentences.

A text is cut into sentences, each is normalised and looked up among known licence
sentences, and the sequence of their identifiers is matched against ordered licence
rules. A rule is a run of identifiers; once matched, a run is used up, so that longer
rules go before the shorter ones they contain. A sentence that is not known ends a run,
unless the rule names it ``?``.

A known sentence may be wrapped: lines are joined up to a mark at a line end or a line
without letters and digits. Where the joined lines are not known, each line is looked up
by itself. Numbers of list items do not end a run. ``n_sentences`` counts line ends as
ends of sentences, wrapped or not. The SQL knows neither wrapped lines nor item numbers.

All of it happens inside the row with native expressions: no shuffle, no Python, and
the work is linear in the text. The tables of sentences and rules are parameters.

Null and empty texts have no sentences and no licences. Repeated rows give repeated
results. Other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smudgelex.llm.common import let, table

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A sentence ends at a line end, or at its mark before a blank.
_END = r"([.!?;:])[ \t\r\f\x0B]+"
_OTHER = r"[^a-z0-9.\-]+"
_EDGES = r"^[ .\-]+|[ .\-]+$"
# With every mark at a line end: the ends that a wrapped sentence cannot go over.
_PART = r"(?<=[.!?;:])\n|\n[^A-Za-z0-9\n]*\n"
# What joining leaves out: an item's number in brackets, and how a line begins.
_JOINT = r"^[^A-Za-z0-9]*[0-9]{1,2}\)|\n[^A-Za-z0-9]*"
_ITEM = r"^[^A-Za-z0-9]*[0-9]{1,2}[^A-Za-z0-9]*$"
UNKNOWN = "<?>"


def _normal(sentence: str) -> str:
    """``normalised`` of a string."""
    lower = sentence.translate(str.maketrans(_UPPER, _UPPER.lower()))
    return re.sub(_EDGES, "", re.sub(_OTHER, " ", lower))


# Licence sentences in normal form and the identifiers of this module.
SENTENCES = {
    "licensed under the apache license version 2.0": "apache2-ref",
    "licensed under the apache license version 2.0 the license": "apache2-grant",
    "you may not use this file except in compliance with the license": "apache2-use",
    "you may obtain a copy of the license at": "apache2-copy",
    "released under the mit license": "mit-ref",
    "this project is licensed under the mit license": "mit-ref",
    "licensed under the mit license": "mit-ref",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all "
    "copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind": "asis-software",
    "this work is licensed under the gnu general public license version 3": "gpl3-ref",
    "this work is licensed under the gnu general public license version 2": "gpl2-ref",
    "this program is free software": "gpl-free",
    "you can redistribute it and or modify it under the terms of the gnu general "
    "public license": "gpl-terms",
    "either version 2 of the license or at your option any later version": "gpl2-later",
    "either version 3 of the license or at your option any later version": "gpl3-later",
    "licensed under cc by-nc 4.0": "cc-by-nc-4-ref",
    "licensed under cc by 4.0": "cc-by-4-ref",
    "licensed under cc by-sa 4.0": "cc-by-sa-4-ref",
    "licensed under cc0 1.0": "cc0-ref",
    "this work is dedicated to the public domain": "public-domain",
    "all rights reserved": "all-rights",
    "redistributions of source code must retain the above copyright notice": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice": "bsd-binary",
    "this software is provided by the copyright holders and contributors as is": "bsd-asis",
}

# The sentences of the licences' own texts and headers.
_MIT = {
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions",
    ),
    "mit-notice": (
        "The above copyright notice and this permission notice (including the next paragraph) shall be included in "
        "all copies or substantial portions of the Software",
    ),
    "asis-software": (
        "The software is provided as is, without warranty of any kind, express or implied, including but not limited "
        "to the warranties of merchantability, fitness for a particular purpose and noninfringement",
    ),
    "mit-liable": (
        "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, "
        "whether in an action of contract, tort or otherwise, arising from, out of or in connection with the "
        "software or the use or other dealings in the software",
    ),
}
_ENDORSE = (
    "may be used to endorse or promote products derived from this software without specific prior written permission"
)
_BSD = {
    "bsd-intro": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer",
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution",
    ),
    "bsd-endorse": tuple(
        f"Neither the name of {whose} nor the names of its contributors {_ENDORSE}"
        for whose in ("the copyright holder", "the copyright holders", "the copyright owner", "the University")
    ),
    # What follows a name that ends in a full stop.
    "bsd-nor": (f"nor the names of its contributors {_ENDORSE}", f"nor the names of their contributors {_ENDORSE}"),
    "bsd-asis": tuple(
        f"This software is provided by the {who} as is and any express or implied warranties, including, but not "
        "limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
        for who in (
            "copyright holders and contributors", "copyright holder and contributors", "regents and contributors",
            "author and contributors", "authors and contributors", "author", "authors",
        )
    ),
    "bsd-liable": tuple(
        f"In no event shall the {who} be liable for any direct, indirect, incidental, special, exemplary, or "
        "consequential damages (including, but not limited to, procurement of substitute goods or services"
        for who in (
            "copyright holder or contributors", "copyright holders or contributors", "copyright owner or contributors",
            "regents or contributors", "author or contributors", "authors or contributors", "author", "authors",
        )
    ),
    "bsd-loss": ("loss of use, data, or profits",),
    "bsd-however": (
        "or business interruption) however caused and on any theory of liability, whether in contract, strict "
        "liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, "
        "even if advised of the possibility of such damage",
    ),
}
_APACHE_AT = tuple(
    f"You may obtain a copy of the License at {scheme}://www.apache.org/licenses/LICENSE-2.0{end}"
    for scheme in ("http", "https")
    for end in ("", ".html", ".txt")
)
_APACHE_UNLESS = (
    "Unless required by applicable law or agreed to in writing, software distributed under the License is "
    "distributed on an as is basis, without warranties or conditions of any kind, either express or implied"
)
_APACHE = {
    # Its lines may be joined without regard to blank ones.
    "apache2-copy": (*_APACHE_AT, *(f"{at} {_APACHE_UNLESS}" for at in _APACHE_AT)),
    "apache2-unless": (_APACHE_UNLESS,),
    "apache2-see": (
        "See the License for the specific language governing permissions and limitations under the License",
    ),
}
_MPL = {
    # Cut after its "v."; earlier versions do not speak of a Source Code Form.
    "mpl2-terms": ("This Source Code Form is subject to the terms of the Mozilla Public License, v",),
    "mpl2-copy": tuple(
        f"If a copy of the MPL was not distributed with this file, You can obtain one at {at}mozilla.org/MPL/2.0/"
        for at in ("http://", "https://", "http://www.", "https://www.")
    ),
}
# Name and the versions of the licences of the Free Software Foundation.
_GNU = (
    ("gpl", "GPL", "General", ("2", "3")),
    ("lgpl", "LGPL", "Lesser General", ("2.1", "3")),
    ("lgpl2", "LGPL", "Library General", ("2",)),
    ("agpl", "AGPL", "Affero General", ("3",)),
)


def _gnu() -> tuple[dict[str, tuple[str, ...]], list[tuple[str, tuple[str, ...]]]]:
    """Sentences and rules; a version is in the sentence of the terms or follows it."""
    sentences, rules = {}, []
    fsf = "as published by the Free Software Foundation"
    for short, family, name, versions in _GNU:
        licence = f"GNU {name} Public License"
        begin = f"you can redistribute it and/or modify it under the terms of the {licence}"
        agreed = begin.replace("the terms", "the terms and conditions")
        sentences[f"{short}-terms"] = (begin, f"{begin} {fsf}")
        sentences[f"{short}-details"] = (f"See the {licence} for more details",)
        for v in versions:
            spdx = f"{family}-{v if '.' in v else v + '.0'}"
            later = f"version {v} of the License, or (at your option) any later version"
            # Where a version is a sentence of its own, it does not name the licence.
            sentences[f"gpl{v}-later"] = (f"either {later}", later)
            sentences[f"gpl{v}-only"] = (f"version {v} of the License",)
            sentences[f"{short}-terms-{v}-later"] = (
                f"{begin} {fsf}, either {later}", f"{begin}, either {later}",
            )
            sentences[f"{short}-terms-{v}-only"] = (
                f"{begin} version {v}", f"{begin} version {v} {fsf}", f"{begin} {fsf}, version {v}",
                f"{begin} {fsf}, version {v} of the License", f"{agreed}, version {v}, {fsf}",
            )
            for kind, name_of in (("later", f"{spdx}-or-later"), ("only", f"{spdx}-only")):
                rules.append((name_of, (f"{short}-terms-{v}-{kind}",)))
                rules.append((name_of, (f"{short}-terms", f"gpl{v}-{kind}")))
    return sentences, rules


_GNU_TEXTS, _GNU_RULES = _gnu()
for _texts in (_MIT, _BSD, _APACHE, _MPL, _GNU_TEXTS):
    SENTENCES |= {_normal(text): name for name, listed in _texts.items() for text in listed}

# The clause on endorsement names the owner, so any one sentence may stand for it.
_BSD_RUNS = [
    (licence, ("bsd-intro", "bsd-source", "bsd-binary", *endorse, "bsd-asis"))
    for licence, endorse in (
        ("BSD-3-Clause", ("bsd-endorse",)), ("BSD-3-Clause", ("?", "bsd-nor")), ("BSD-3-Clause", ("?",)),
        ("BSD-2-Clause", ()),
    )
]
_WHOLE = [*_BSD_RUNS, ("MIT", ("mit-grant", "mit-notice", "asis-software"))]

# Licence and the identifiers that must follow each other, in the order of trial.
RULES = (
    # A copyright line above an open licence reserves nothing.
    *((licence, ("all-rights", *run)) for licence, run in _WHOLE),
    *_BSD_RUNS,
    ("Apache-2.0", ("apache2-grant", "apache2-use", "apache2-copy")),
    ("MIT", ("mit-grant", "mit-notice", "asis-software")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-terms", "gpl2-later")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-terms", "gpl3-later")),
    *_GNU_RULES,
    ("MPL-2.0", ("mpl2-terms",)),
    *((licence, run[1:]) for licence, run in _BSD_RUNS),
    ("Apache-2.0", ("apache2-grant",)),
    ("Apache-2.0", ("apache2-ref",)),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-ref",)),
    ("GPL-3.0-only", ("gpl3-ref",)),
    ("GPL-2.0-only", ("gpl2-ref",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-ref",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-ref",)),
    ("CC-BY-4.0", ("cc-by-4-ref",)),
    ("CC0-1.0", ("cc0-ref",)),
    ("Public-Domain", ("public-domain",)),
    ("Proprietary", ("all-rights",)),
)


def sentences(text: Column) -> Column:
    return F.split(_marks_at_ends(text), "\n")


def _marks_at_ends(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _END, "$1\n")


def normalised(sentence: Column) -> Column:
    lower = F.translate(sentence, _UPPER, _UPPER.lower())
    return F.regexp_replace(F.regexp_replace(lower, _OTHER, " "), _EDGES, "")


def _identifiers(known: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in known.items() for x in pair]
    return F.create_map(*pairs)


def _marked(ids) -> str:
    return "".join(f"<{x}>" for x in ids)


def matched(sequence: Column, rules) -> Column:
    """``struct(rest, found)``: rules applied in order, each using up what it matches."""
    listed = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit(_marked(ids)).alias("run")) for name, ids in rules]
    )
    nothing = F.array().cast("array<string>")

    def step(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["run"])
        rest = F.replace(state["rest"], rule["run"], F.lit(UNKNOWN))
        found = F.when(hit, F.array_append(state["found"], rule["name"])).otherwise(state["found"])
        return F.struct(rest.alias("rest"), found.alias("found"))

    start = F.struct(sequence.alias("rest"), nothing.alias("found"))
    return F.aggregate(listed, start, step)


def scan_licenses(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    known: dict[str, str] = SENTENCES,
    rules=RULES,
) -> DataFrame:
    """``(id, n_sentences, sequence, licenses)``.

    ``sequence`` holds the identifiers in the order of the text, as an array;
    ``licenses`` the distinct licences in the order in which the rules found them.
    """
    filled = lambda parts: F.filter(parts, lambda s: F.rlike(s, F.lit("[A-Za-z0-9]")))
    # Only a sentence as long as some known one needs its normal form: normalising
    # never makes a text longer and never drops a letter or digit.
    shortest = min((len(k) for k in known), default=0)

    def identified(s: Column) -> Column:
        ids = F.element_at(_identifiers(known), normalised(s)) if known else F.lit(None).cast("string")
        return F.when(F.length(s) >= shortest, ids)

    def by_line(part: Column) -> Column:
        # The number of an item is no sentence: it has no identifier and ends no run.
        item = lambda s: (F.length(s) < 9) & F.rlike(s, F.lit(_ITEM))
        ids = F.transform(filled(F.split(part, "\n")), lambda s: F.when(item(s), "").otherwise(identified(s)))
        # Lines of which none is known are one unknown sentence.
        unknown = F.array(F.lit(None).cast("string"))
        return let(ids, lambda x: F.when(F.exists(x, lambda i: i.isNotNull()), x).otherwise(unknown))

    def of_part(part: Column) -> Column:
        whole = identified(F.regexp_replace(part, _JOINT, " "))
        return let(whole, lambda x: F.when(x.isNotNull(), F.array(x)).otherwise(by_line(part)))

    marked = df.select(F.col(id).alias(id), _marks_at_ends(F.col(text)).alias("_marked"))
    rows = marked.select(
        id,
        F.size(filled(F.split("_marked", "\n"))).cast("bigint").alias("n_sentences"),
        F.flatten(F.transform(filled(F.split("_marked", _PART)), of_part)).alias("_ids"),
    )
    named = F.filter("_ids", lambda x: x != "")
    marks = F.transform(
        "_ids", lambda x: F.when(x == "", "").otherwise(F.coalesce(F.concat(F.lit("<"), x, F.lit(">")), F.lit(UNKNOWN)))
    )
    any_known = F.size(named) > 0
    none = F.array().cast("array<string>")
    licenses = F.when(any_known, matched(F.array_join(marks, ""), rules)["found"]).otherwise(none)
    return rows.select(
        id,
        "n_sentences",
        named.alias("sequence"),
        F.array_distinct(licenses).alias("licenses"),
    )


def op3_license_rules(spark, sf):
    found = scan_licenses(table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        "n_sentences",
        F.array_join("sequence", " ").alias("sequence"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def op3_sql() -> str:
    """The same in DuckDB SQL, with a left fold over the rules spelled out."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    cases = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in SENTENCES.items())
    steps, last = [], "marked"
    for i, (name, ids) in enumerate(RULES):
        run = quote(_marked(ids))
        steps.append(
            f"r{i} AS (SELECT doc_id, n_sentences, sequence, replace(rest, {run}, '{UNKNOWN}') AS rest,"
            f" CASE WHEN contains(rest, {run}) AND NOT list_contains(found, {quote(name)})"
            f" THEN list_append(found, {quote(name)}) ELSE found END AS found FROM {last})"
        )
        last = f"r{i}"
    edges = r"'^[ .\-]+|[ .\-]+$'"
    return f"""
WITH cut AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(coalesce(text, ''),
    '([.!?;:])[ \\t\\r\\f\\v]+', '\\1' || chr(10), 'g'), chr(10)),
    lambda s: regexp_matches(s, '[A-Za-z0-9]')) AS parts
  FROM documents),
named AS (
  SELECT doc_id, list_transform(parts, lambda s: CASE regexp_replace(regexp_replace(
    translate(s, '{_UPPER}', '{_UPPER.lower()}'), '[^a-z0-9.\\-]+', ' ', 'g'), {edges}, '', 'g')
    {cases} END) AS ids
  FROM cut),
marked AS (
  SELECT doc_id, len(ids) AS n_sentences,
    coalesce(array_to_string(list_filter(ids, lambda x: x IS NOT NULL), ' '), '') AS sequence,
    coalesce(array_to_string(list_transform(ids, lambda x: coalesce('<' || x || '>', '{UNKNOWN}')), ''), '') AS rest,
    CAST([] AS VARCHAR[]) AS found
  FROM named),
{", ".join(steps)}
SELECT doc_id, n_sentences, sequence, coalesce(array_to_string(found, ','), '') AS licenses FROM {last}
"""
