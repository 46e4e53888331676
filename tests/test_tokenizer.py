"""Known strings, one per rule, in both numeric modes."""

import time

import pytest

# Input, tokens with the numeric filter off, tokens with it on. `@k`
# groups tokens into phrases, [S] and [E] are tags, [Y] is a symbol.
GOLDEN = [
    ("(7 CFR) 8c(15)(A)", "7@1 CFR@1 8c-15-A@2", "CFR@1 8c-15-A@2"),
    (
        "welcome; this is jim's house. Not jims' house ``Act.'' after &hyph; me ",
        "welcome@0 this@1 is@1 jims@1 house@1 Not@2 jims@2 house@2 Act@4 after@5 -[Y] me@6",
        None,
    ),
    (
        "Mayag&uuml;ez A&ntilde;asco Gu&aacute;nica D&iacute;az Rinc&oacute;n",
        "Mayagüez@0 Añasco@0 Guánica@0 Díaz@0 Rincón@0",
        None,
    ),
    (
        "8:43pm 100.242 100,000,1.10",
        "8:43pm@0 100.242@0 100,000,1.10@0",
        "8:43pm@0",
    ),
    (
        "<PARENT> FR940405-1-00001 </PARENT>",
        "PARENT[S] FR940405-1-00001@1 PARENT[E]",
        None,
    ),
    ("<DOCNO>DEADBEEF</DOCNO>", "DOCNO[S] DEADBEEF@1 DOCNO[E]", None),
    (
        "<CFRNO>7 $CFR Part£ <!-- blah elsld --> 28 </CFRNO>",
        "CFRNO[S] 7@1 $CFR@1 Part£@1 28@2 CFRNO[E]",
        "CFRNO[S] $CFR@1 Part£@1 CFRNO[E]",
    ),
    (
        "<RINDOCK>[CN&hyph;94&hyph;003] </RINDOCK>",
        "RINDOCK[S] CN-94-003@2 RINDOCK[E]",
        None,
    ),
    (
        "&blank;/&blank;Vol. 59, No. 2&blank;/&blank;Tuesday, January 4, "
        "1994&blank;/&blank;Rules and Regulations",
        "Vol@1 59@2 No@3 2@4 Tuesday@5 January@6 4@6 1994@7 Rules@8 and@8 Regulations@8",
        "Vol@1 No@3 2@4 Tuesday@5 January@6 1994@7 Rules@8 and@8 Regulations@8",
    ),
]


def parse(spec):
    out = []
    for item in spec.split():
        if item.endswith("]"):
            kind = {"S": "XMLSTART", "E": "XMLEND", "Y": "SYMBOL"}[item[-2]]
            out.append((item[:-3], kind, None))
        else:
            token, phrase = item.rsplit("@", 1)
            out.append((token, "TEXT", int(phrase)))
    return out


def groups(phrases):
    """Phrase numbers by order of first use, which is all a golden fixes."""
    seen = {}
    return [p if p is None else seen.setdefault(p, len(seen)) for p in phrases]


@pytest.mark.parametrize("numeric", ["keep", "drop"])
def test_golden(tokens_of, numeric):
    got = tokens_of([g[0] for g in GOLDEN], "trec", numeric, tags=True)
    for (text, keep, drop), rows in zip(GOLDEN, got):
        want = parse(keep if numeric == "keep" or drop is None else drop)
        assert [(r.token, r.type) for r in rows] == [w[:2] for w in want], text
        numbers = [r.phrase_id if r.type == "TEXT" else None for r in rows]
        assert groups(numbers) == groups([w[2] for w in want]), text
        assert all(r.phrase_id == 0 for r in rows if r.type != "TEXT"), text


# Rule, input, tokens with the filter on, tokens with it off if they differ.
RULES = [
    ("T1 blanks", "a\t\n b\u00a0c ½ d\u200be", "a b c d e", None),
    ("T12 leading punctuation", "«a» „b“ `c", "a b c", None),
    ("T13 letters and digits", "Ünïcode ٣abc x２", "Ünïcode ٣abc x２", None),
    ("T13 soft hyphen", "co\u00adop \u00adx", "co\u00adop x", None),
    ("T14 inner symbol", "e.g. a+b 8:43pm $CFR ", "e.g a+b 8:43pm $CFR", None),
    ("T15 apostrophe", "it''s jim's jims' k", "its jims jims k", None),
    ("T16 opening bracket", "foo.(bar) z", "foo.-bar z", None),
    ("T16 brackets", "a8c(15)(A) x", "a8c-15-A x", None),
    ("T17 closing bracket", "a)b c) d", "ab c d", None),
    ("T18 currency", "Part£ 5£ x$5 y", "Part£ 5£ x$ y", "Part£ 5£ x$5 y"),
    ("T18 repeated", "x$$ y", "x$ y", "x$$ y"),
    ("T19 trailing symbol", "a. b! c", "a b c", None),
    ("T20 slash", "1994/1995 z", "1994 z", "1994 1995 z"),
    ("T20 address", "http://x.y/z w", "http x.y z w", None),
    ("T22 number", "12 3.5 -7 1,000 $9 a 1-2 x", "a x", "12 3.5 7 1,000 $9 a 1-2 x"),
    ("T23 numeric tail", "8c(15) Part.28 version1.5 z", "8c Part version1 z",
     "8c-15 Part.28 version1.5 z"),
    ("T23 currency then number", "£100 $100 a", "£ a", "£100 $100 a"),
    ("T23 end of text", "Part.28", "Part", "Part.28"),
    ("dashes", "foo- --bar a−b −c", "foo- bar a−b −c", None),
    ("D6 bare ampersand", "AT&T Corp &foo bar & x", "AT&T Corp foo bar x", None),
    ("empty", "", "", None),
    ("only breaks", "... !!! ", "", None),
]

MARKUP_RULES = [
    ("T2 tag", "a<P>b</P>c", "a b c", None),
    ("T2 number before tag", "28</P> 29 x", "28 x", "28 29 x"),
    ("T3 broken tag", "x <a href='y'>hi</a> z", "x href=y>hi z", None),
    ("T3 lone", "a < b", "a b", None),
    ("T4 comment", "a <!-- b <c> d --> e", "a d e", None),
    ("T4 declaration", "<!DOCTYPE x> a", "a", None),
    ("T5 entities", "a&lt;b &rsquo;c d&lsquo;s", "a<b ' c d's", None),
    ("T6 dropped", "a&sect;b &para; c", "a b c", None),
    ("T7 unknown", "a&copy;b &nosuch; c", "a b c", None),
    ("T8 inside a word", "1&lt;2 CN&hyph;94 k", "1<2 CN-94 k", None),
    ("T8 decoded hyphen counts as one", "1&hyph;2 k", "k", "1-2 k"),
    ("T9 at the start", "&hyph; me &eacute;tat", "- me é tat", None),
    ("T9 decoded tag", "&lt;TEXT&gt; k", "< TEXT> k", None),
    ("T10 dropped ends a word", "a&amp;b 12&amp;c", "a b 12 c", None),
    ("T21 number at tag", "<DOCNO> 12345 </DOCNO>", "", "12345"),
    ("D3 unclosed", "a <b c <!-- d", "a c d", None),
    ("D8 symbol before a tag", "+<TEXT> x |</p> y", "x y", None),
    ("D9 dropped entity splits", "a.b&amp;c d", "a.b c d", None),
    ("entity stops at a tag", "R&D</b> and; x", "R&D and x", None),
]


@pytest.mark.parametrize("numeric", ["keep", "drop"])
@pytest.mark.parametrize("markup, rules", [("none", RULES), ("trec", MARKUP_RULES)])
def test_rules(tokens_of, markup, rules, numeric):
    got = tokens_of([r[1] for r in rules], markup, numeric)
    for (name, text, drop, keep), rows in zip(rules, got):
        want = keep if numeric == "keep" and keep is not None else drop
        assert [r.token for r in rows] == want.split(), f"{name}: {text!r}"


PHRASES = [
    ("a b, c", [0, 0, 1], "none"),
    ("jims' house", [0, 0], "none"),
    ("Part£ x", [0, 0], "none"),
    ("a (b) c", [0, 1, 2], "none"),
    ('a... b "c"', [0, 3, 4], "none"),
    ("a/b", [0, 1], "none"),
    ("+ x y", [1, 1], "none"),
    ("a 12. b", [0, 1], "none"),
    ("a'-5 b", [0, 0], "none"),
    ("a&amp;b c", [0, 0, 0], "trec"),
    ("a < b", [0, 1], "trec"),
    ("a <!-- x --> b", [0, 1], "trec"),
    ("a &eacute; b", [0, 0, 1], "trec"),
    ("<p class='x'>a</p><p>b", [1, 3], "html"),
]


def test_phrase_numbers(tokens_of):
    for markup in ("none", "trec", "html"):
        cases = [c for c in PHRASES if c[2] == markup]
        for (text, want, _), rows in zip(cases, tokens_of([c[0] for c in cases], markup)):
            assert [r.phrase_id for r in rows] == want, text


def test_html_strips_whole_tags(tokens_of):
    (rows,) = tokens_of(["<a href='x'>hi</a> <!-- no --> you<br/>me 3 < 4 x"], "html")
    assert [r.token for r in rows] == ["hi", "you", "me", "x"]


def test_symbols_have_their_own_type(tokens_of):
    (rows,) = tokens_of(["&eacute;tat &rsquo;x"], "trec")
    assert [(r.token, r.type) for r in rows] == [
        ("é", "SYMBOL"),
        ("tat", "TEXT"),
        ("'", "SYMBOL"),
        ("x", "TEXT"),
    ]


def test_final_sentinel(tokens_of):
    one, none = tokens_of(["a b", ""], final=True)
    assert [(r.token, r.type, r.is_final) for r in one] == [
        ("a", "TEXT", False),
        ("b", "TEXT", False),
        ("", "NULL", True),
    ]
    assert [(r.type, r.is_final) for r in none] == [("NULL", True)]


def test_private_marks_in_the_input_are_blanks(tokens_of):
    text = "a\ue000b \ue010c d\ue001 12\ue001 \ue002e"
    (rows,) = tokens_of([text], "trec")
    assert [(r.token, r.type, r.phrase_id) for r in rows] == [
        (t, "TEXT", 0) for t in "abcde"
    ]


def test_null_text(spark):
    from smudgelex import doc_stats, tokenize

    df = spark.createDataFrame([(1, None)], "doc_id int, text string")
    assert tokenize(df).count() == 0
    assert tokenize(df, with_final=True).collect()[0].position == 1
    assert doc_stats(df).collect()[0].n_tokens == 0


def test_long_runs_do_not_overflow(tokens_of):
    (rows,) = tokens_of(["x" * 300_000 + " " + "1." * 100_000 + " " + "a-" * 100_000])
    assert [len(r.token) for r in rows] == [300_000, 200_000]


def test_unclosed_markup_takes_linear_time(tokens_of):
    texts = [part * 40_000 for part in ("<!", "<x", "< ", "&x", "<a <!")]
    for markup in ("trec", "html"):
        start = time.monotonic()
        got = tokens_of(texts, markup)
        # Minutes if each "<" were followed to the end of the text.
        assert time.monotonic() - start < 40
        assert [len(rows) for rows in got[:3]] == [0, 40_000, 0]


def test_options_are_checked():
    from smudgelex.functions.tokens import token_array

    with pytest.raises(ValueError):
        token_array("x", markup="xml")
    with pytest.raises(ValueError):
        token_array("x", numeric="maybe")
    with pytest.raises(ValueError):
        token_array("x", markup="html", tags=True)
