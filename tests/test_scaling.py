"""What keeps large inputs cheap gives the same rows as the plain way."""

from pyspark.sql import functions as F

from smudgelex.functions import tokens as t
from smudgelex.operators import compare, tokenize
from smudgelex.sources import boundaries, corpus

TEXTS = [
    "", None, "  ", "One two, three; 4 five.", "a > b < c <d> e", "x</TEXT>", "no. tag\n\nat all  here",
    "<!-- c > d", "a&lt;b &eacute; <B>bold</B> <p", "1 2 3", "a 7 b c", "$5 a-b- (c) d/e", "<x<y> z",
]


def _frame(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")


def _rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_rows_of_words_are_rows_of_structs(spark):
    docs = _frame(spark)
    for markup, tags in (("none", False), ("trec", False), ("trec", True), ("html", False)):
        for numeric in ("drop", "keep"):
            for final in (False, True):
                got = tokenize.tokenize(docs, "doc_id", "text", markup, numeric, tags, final)
                array = t.token_array("text", markup, numeric, tags, final)
                want = docs.select("doc_id", F.posexplode(array)).select("doc_id", F.col("pos") + 1, "col.*")
                assert _rows(got) == _rows(want)


def test_tokenizing_runs_once(spark):
    """One chain of whole-text passes, and no struct for each token."""
    plan = tokenize.tokenize(_frame(spark), markup="trec")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("named_struct") == 0 and plan.count("coalesce(text") == 2


def test_readings_share_their_passes(spark):
    docs = _frame(spark)
    for left, right in (
        ({"numeric": "keep"}, {"numeric": "drop"}),
        ({"markup": "trec", "tags": True}, {"markup": "html"}),
        ({"final": True}, {}),
    ):
        got = compare.reconcile_readings(docs, left, right)
        sides = [
            docs.select("doc_id", F.posexplode(t.token_array("text", **o))).select(
                "doc_id", (F.col("pos") + 1).alias("position"), "col.*"
            )
            for o in (left, right)
        ]
        assert _rows(got) == _rows(compare.reconcile(*sides))
    plan = compare.reconcile_readings(docs, {"numeric": "keep"}, {})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("coalesce(text") == 1


def test_places_of_equal_blocks_are_not_joined(spark):
    columns = "doc_id bigint, position int, token string, type string"
    same = [(1, p, f"w{p}", "TEXT") for p in range(1, 3000)]
    left = [*same, (2, 1, "a", "TEXT"), (2, 1, "a", "TEXT"), (2, 2, "b", "TEXT"), (3, 1, None, "TEXT"), (None, 1, "n", "TEXT"), (4, None, "m", "TEXT"), (5, 1, "x", "TEXT"), (5, 1, "x", "TEXT")]
    right = [*same, (2, 1, "c", "TEXT"), (2, 2, "b", "TEXT"), (3, 1, None, "TEXT"), (None, 1, "n", "TEXT"), (4, None, "m", "TEXT"), (5, 1, "x", "TEXT"), (9, 1, "q", "TEXT")]
    a, b = spark.createDataFrame(left, columns), spark.createDataFrame(right, columns)
    keys = ["doc_id", "position", "token", "type"]
    found = compare.different_places(a, b)
    assert _rows(found) == _rows(a.join(b, keys, "left_anti"))
    assert len(_rows(found)) == 5
    # Both sides are cut down to the blocks that differ before any row is moved.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 2


def test_sound_documents_are_searched_once(spark):
    rows = spark.createDataFrame([("\n<DOCNO>1</DOCNO><TEXT>a</TEXT></DOC>", "f")], "value string, source string")
    plan = corpus.extract_documents(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<(?:!|") == 1


def test_events_begin_with_the_same_byte():
    # A common first byte lets the search skip text without tags.
    assert boundaries._EVENT.pattern.startswith(b"<(?:")
    found = [(m.lastindex, m.group()) for m in boundaries._EVENT.finditer(b"a<DOC>b</DOC></DOCNO><!x><a<b>")]
    assert [k for k, _ in found] == [1, 2, 3, None, None]
