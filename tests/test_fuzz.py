"""Random strings: the expressions against the SQL that works another way."""

import random

import duckdb
import pyarrow as pa
import pytest

import oracle

CHARACTERS = "aZé12900 .,-'$£€()<>&;/`+\"\n½́−・­!:|— "
PARTS = [
    "&hyph;", "&lt;", "&amp;", "&eacute;", "&rsquo;", "&nosuch;", "<TEXT>", "</P>",
    "<!-- x -->", "<a b='c'>", "word ", " 12 ", "it's", "8c(15)", "x.y", "$5",
]


def strings(n, seed=11):
    rnd = random.Random(seed)

    def one():
        size = rnd.randint(1, 24)
        return "".join(
            rnd.choice(CHARACTERS) if rnd.random() < 0.8 else rnd.choice(PARTS)
            for _ in range(size)
        )

    return [one() for _ in range(n)]


@pytest.mark.parametrize("numeric", ["drop", "keep"])
@pytest.mark.parametrize("markup", ["none", "trec", "html"])
def test_random_strings(tokens_of, markup, numeric):
    texts = strings(4000)
    rows = pa.table({"doc_id": range(len(texts)), "text": texts})
    con = duckdb.connect()
    con.register("documents", rows)
    sql = oracle.tokens("t", "SELECT doc_id, text FROM documents", "doc_id", markup, numeric)
    want = {i: [] for i in range(len(texts))}
    query = f"WITH {sql} SELECT doc_id, token, type, phrase_id FROM t ORDER BY doc_id, position"
    for doc_id, *token in con.execute(query).fetchall():
        want[doc_id].append(tuple(token))
    got = tokens_of(texts, markup, numeric)
    for i, text in enumerate(texts):
        assert [(t.token, t.type, t.phrase_id) for t in got[i]] == want[i], repr(text)
