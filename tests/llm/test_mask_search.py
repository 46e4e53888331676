import duckdb
import numpy as np
import pytest
from smudgelex.llm import mask_search as m


@pytest.fixture(scope="module")
def items(spark, texts):
    some = [t for _, t, *_ in texts if t][:12]
    rows = [(i, " ".join(t.split()[3 * i : 3 * i + 20])) for i, t in enumerate(some)]
    rows += [(50, "TAIL é日本🙂 one"), (51, ""), (52, None), (53, "zzz qqq"), (None, "one two"), (50, "two")]
    rows += [(54, texts[44][1]), (55, " ".join(t for _, t, *_ in texts if t)[:30000])]
    return spark.createDataFrame(rows, "item_id bigint, text string").selectExpr("*", "1 as n", "'x' as doc_id", "2 as score")


def by_sql(docs, items):
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    con.register("benchmark", items.toPandas().astype({"item_id": "Int64"}))
    return con.execute(m.op12_sql()).fetchall()


def test_against_sql(docs, items):
    found = m.search_items(docs, items)
    got = [(r.item_id, r.rank, r.doc_id, r.score) for r in found.collect()]
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(got, key=repr) == sorted(by_sql(docs, items), key=repr)
    assert {51, 52, 53}.isdisjoint(i for i, *_ in got)
    # Rows that are given more than once are found more than once.
    assert any(i == 50 for i, *_ in got) and any(i is None for i, *_ in got)


def test_blocks_find_the_same(docs, items, monkeypatch):
    whole = sorted(m.search_items(docs, items).collect(), key=repr)
    monkeypatch.setattr(m, "BLOCK_BYTES", 40_000)
    assert sorted(m.search_items(docs, items).collect(), key=repr) == whole


def test_empty(docs, no_docs, items):
    assert m.search_items(no_docs, items).count() == 0
    assert m.search_items(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("words", [5, 90])
def test_few_are_evaluated_and_none_is_lost(words):
    rng = np.random.default_rng(words)
    size, terms = 4000, list(range(words))
    held = rng.random((words, size)) < rng.uniform(0.02, 0.4, words)[:, None]
    of, docs = np.nonzero(held)
    adds = rng.integers(900, 1000, len(docs))
    weights = rng.integers(0, 9000, words)
    best = m.Best(10)
    evaluated = m.search(m.Postings(of, docs, adds, size), list(range(size)), terms, weights, best)
    scores = np.zeros(size, dtype=np.int64)
    np.add.at(scores, docs, weights[of] * adds)
    want = sorted(range(size), key=lambda d: (-scores[d], d))[:10]
    assert best.ids == want and best.scores.tolist() == scores[want].tolist()
    assert evaluated < size / 2
