import numpy as np
import pandas as pd
import pytest
from smudgelex.llm import hnsw as h

SCHEMA = "vec_id bigint, embedding array<float>, score double, id string, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0.0, "x", 1) for i, v in rows], SCHEMA)


def exact(rows, query, k):
    vectors = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows}
    scored = sorted((-float(vectors[query] @ v), i) for i, v in vectors.items() if i != query)
    return [(i, -s) for s, i in scored[:k]]


@pytest.mark.parametrize("scale", [False, True])
def test_recall_over_shards(spark, scale):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 24))
    if scale:
        x *= rng.uniform(0.2, 3, (1500, 1))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = frame(spark, rows)
    index = h.build_index(df, shard_rows=400)
    assert index.count() >= 3
    out = h.search_index(index, df.where("vec_id % 20 == 0"), 20).collect()
    hits = 0
    for q in range(0, 1500, 20):
        mine = sorted((r for r in out if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        want = exact(rows, q, 20)
        hits += len({r.vec_id for r in mine} & {i for i, _ in want})
        v = {i: np.array(c, dtype=np.float32).astype(float) for i, c in rows}
        assert all(abs(r.score - v[q] @ v[r.vec_id]) < 1e-9 for r in mine)
    assert hits / (75 * 20) >= 0.9


def of_kind(kind, n):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 64))
    if kind == "norms":
        x *= rng.uniform(0.2, 3, (n, 1))
    if kind == "clusters":
        x = rng.normal(size=(200, 64))[rng.integers(0, 200, n)] + 0.1 * x
    return x


@pytest.mark.parametrize("kind", ["normal", "norms", "clusters"])
def test_recall_of_a_full_shard(kind):
    n = h.SHARD_ROWS
    x = of_kind(kind, n)
    shard = h._build((64, 0), pd.DataFrame({"id": np.arange(n), "vector": list(x)})).iloc[0]
    graph = h.Graph(shard.rename({"dim": "of_dim"}))
    queries = np.arange(0, n, 80)
    found = pd.concat(graph.search(queries, x[queries], 20, h.EF_SEARCH)).groupby("query_id")["vec_id"].agg(set)
    products = x[queries] @ x.T
    products[np.arange(len(queries)), queries] = -np.inf
    want = np.argsort(-products, axis=1)[:, :20]
    hits = sum(len(found[q] & set(w.tolist())) for q, w in zip(queries.tolist(), want, strict=True))
    assert hits / want.size >= 0.95


def test_odd_vectors_copies_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(900, None), (901, []), (902, [0.0, 0.0]), (903, [1.0, None]), (904, [nan, 1.0]), (905, [inf, 1.0]), (None, [1.0, 1.0])]
    copies = [(i, [1.0, 2.0]) for i in range(200)]
    rest = [(300 + i, [float(i % 7), 1.0]) for i in range(50)]
    df = frame(spark, odd + copies + rest + rest[:3])
    out = h.search_index(h.build_index(df), df.where("vec_id in (0, 300, 903)"), 20).collect()
    assert {r.query_id for r in out} == {0, 300}
    for q in (0, 300):
        mine = sorted((r for r in out if r.query_id == q), key=lambda r: r["rank"])
        assert [(r.vec_id, round(r.score, 9)) for r in mine] == [(i, round(s, 9)) for i, s in exact(copies + rest, q, 20)]


def test_few_and_none(spark):
    df = frame(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [1.0, 0.0, 0.0])])
    out = h.search_index(h.build_index(df), df, 20).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in out) == [(0, 1, 1), (1, 1, 0)]
    none = frame(spark, [])
    assert h.search_index(h.build_index(none), none, 5).count() == 0
