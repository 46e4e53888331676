"""Alignment of two readings: exact, small, and in its place."""

import random

import pytest
from smudgelex import align_readings, difference_counts
from smudgelex.functions.tokens import token_array
from smudgelex.operators import align


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above, row = row, [0]
        for j, y in enumerate(b):
            row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
    return row[-1]


@pytest.mark.parametrize("kept", [1, 8, 1 << 20])
def test_longest_by_brute_force(monkeypatch, kept):
    monkeypatch.setattr(align, "_KEPT", kept)
    rng = random.Random(kept)
    for _ in range(1500):
        a, b = (rng.choices("abcde", k=rng.randint(0, 14)) for _ in "ab")
        found = align.common(a, b)
        assert all(a[i] == b[j] for i, j in found) and len(found) == longest(a, b)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:]))
        apart = list(align.differences(a, b))
        assert sorted(i for i, _ in apart if i is not None) == sorted({*range(len(a))} - {i for i, _ in found})
        assert sorted(j for _, j in apart if j is not None) == sorted({*range(len(b))} - {j for _, j in found})


def test_one_token_more_is_one_row(spark):
    texts = [("a b 7 c d e", [(3, "7", None, None)]), ("same all over", []), (None, []), ("", []), ("1 2", [(1, "1", None, None), (2, "2", None, None)])]
    df = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(texts)], "doc_id int, text string, left_token string")
    rows = align_readings(df, {"numeric": "keep"}, {"numeric": "drop"}).collect()
    got = {i: [] for i in range(len(texts))}
    for r in rows:
        got[r.doc_id].append((r.left_position, r.left_token, r.right_position, r.right_token))
    assert [got[i] for i in range(len(texts))] == [want for _, want in texts]
    assert align_readings(df.limit(0), {}, {}).count() == 0


def test_query_by_brute_force(spark, small):
    """As few differences as possible, over all pages of the smallest table."""
    import __spark_entry__ as entry

    pages = spark.read.parquet(f"{small}/pages.parquet")
    read = pages.select("page_id", token_array("html", "trec").alias("a"), token_array("html", "html").alias("b"))
    want = {}
    for r in read.collect():
        a, b = ([(t.token, t.type) for t in side] for side in (r.a, r.b))
        same = longest(a, b)
        if len(a) + len(b) > 2 * same:
            want[r.page_id] = (len(a) - same, len(b) - same)
    counts = difference_counts(entry.align_tokens(spark, small), "page_id").collect()
    assert {r.page_id: (r.n_left, r.n_right) for r in counts} == want and want
