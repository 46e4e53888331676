import pytest
from smudgelex.llm.common import joined


@pytest.mark.parametrize("limit", [0, 1 << 20])
@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_joined_spreads_heavy_keys(spark, limit, how):
    keys = ["hot"] * 3000 + [None] * 500 + [f"k{i}" for i in range(4000)]
    left = spark.createDataFrame([(k, i % 2, i) for i, k in enumerate(keys)], "key string, part int, n int")
    known = [("hot", 0, 1.0), (None, 1, 2.0), *((f"k{i}", i % 2, 3.0) for i in range(0, 4000, 3))]
    right = spark.createDataFrame(known, "key string, part int, value double")
    if how == "left_anti":
        right = right.drop("value")
    out = joined(left, right, ["key", "part"], how, limit=limit)
    values = {(k, p): v for k, p, v in known}
    want = [(k, i % 2, i, values.get((k, i % 2))) for i, k in enumerate(keys)]
    if how == "left_anti":
        want = [w[:3] for w in want if w[3] is None]
    elif how == "inner":
        want = [w for w in want if w[3] is not None]
    assert sorted((tuple(r) for r in out.collect()), key=lambda r: r[2]) == want


def test_joined_to_nothing(spark):
    none = spark.createDataFrame([], "key string, n int")
    right = spark.createDataFrame([("a", 1.0)], "key string, value double")
    assert joined(none, right, ["key"], limit=0).count() == 0
    assert joined(right, none, ["key"], limit=0).count() == 1
