"""Lookup order, collation, the two join strategies, counts."""

import pytest
from pyspark.sql import functions as F

from smudgelex import (
    build_lexicon,
    corpus_report,
    heavy_words,
    kind_counts,
    known_tokens,
    lexicon_of,
    missing_tokens,
    reference_keys,
    tag_lexicon,
    tag_tokens,
    tag_words,
    tokenize,
)
from smudgelex.operators.tag import of_kind, tokens_processed
from smudgelex.plans import storage
from smudgelex.sources.key_tables import store_keys, stored_keys


def words(spark, column, *values):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


@pytest.fixture
def no_auto_broadcast(spark):
    """Small test keys would be broadcast by Spark itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def tables(spark):
    return (
        words(spark, "name", "Smith", "Paris", "Smith", None),
        words(spark, "word", "house", "paris", "tree "),
        words(spark, "name", "PARIS", "House", "Rome"),
    )


@pytest.fixture
def lexicon(spark):
    rows = [("Paris", 5), ("paris", 2), ("HOUSE", 3), ("rome", 1), ("tree", 1), ("qwx", 4)]
    return spark.createDataFrame([*rows, ("", 9)], "token string, n bigint")


def kinds(df):
    return {r.token: r.kind for r in df.collect()}


def test_first_table_decides(tables, lexicon):
    keys = reference_keys(*tables)
    assert keys.count() == keys.select("key").distinct().count() == 5
    tagged = tag_lexicon(lexicon, keys)
    assert kinds(tagged) == {
        "Paris": "names",
        "paris": "names",
        "HOUSE": "dict",
        "rome": "geo",
        "tree": "dict",
        "qwx": "missing",
    }
    assert tagged.columns == ["token", "n", "kind"]


def test_exact_collation(tables, lexicon):
    keys = reference_keys(*tables, "exact")
    assert kinds(tag_lexicon(lexicon, keys, "exact")) == {
        "Paris": "names",
        "paris": "dict",
        "HOUSE": "missing",
        "rome": "missing",
        "tree": "missing",
        "qwx": "missing",
    }
    with pytest.raises(ValueError):
        reference_keys(*tables, "swedish")


def test_missing_is_the_anti_join(tables, lexicon):
    keys = reference_keys(*tables)
    tagged = tag_lexicon(lexicon, keys)
    missing = missing_tokens(lexicon, keys)
    want = of_kind(tagged, "missing").select("token", "n")
    assert sorted(missing.collect()) == sorted(want.collect()) != []
    known = known_tokens(lexicon, keys)
    assert known.union(missing).exceptAll(tagged.select("token", "n")).count() == 0
    assert known.count() + missing.count() == tagged.count() == 6


def test_lexicon_join_without_broadcast(tables, lexicon, no_auto_broadcast):
    keys = reference_keys(*tables)
    for join in (tag_lexicon, missing_tokens, known_tokens):
        small, large = join(lexicon, keys), join(lexicon, keys, broadcast_bytes=0)
        assert "BroadcastHashJoin" in plan_of(small)
        assert "SortMergeJoin" in plan_of(large)
        assert sorted(small.collect()) == sorted(large.collect())


def test_counts(tables, lexicon):
    tagged = tag_lexicon(lexicon, reference_keys(*tables))
    counts = {r.kind: (r.n_words, r.n_tokens) for r in kind_counts(tagged).collect()}
    assert counts == {
        "names": (2, 7), "dict": (2, 4), "geo": (1, 1), "missing": (1, 4)
    }
    assert tokens_processed(tagged).collect()[0].n_processed == 16
    nothing = kind_counts(tagged.where("false")).collect()
    assert {(r.kind, r.n_words, r.n_tokens) for r in nothing} == {
        (k, 0, 0) for k in ("names", "dict", "geo", "missing")
    }


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_both_strategies_agree_on_a_hot_word(spark, tables, no_auto_broadcast):
    keys = reference_keys(*tables)
    hot = spark.range(30_000).select(
        (F.col("id") % 7).alias("doc_id"),
        F.col("id").cast("int").alias("position"),
        F.when(F.col("id") % 3 > 0, "Paris").otherwise(F.concat(F.lit("w"), "id")).alias("token"),
    )
    small = tag_tokens(hot, keys)
    large = tag_tokens(hot, keys, broadcast_bytes=0)
    assert "BroadcastHashJoin" in plan_of(small)
    # The hot word is looked up apart, the others are joined by shuffle.
    assert "SortMergeJoin [_key" in plan_of(large) and "BroadcastHashJoin [_row" in plan_of(large)
    assert "SortMergeJoin" not in plan_of(small)
    assert small.columns == ["doc_id", "position", "token", "kind"]
    assert small.count() == large.count() == 30_000
    assert small.exceptAll(large).count() == 0
    assert large.where("kind = 'names'").count() == 20_000


def test_repeated_lines_of_a_bare_lexicon(spark, tables, no_auto_broadcast):
    keys = reference_keys(*tables)
    lines = words(spark, "token", *(["Paris"] * 50 + ["zz"] * 3 + [""] * 4))
    got = tag_tokens(lines, keys, broadcast_bytes=0, salts=4).groupBy("token", "kind").count()
    assert {tuple(r) for r in got.collect()} == {("Paris", "names", 50), ("zz", "missing", 3)}


def test_broadcast_needs_a_measured_size(spark, tables):
    keys = reference_keys(*tables)
    size = keys.agg(F.sum(F.octet_length("key") + 124)).first()[0]
    assert storage.fits_broadcast(keys, "key", size)
    assert not storage.fits_broadcast(keys, "key", size - 1)
    assert storage.fits_broadcast(keys.where("false"), "key", 0)


def test_tag_words_job(spark, tables, tmp_path):
    source = tmp_path / "tokens"
    source.write_text("Paris\nqwx\n\nqwx\nhouse\n")
    out = str(tmp_path / "missing")
    tagged = tag_words(spark, str(source), reference_keys(*tables), out)
    assert {(r.token, r.n, r.kind) for r in tagged.collect()} == {
        ("Paris", 1, "names"), ("qwx", 2, "missing"), ("house", 1, "dict")
    }
    assert [r.value for r in spark.read.text(out).collect()] == ["qwx"]


def test_lexicon_paths_agree(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    pages = spark.read.parquet(f"{small}/pages.parquet")
    for df, id, text, markup in (
        (docs, "doc_id", "text", "none"),
        (pages, "page_id", "html", "trec"),
        (pages, "page_id", "html", "html"),
    ):
        slow = build_lexicon(tokenize(df, id, text, markup))
        fast = lexicon_of(df, text, markup)
        assert slow.exceptAll(fast).count() == 0
        assert slow.count() == fast.count() > 1000


def test_report(spark, tables):
    docs = spark.createDataFrame([("Paris, house! Xyzzy house.",)], "text string")
    rows = corpus_report(docs, reference_keys(*tables)).collect()
    assert {r.kind: r.n_tokens for r in rows} == {
        "names": 1, "dict": 2, "geo": 0, "missing": 1
    }


def test_accents_and_width_do_not_count(spark, lexicon):
    names, none = words(spark, "name", "Mayagüez", "Straße", "Ångström "), words(spark, "word")
    keys = reference_keys(names, none, none, "ignore_accents")
    rows = [(w, 1) for w in ("Mayaguez", "MAYAGÜEZ", "mayagu\u0308ez", "ｍａｙａｇｕｅｚ", "strasse", "angstrom", "mayaguey", "ma yaguez")]
    tagged = kinds(tag_lexicon(spark.createDataFrame(rows, "token string, n bigint"), keys, "ignore_accents"))
    assert [tagged[w] for w, _ in rows] == ["names"] * 6 + ["missing"] * 2
    shuffled = spark.createDataFrame([(w,) for w, _ in rows], "token string")
    assert kinds(tag_tokens(shuffled, keys, "ignore_accents", broadcast_bytes=0)) == tagged


def test_heavy_words_are_looked_up_apart(spark, tables, no_auto_broadcast):
    spread = [(f"w{i}",) for i in range(3000)]
    rows = [("Paris",)] * 4000 + [("qwx",)] * 3000 + [("",)] * 500 + [("rome",)] + spread
    tokens = spark.createDataFrame(rows, "token string").coalesce(1)
    tokens = tokens.selectExpr("token", "1 as key", "monotonically_increasing_id() as position").repartition(4)
    found = {r.token for r in heavy_words(tokens, 50).collect()}
    assert {"Paris", "qwx"} <= found and len(found) <= 50
    keys = reference_keys(*tables)
    named = spark.createDataFrame([("Paris",), ("Paris",), ("qwx",)], "token string")
    for heavy in (None, named, named.limit(0)):
        tagged = tag_tokens(tokens, keys, broadcast_bytes=0, heavy=heavy)
        got = {(r.token, r.kind): r["count"] for r in tagged.groupBy("token", "kind").count().collect()}
        assert got[("Paris", "names")] == 4000 and got[("qwx", "missing")] == 3000
        assert got[("rome", "geo")] == 1 and sum(got.values()) == 10_001 and len(got) == 3003
        assert tagged.columns == tokens.columns + ["kind"]
    # No word fills a partition of the join, and no key is repeated.
    tagged = tag_tokens(tokens, keys, broadcast_bytes=0, heavy=named)
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tagged = tag_tokens(tokens, keys, broadcast_bytes=0, heavy=named)
        sizes = [r["count"] for r in tagged.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]


def test_stored_keys_stay_where_they_are(spark, tables, lexicon, no_auto_broadcast, tmp_path):
    keys = store_keys(reference_keys(*tables), "stored_reference_keys", buckets=4)
    try:
        again = stored_keys(spark, "stored_reference_keys")
        for side in (keys, again):
            tagged = tag_lexicon(lexicon, side, broadcast_bytes=0)
            assert kinds(tagged) == kinds(tag_lexicon(lexicon, reference_keys(*tables)))
        # Planned anew, since a plan that ran is spelled twice.
        tagged = tag_lexicon(lexicon, again, broadcast_bytes=0)
        plan = tagged._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.sql("DROP TABLE stored_reference_keys")
