"""Properties on the test tables, comparison, rendering, plans."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from smudgelex import (
    doc_lengths,
    doc_stats,
    documents_per_source,
    entity_counts,
    phrases,
    reconcile,
    tag_events,
    tokenize,
)
from smudgelex.functions import render
from smudgelex.operators.compare import same_token, same_token_and_position
from smudgelex.operators.tokenize import last_tokens, of_type, with_last_flag
from smudgelex.plans.scan import spread


def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def test_properties(spark, small):
    tokens = tokenize(documents(spark, small)).persist()
    by_doc = tokens.groupBy("doc_id").agg(
        F.count("*").alias("n"),
        F.min("position").alias("lo"),
        F.max("position").alias("hi"),
        F.count_distinct("position").alias("d"),
    )
    assert by_doc.where("lo <> 1 or hi <> n or d <> n").count() == 0
    order = Window.partitionBy("doc_id").orderBy("position")
    falls = tokens.withColumn("before", F.lag("phrase_id").over(order))
    assert falls.where("phrase_id < before").count() == 0
    assert tokens.where(r"token rlike '\\s' or token = ''").count() == 0
    plain = tokens.where(r"token rlike '^[-$.,0-9]+$'").join(
        documents(spark, small).where("text not like '%/%'"), "doc_id"
    )
    assert plain.count() == 0
    assert of_type(tokens, "TEXT").count() == tokens.count()
    tokens.unpersist()


def test_stats_phrases_and_tokens_agree(spark, small):
    docs = documents(spark, small)
    tokens = tokenize(docs)
    stats = doc_stats(docs)
    grouped = tokens.groupBy("doc_id").agg(
        F.count("*").alias("n_tokens"), F.count_distinct("phrase_id").alias("n_phrases")
    )
    assert grouped.exceptAll(stats).count() == 0
    assert stats.count() == docs.count()
    lengths = doc_lengths(tokenize(docs, with_final=True), docs)
    assert lengths.exceptAll(stats.select("doc_id", "n_tokens")).count() == 0
    runs = phrases(docs).groupBy("doc_id").agg(F.count("*").alias("n_phrases"))
    want = stats.where("n_phrases > 0").select("doc_id", "n_phrases")
    assert want.exceptAll(runs).count() == runs.exceptAll(want).count() == 0


def test_phrases_leave_symbols_out(spark):
    df = spark.createDataFrame([(1, "a b, c &hyph; d")], "doc_id int, text string")
    rows = phrases(df, markup="trec").orderBy("phrase_id").collect()
    assert [(r.n_tokens, r.phrase) for r in rows] == [(2, "a b"), (1, "c"), (1, "d")]


def test_last_flag(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "d")], "doc_id int, text string")
    rows = with_last_flag(tokenize(df)).where("is_last").drop("is_last").collect()
    assert {(r.doc_id, r.token) for r in rows} == {(1, "c"), (2, "d")}
    empty = spark.createDataFrame([(3, "...")], "doc_id int, text string")
    assert set(last_tokens(df.union(empty)).collect()) == set(rows)


def test_two_column_id(spark):
    df = spark.createDataFrame([(1, 2, "a b")], "c int, t int, text string")
    rows = tokenize(df, ["c", "t"]).collect()
    assert [(r.c, r.t, r.position, r.token) for r in rows] == [(1, 2, 1, "a"), (1, 2, 2, "b")]


def test_tag_events(spark):
    text = "<A>x</A> <b c> <!-- <D> --> <e/> < f>"
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    rows = tag_events(df).orderBy("seq").collect()
    assert [(r.seq, r.tag, r.type) for r in rows] == [
        (1, "A", "XMLSTART"), (2, "A", "XMLEND"), (3, "e/", "XMLSTART")
    ]


def test_entity_counts(spark):
    text = "&amp; &amp;&eacute; &copy; <a b='&lt;'> & x; &y"
    df = spark.createDataFrame([(text,)], "text string")
    rows = entity_counts(df, markup="html").collect()
    assert {(r.entity, r.treatment, r.n) for r in rows} == {
        ("amp", "dropped", 2), ("eacute", "kept", 1), ("copy", "unknown", 1)
    }


def test_documents_per_source(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "source string")
    assert {tuple(r) for r in documents_per_source(df).collect()} == {("a", 2), ("b", 1)}


def test_equality(spark):
    rows = [
        (("TEXT", "a", 1), ("TEXT", "a", 2), True, False),
        (("TEXT", "a", 1), ("TEXT", "b", 1), False, False),
        (("TEXT", "a", 1), ("SYMBOL", "a", 1), False, False),
        (("NULL", "", 1), ("TEXT", "b", 1), True, True),
        (("TEXT", "b", 1), ("NULL", "", 1), False, False),
        (("TEXT", "a", 3), ("TEXT", "a", 3), True, True),
    ]
    token = "struct<type: string, token: string, position: int>"
    df = spark.createDataFrame(rows, f"a {token}, b {token}, eql boolean, eq boolean")
    a, b = F.col("a"), F.col("b")
    wrong = df.where(
        (same_token(a, b) != F.col("eql")) | (same_token_and_position(a, b) != F.col("eq"))
    )
    assert wrong.count() == 0


def test_reconcile(spark):
    def table(*rows):
        return spark.createDataFrame(
            rows, "doc_id int, position int, token string, type string"
        )

    left = table((1, 1, "a", "TEXT"), (1, 2, "b", "TEXT"), (1, 3, "", "NULL"))
    right = table(
        (1, 1, "a", "TEXT"), (1, 2, "x", "TEXT"), (1, 3, "c", "TEXT"), (2, 1, "d", "TEXT")
    )
    rows = reconcile(left, right).collect()
    assert {(r.doc_id, r.position, r.left_token, r.right_token) for r in rows} == {
        (1, 2, "b", "x"), (2, 1, None, "d")
    }
    assert reconcile(left, left).count() == 0


def test_rendering(spark):
    df = spark.createDataFrame(
        [("me", "TEXT", 3, 6, 4294967295, "A-1", 9)],
        "token string, type string, position int, phrase_id int, doc_id bigint, "
        "orig_id string, n_tokens bigint",
    )
    row = df.select(
        render.token_string().alias("t"),
        render.document_string().alias("d"),
        render.document_json("doc_id", "orig_id").alias("j"),
    ).first()
    assert row.t == "me [TEXT@3:6]"
    assert row.d == "{Doc: 4294967295, Tokens: 9}"
    assert row.j == '{"doc_id":4294967295,"orig_id":"A-1"}'


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_are_read_and_tokens_do_not_move(spark, small):
    docs = documents(spark, small)
    for df in (tokenize(docs), phrases(docs), doc_stats(docs)):
        plan = plan_of(df)
        assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
        # The only exchange allowed spreads the small raw input.
        assert plan.count("Exchange") == plan.count("RoundRobinPartitioning")


def test_large_inputs_are_not_spread(spark, small):
    docs = documents(spark, small)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        assert "Exchange" not in plan_of(spread(docs))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_partitions_are_never_made_fewer(spark):
    from smudgelex.plans.scan import spread

    def parts(df):
        return spread(df).rdd.getNumPartitions()

    rows = spark.range(1_000_000).selectExpr("id", "repeat('x', 40) as text")
    assert parts(rows.repartition(50)) == 50
    assert parts(spark.range(0, 1_000_000, 1, 30).selectExpr("id", "repeat('x', 40) as text")) == 30
    assert parts(spark.range(0, 1_000_000, 1, 1).selectExpr("id", "repeat('x', 40) as text")) > 1


def test_two_readings_in_a_row_as_by_join(spark, small):
    from smudgelex.operators import compare, tokenize

    docs = spark.read.parquet(f"{small}/documents.parquet")
    joined = compare.reconcile(tokenize.tokenize(docs, numeric="keep"), tokenize.tokenize(docs))
    inside = compare.reconcile_readings(docs, {"numeric": "keep"}, {"numeric": "drop"})
    assert joined.exceptAll(inside).count() == inside.exceptAll(joined).count() == 0 < inside.count()
    plan = inside._jdf.queryExecution().toString()
    assert "hashpartitioning" not in plan and "Join" not in plan


def test_key_size_is_what_a_broadcast_takes(spark):
    from smudgelex.plans import storage

    keys = spark.range(200_000).selectExpr("concat('key', id) as key", "'dict' as kind")
    size = 200_000 * 124 + keys.selectExpr("sum(octet_length(key)) as s").first().s
    assert storage.fits_broadcast(keys, "key", int(size * 1.01))
    assert not storage.fits_broadcast(keys, "key", int(size * 0.99))
