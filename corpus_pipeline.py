"""Documents to packed training sequences, in stages that each read what the last kept.

Toxic documents go, then those that fail the quality rules; one document of each class
of near duplicates stays; passages that repeat across documents are cut out; the rest is
tokenized and packed. A stage that drops documents finds out which, by id and digest of
the text, and takes those rows away, so that texts stay where they are. Null ids, null
and empty texts pass every filter that the operators let them pass; empty tables give
empty results; columns beside those of ``documents`` are left behind by the first stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smudgelex.llm import best_fit_packing, quality_mcd, string_kernel, suffix_dedup, weighted_minhash
from smudgelex.llm.common import joined, materialized, ship, table

# Bytes of a passage that may not repeat: fifty words of any language here are longer.
PASSAGE = 300
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _key() -> Column:
    """Tells rows apart that share an id."""
    id = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return F.concat_ws(" ", id, F.coalesce(F.md5("text"), F.lit("null")))


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` less the rows whose key is in ``rejected (_key)``."""
    rejected = materialized(rejected.distinct())
    return joined(docs.withColumn("_key", _key()), rejected, ["_key"], "left_anti").drop("_key")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = string_kernel.train(docs, table(spark, sf_dir, "labels"))
    scored = string_kernel.with_scores(docs, model, name="_toxicity")
    return scored.where(F.col("_toxicity") < string_kernel.THRESHOLD).select(*COLUMNS)


def drop_outliers(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    keyed = docs.select("*", _key().alias("_key"))
    judged = quality_mcd.mark_outliers(keyed, id="_key")
    return _without(docs, judged.where(~F.col("kept")).select("_key"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class, once."""
    ship(spark)
    keyed = docs.select("*", _key().alias("_key"))
    classes = weighted_minhash.near_duplicate_classes(keyed, note="_key")
    classes = materialized(classes.groupBy("class_id", "doc_id", "_key").agg(F.count(F.lit(1)).alias("n")))
    first = classes.groupBy("class_id").agg(F.min(F.struct("doc_id", "_key")).alias("first"))
    kept = materialized(first.select(F.col("first._key").alias("_key")))
    others = classes.select("_key").join(kept, "_key", "left_anti")
    rest = _without(docs, others)
    # A row that is given more than once stays once.
    twice = materialized(classes.where("n > 1").join(kept, "_key").select("_key", F.lit(True).alias("_twice")).distinct())
    rest = joined(rest.withColumn("_key", _key()), twice, ["_key"])
    once = rest.where("_twice is null")
    again = rest.where("_twice").dropDuplicates(["_key"])
    return once.unionByName(again).select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    cut = suffix_dedup.remove_repeats(docs, carry=("lang", "source"), length=PASSAGE)
    text = F.col("rest").alias("text")
    return cut.select("doc_id", text, "lang", "source", F.length("rest").cast("bigint").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return best_fit_packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_outliers),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("packing", pack),
]

# Models, robust estimates and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
