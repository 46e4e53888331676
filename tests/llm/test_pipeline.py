"""The pipeline on a small folder, and the registered names."""

import corpus_pipeline as c
import pytest
from smudgelex.llm import registry


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    docs.write.parquet(path + "/documents.parquet")
    labels = [(i, 1, 0) for i in range(40)] + [(100, 0, 1), (None, 1, 0), (101, None, None)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(path + "/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(folder + "/documents.parquet")
    kept = [docs]
    for _, stage in c.STAGES[:-1]:
        kept.append(c.materialized(stage(spark, kept[-1], folder)))
        assert kept[-1].columns == list(c.COLUMNS)
    clean, good, single, cut = kept[1:]
    assert not good.where("doc_id in (400, 401, 402, 406)").count()
    ids = sorted(r.doc_id for r in single.select("doc_id").where("doc_id is not null").collect())
    assert len(ids) == len(set(ids)) and 200 in ids and not {201, 300, 301} & set(ids)
    assert single.where("doc_id is null").count() == good.where("doc_id is null").count()
    assert cut.count() == single.count()
    assert cut.where("n_chars != length(text)").count() == 0
    packed = c.STAGES[-1][1](spark, cut, folder)
    assert packed.select("doc_id").distinct().count() == cut.select("doc_id").distinct().count()


def test_empty(spark, no_docs, folder):
    docs = no_docs
    for _, stage in c.STAGES:
        docs = c.materialized(stage(spark, docs, folder))
        assert docs.count() == 0


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
    assert len(c.STAGES) == 5 and set(registry.ORACLE_SQL) <= set(registry.QUERIES)
