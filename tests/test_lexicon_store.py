"""The running lexicon: versions, replays, merges."""

from collections import Counter

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from smudgelex import read_documents, stream_documents, tokenize
from smudgelex.operators.lexicon import build_lexicon
from smudgelex.operators.tag import tokens_processed
from smudgelex.operators.tokenize import entity_counts
from smudgelex.plans.metrics import StreamMetrics, observe_documents, observe_tokens
from smudgelex.sources.corpus import well_formed
from smudgelex.streaming import lexicon_store as s

from tests.test_streaming import write


def counts(spark, **n):
    return spark.createDataFrame(list(n.items()), s.SCHEMA)


def read(store, spark, number=None):
    return {r.token: r.n for r in store.read(spark, number).collect()}


def test_versions_replays_and_merges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(s, "MERGE", 3)
    store = s.LexiconStore(f"file://{tmp_path}/store")
    assert read(store, spark) == {} and store.numbers() == []
    want = Counter()
    for batch in range(10):
        new = {"a": batch + 1, f"w{batch}": 1}
        want.update(new)
        assert store.add(counts(spark, **new), batch)
        assert not store.add(counts(spark, a=1000), batch)
        assert read(store, spark) == want
        sizes = Counter(c for _, c in store.version().parts)
        assert max(sizes.values()) < 3
    # Older versions can be read until they are cleaned away.
    assert read(store, spark, 1) == {"a": 1, "w0": 1}
    store.clean(keep=1)
    assert store.numbers() == [10] and read(store, spark) == want
    parts = [p.name for p in (tmp_path / "store" / "parts").iterdir()]
    assert sorted(parts) == sorted(p for p, _ in store.version().parts)


def test_failed_step_changes_nothing(spark, tmp_path, monkeypatch):
    store = s.LexiconStore(str(tmp_path / "store"))
    store.add(counts(spark, a=1), 0)
    broken = s.LexiconStore(str(tmp_path / "store"))
    monkeypatch.setattr(broken, "_commit", lambda version: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        broken.add(counts(spark, a=5), 1)
    assert read(store, spark) == {"a": 1} and store.version().batch == 0
    assert store.add(counts(spark, a=5), 1) and read(store, spark) == {"a": 6}


def test_stream_into_a_store_with_metrics(spark, tmp_path):
    root, state = tmp_path / "in", str(tmp_path / "state")
    store, metrics = s.LexiconStore(str(tmp_path / "store")), StreamMetrics()
    spark.streams.addListener(metrics)
    try:
        for ids in (range(10), range(10, 25)):
            write(root, f"{ids[0]}.txt", ids)
            docs = stream_documents(spark, str(root), str(tmp_path / "log"))
            docs = well_formed(observe_documents(docs, "documents"))
            tokens = observe_tokens(tokenize(docs, markup="trec"), "tokens")
            s.write_lexicon(tokens, store, state).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(metrics)
    docs = read_documents(spark, str(root))
    want = build_lexicon(tokenize(docs, markup="trec"))
    got = store.read(spark)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert store.version().batch == 1
    total = metrics.totals("tokens")
    assert total["n_processed"] == want.agg(F.sum("n")).first()[0]
    seen = metrics.totals("documents")
    assert (seen["n_documents"], seen["n_malformed"], seen["n_kept"]) == (25, 0, 25)


def test_batch_metrics_equal_the_reports(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    documents, tokens = Observation("documents"), Observation("tokens")
    rows = observe_documents(pages, documents, "html", "html")
    rows = observe_tokens(tokenize(rows, "page_id", "html", markup="html"), tokens)
    lexicon = build_lexicon(rows)
    total = tokens_processed(lexicon).first()[0]
    assert tokens.get["n_processed"] == total
    report = entity_counts(pages, "html", "html").groupBy("treatment").agg(F.sum("n").alias("n")).collect()
    by_kind = {r.treatment: r.n for r in report}
    assert {k: documents.get[f"n_{k}"] for k in ("kept", "dropped", "unknown")} == {
        k: by_kind.get(k, 0) for k in ("kept", "dropped", "unknown")
    }
    assert documents.get["n_documents"] == pages.count()
