import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
from smudgelex.llm import components
from smudgelex.llm import weighted_minhash as m

from tests.llm.conftest import sentence


def runs_of(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def classes(rows):
    """By brute force: id and text to the smallest id of the class."""
    sets = [runs_of(t) for _, t in rows]
    df = Counter(k for s in sets for k in s)
    weight = {k: 1 + np.log(len(rows) / max(c, 1, len(rows) / m.RARE)) for k, c in df.items()}
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = sum(min(n, sets[j][k]) * weight[k] for k, n in sets[i].items())
                every = sum(max(sets[i][k], sets[j][k]) * weight[k] for k in sets[i] | sets[j])
                if both >= m.SIMILARITY * every:
                    root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (id, _) in enumerate(rows):
        least[find(i)].append(id)
    return Counter((id, min(least[find(i)])) for i, (id, _) in enumerate(rows) if id is not None)


def test_by_brute_force(spark, docs, texts):
    rng = random.Random(9)
    base = sentence(rng, 200).split()
    more = []
    for i in range(40):  # near copies that are not all near each other
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(200)] = "w" + str(rng.random())
        more.append((500 + i, " ".join(copy)))
    rows = [(i, t) for i, t, *_ in texts if i is not None] + more
    df = docs.where("doc_id is not null").select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    out = m.near_duplicate_classes(df).collect()
    assert Counter((r.doc_id, r.class_id) for r in out) == classes(rows)


def test_samples_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(1)
    base = np.float32(3.0)
    runs = np.sort(rng.integers(0, 2**63, 300).astype(np.uint64))
    agree, want = [], []
    for _ in range(12):
        a, b = np.sort(rng.choice(runs, 220, False)), np.sort(rng.choice(runs, 220, False))
        wa = np.where(rng.random(220) < 0.7, base, rng.uniform(0.5, 9, 220)).astype(np.float32)
        wb = np.where(rng.random(220) < 0.7, base, rng.uniform(0.5, 9, 220)).astype(np.float32)
        agree.append((m.signature(a, wa, base) == m.signature(b, wb, base)).mean())
        want.append(m.similarity((a, wa), (b, wb)))
    assert abs(np.mean(agree) - np.mean(want)) < 0.04


def test_odd_rows_and_empty(docs, no_docs, texts):
    out = m.near_duplicate_classes(docs).collect()
    assert len(out) == len(texts)
    alone = [r for r in out if r.doc_id in (400, 401, 402)]
    assert all(r.class_id == r.doc_id and r.n_links == 0 for r in alone)
    assert m.near_duplicate_classes(no_docs).count() == 0


def test_similar_texts_share_a_run_of_their_prefixes():
    rng = np.random.default_rng(5)
    for least in (0.5, 0.8, 0.95):
        near = 0
        for _ in range(400):
            each = dict(enumerate(rng.choice([1.0, 3.0, 3.0, 5.5], 60)))
            runs = np.sort(rng.choice(60, 40, False)).astype(np.uint64)
            other = np.unique(np.r_[runs[rng.random(40) < rng.uniform(least, 1)], rng.choice(60, rng.integers(0, 3))]).astype(np.uint64)
            sides = []
            for r in (runs, other):
                idf = np.array([each[int(x)] for x in r])
                sides.append((r, idf * (1 + (rng.random(len(r)) < 0.02)), idf))
            if m.similarity(sides[0][:2], sides[1][:2]) >= least:
                near += 1
                first = [set(m.prefix_of(r, w, e, least).tolist()) for r, w, e in sides]
                assert first[0] & first[1]
        assert near > 20


def test_differences_tell_what_reaches_the_similarity():
    rng = np.random.default_rng(7)
    for least in (0.5, 0.8, 0.95):
        near = 0
        for _ in range(150):
            runs = np.sort(rng.choice(2**62, 80, False)).astype(np.uint64)
            sets = []
            for _ in range(6):
                keep = np.sort(np.r_[runs[rng.random(80) < rng.uniform(least, 1)], rng.integers(0, 2**62, rng.integers(0, 4)).astype(np.uint64)])
                sets.append((keep, (rng.choice([1.0, 2.0, 5.5], len(keep)) if rng.random() < 0.1 else np.full(len(keep), 2.0)).astype(np.float32)))
            middle = m.middle_of(sets[: rng.integers(1, 7)])
            (a, wa, sa), (b, wb, sb) = (m.difference(*s, middle, 6) for s in sets[:2])
            _, x, y = np.intersect1d(a, b, return_indices=True)
            assert (sa[x] == sb[y]).all()
            both = np.minimum(wa[x], wb[y]).sum()
            totals = [s[1].sum(dtype=float) for s in sets[:2]]
            apart = wa.sum() + wb.sum() - 2 * both
            like = m.similarity(*sets[:2])
            assert abs(like - (sum(totals) - apart) / (sum(totals) + apart)) < 1e-6
            excess = [w.sum() - (1 - least) / (1 + least) * t for w, t in zip((wa, wb), totals, strict=True)]
            if abs(like - least) > 1e-6:
                assert (like > least) == (sum(excess) < 2 * both)
            if like >= least:
                near += 1
                assert all(both >= w.sum() - (1 / least - 1) * t - 1e-6 for w, t in zip((wa, wb), totals, strict=True))
        assert near > 20


def test_pairs_verified_do_not_grow_with_the_square_of_a_family(spark, monkeypatch):
    rng = random.Random(3)
    base = sentence(rng, 400).split()
    rows = []
    for i in range(120):  # few edits reach each other, more edits reach none
        copy = list(base)
        for at in rng.sample(range(400), 1 if i % 6 == 0 else 3):
            copy[at] = "w" + str(rng.random())
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, sentence(rng, 60)) for i in range(20)]
    counts, verified = [], m._verified

    def counting(pairs, *others):
        counts.append(pairs.count())
        return verified(pairs, *others)

    monkeypatch.setattr(m, "_verified", counting)
    out = m.near_duplicate_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter((r.doc_id, r.class_id) for r in out) == classes(rows)
    assert 1 < len({r.class_id for r in out if r.doc_id < 1000}) < 120
    # 6,557 pairs of the third step on before groups had a middle.
    assert sum(counts[2:]) <= len(rows) * m.BANDS and sum(counts[3:]) <= 2 * len(rows)


def test_random_numbers_are_drawn_in_parts():
    m._tables.cache_clear()
    tracemalloc.start()
    tables = m._tables(7.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    m._tables.cache_clear()
    assert peak < 1.4 * sum(t.nbytes for t in tables)


def _counting(monkeypatch, *modules):
    stored, store = [], m.materialized

    def counting(df):
        stored.append(df)
        return store(df)

    for module in modules:
        monkeypatch.setattr(module, "materialized", counting)
    return stored


def test_components_store_one_table_a_round(spark, monkeypatch):
    stored = _counting(monkeypatch, components)
    star = spark.createDataFrame([(0, i) for i in range(1, 20)] + [(30, 31), (31, 32)], "a bigint, b bigint")
    labels = components.connected(star)
    assert {(r.node, r.label) for r in labels.collect()} == {(i, 0) for i in range(20)} | {(i, 30) for i in (30, 31, 32)}
    # 6 tables before.
    assert len(stored) == 1
    more = spark.createDataFrame([(19, 32), (40, 41), (7, 7)], "a bigint, b bigint")
    want = {(i, 0) for i in (*range(20), 30, 31, 32)} | {(40, 40), (41, 40)}
    assert {(r.node, r.label) for r in components.connected(more, labels).collect()} == want
    chain = [(i, i + 1) for i in range(0, 37)]
    random.Random(4).shuffle(chain)
    far = components.connected(spark.createDataFrame(chain, "a bigint, b bigint"))
    assert {(r.node, r.label) for r in far.collect()} == {(i, 0) for i in range(38)}


def test_pairs_are_verified_with_one_table_stored(spark, monkeypatch):
    stored = _counting(monkeypatch, m)
    none = np.zeros(0, np.uint64)
    weights = spark.sparkContext.broadcast(m.Weights(none, none.astype(np.int64), np.uint64(0), 3))
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a bigint, b bigint")
    texts = spark.createDataFrame([(1, "a b c d e f"), (2, "A b c d e f"), (3, "other words")], "id bigint, text string")
    assert {(r.a, r.b) for r in m._verified(pairs, texts, weights, 0.8).collect()} == {(1, 2)}
    # 4 tables before.
    assert len(stored) == 1
