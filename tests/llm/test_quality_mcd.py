import random
import re
from collections import Counter

import numpy as np
from smudgelex.llm import quality_mcd as q


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = Counter(zip(words, words[1:], words[2:], strict=False))
    twice = {k + j for k in range(len(words) - 2) if runs[tuple(words[k : k + 3])] > 1 for j in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, again, len(twice)


def test_counts_by_brute_force(spark, docs, texts):
    odd = ["a b c a b c a b c", "x\nx\n\n \nx", "#a *b\t$c%\x0bd|<>&", "a a a a a", "a b a b a b"]
    more = spark.createDataFrame([(900 + i, t, "en", "s") for i, t in enumerate(odd)], "doc_id bigint, text string, lang string, source string")
    rows = q.mark_outliers(docs.select(*more.columns).union(more)).collect()
    want = Counter((i, *counts(t)) for i, t, *_ in texts) + Counter((900 + i, *counts(t)) for i, t in enumerate(odd))
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == want
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_outliers_go_and_clean_text_stays(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 9)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(60, 400))), "en", "s0") for i in range(300)]
    rows += [(1000 + i, " ".join(word() + "###" for _ in range(100)), "en", "s0") for i in range(30)]
    rows += [(2000 + i, " ".join(word().upper() for _ in range(100)), "en", "s0") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in q.mark_outliers(df).collect()}
    assert all(kept[i] for i in range(300))
    assert not any(v for i, v in kept.items() if i >= 1000)
    # Neither partitions nor their order change a distance.
    distances = lambda d: sorted((r.doc_id, r.distance) for r in q.mark_outliers(d).collect())
    assert distances(df.repartition(7)) == distances(df.coalesce(1))


def test_concentration_step_by_brute_force(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(0, 1, (500, q.P)) * q.SCALE).astype(int)
    x[:50] += 20 * q.SCALE
    rows = spark.createDataFrame([("g", *map(int, r)) for r in x], "group string, " + ", ".join(f"{n} bigint" for n in q.X))
    start = q._inverted(q._median_start(rows)).cache()
    p = start.first()
    inverse = np.zeros((q.P, q.P))
    for i, j in q.PAIRS:
        inverse[i, j] = inverse[j, i] = p[f"c{i}{j}"]
    off = x / q.SCALE - [p[m] for m in q.M]
    d = np.einsum("ni,ij,nj->n", off, inverse, off)
    bucket = np.floor(q.PER_OCTAVE * np.log2(d + 2.0**-20))
    cut = np.sort(bucket)[int(np.ceil(len(x) * q.COVER)) - 1]
    half = x[bucket <= cut] / q.SCALE
    assert not (bucket[:50] <= cut).any()
    got = q._concentrated(rows, start).first()
    assert np.allclose([got[m] for m in q.M], half.mean(axis=0))
    want = np.cov(half.T, bias=True)
    assert np.allclose([got[f"c{i}{j}"] for i, j in q.PAIRS], [want[i, j] for i, j in q.PAIRS])


def test_two_fifths_of_alike_junk_go(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 9)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(60, 400))), "en", "s0") for i in range(180)]
    rows += [(1000 + i, " ".join(word() + "###" for _ in range(100)), "en", "s0") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in q.mark_outliers(df).collect()}
    assert all(kept[i] for i in range(180))
    assert not any(v for i, v in kept.items() if i >= 1000)


def test_repetition_alone_goes(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, text(rng.randint(60, 400)), "en", "s0") for i in range(200)]
    # Nine lines of ten repeat, but hardly a word does; and near half of the words do.
    rows += [(1000 + i, text(200) + f"\n{word()}" * 20, "en", "s0") for i in range(5)]
    rows += [(2000 + i, text(110) + " " + " ".join([text(15)] * 6), "en", "s0") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    out = {r.doc_id: r for r in q.mark_outliers(df).collect()}
    assert not any(r.base_failed for r in out.values())
    assert all(out[i].kept for i in range(200))
    assert not any(r.kept for i, r in out.items() if i >= 1000)


def test_estimate_decides_by_covariance(spark):
    """Points between the extremes of every coordinate go if they leave the cloud's axis;
    against the diagonal of the scatter alone they would stay."""
    rng = np.random.default_rng(5)
    axis = rng.normal(0, 1, 400)
    x = rng.normal(0, 0.3, (400, q.P))
    x[:, 0], x[:, 4] = axis + rng.normal(0, 0.05, 400), axis + rng.normal(0, 0.05, 400)
    x[:30, 0], x[:30, 4] = 1.2, -1.2
    x = np.round(x * q.SCALE).astype(int)
    rows = spark.createDataFrame([("g", *map(int, r)) for r in x], "group string, " + ", ".join(f"{n} bigint" for n in q.X))
    p = q.robust_estimates(rows).first()
    inverse = np.zeros((q.P, q.P))
    for i, j in q.PAIRS:
        inverse[i, j] = inverse[j, i] = p[f"c{i}{j}"]
    off = x / q.SCALE - [p[m] for m in q.M]
    d = np.einsum("ni,ij,nj->n", off, inverse, off)
    alone = (off**2 / np.diag(np.linalg.inv(inverse))).sum(axis=1)
    assert (d[:30] > q.CUTOFF).all() and (d[30:] < q.CUTOFF).all()
    assert (alone < q.CUTOFF).all()
    assert 3.5 < np.median(d[30:]) < 5
    clean = x[30:] / q.SCALE
    assert np.allclose(np.linalg.inv(inverse), np.cov(clean.T), rtol=0.35, atol=0.1)


def test_every_group_has_its_own_estimate(spark):
    """What is common in one source is an outlier in another."""
    rng = random.Random(6)
    word = lambda low, high: "".join(rng.choices("abcdefgh", k=rng.randint(low, high)))
    text = lambda low, high: " ".join(word(low, high) for _ in range(rng.randint(200, 400)))
    rows = [(i, text(2, 6), "en", "short") for i in range(150)] + [(1000 + i, text(8, 12), "en", "long") for i in range(150)]
    rows += [(2000, text(8, 12), "en", "short"), (2001, text(2, 6), "en", "long")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in q.mark_outliers(df).collect()}
    assert not kept[2000] and not kept[2001]
    assert sum(not v for i, v in kept.items() if i < 2000) == 0


def test_empty(no_docs):
    assert q.mark_outliers(no_docs).count() == 0
