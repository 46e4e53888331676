import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from smudgelex.llm import language_codes as c

SOUNDS = {
    "aa": "ka lo mi tu ren", "bb": "sch ung ein ter ost", "cc": "ção ñe ra los ía", "dd": "жи ту во ра ни",
    "ee": "qu eau ent is le", "ff": "wy rz cz ski ów", "gg": "ij aa oe ver sch", "hh": "の は 日 本 語",
}


def made(seed, n, langs):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(langs)
        words = ["".join(rng.choices(SOUNDS[lang].split(), k=rng.randint(1, 3))) for _ in range(rng.randint(6, 60))]
        rows.append((" ".join(words) + rng.choice(["", ".", " 12 !!"]), lang))
    return rows


@pytest.mark.parametrize("k", [*range(2, 9), 40])
def test_codewords_are_far_apart(k):
    code = c.codewords(k)
    apart = [int((code[i] != code[j]).sum()) for i in range(k) for j in range(i)]
    assert min(apart) >= (2 ** (k - 2) if k <= c.EXHAUSTIVE else 4)
    assert (code.min(axis=0) < code.max(axis=0)).all()
    if k <= c.EXHAUSTIVE:
        assert len({tuple(b) for b in code.T}) == 2 ** (k - 1) - 1


@pytest.mark.parametrize("langs", [["aa", "bb"], ["aa", "bb", "cc", "dd"], list(SOUNDS)])
def test_held_out(langs):
    rows, held = made(1, 300, langs), made(2, 200, langs)
    model = c.fit(np.stack([c.features(t) for t, _ in rows]), [y for _, y in rows])
    x = np.stack([c.features(t) for t, _ in held])
    chosen, score, doubt = model.decode(x)
    assert np.mean([model.languages[k] == y for k, (_, y) in zip(chosen, held)]) > 0.97
    assert ((score > 0) & (score <= 1)).all() and doubt.mean() < 0.1
    # One classifier that is always wrong does not change the choice.
    if len(langs) > 2:
        model.weights[:, 0] *= -1
        model.bias[0] *= -1
        again, _, more = model.decode(x)
        assert (again == chosen).mean() > 0.97 and more.mean() >= doubt.mean()


def test_losses_by_hand():
    x, langs = np.eye(c.WIDTH, dtype=np.float32)[:6], ["x", "y", "z", "x", "y", "z"]
    model = c.Model.unpacked(c.fit(x, langs).packed())
    assert np.allclose(model.trust.sum(axis=1), 1)
    for row, losses in zip(x, model.losses(x)):
        margin = np.clip(row @ model.weights + model.bias, -3, 3)
        for k in range(3):
            want = sum(t * np.exp(-m * (1 if b else -1)) for t, m, b in zip(model.trust[k], margin, model.code[k]))
            assert abs(losses[k] - want) < 1e-5


def test_features_of_bytes():
    assert np.isclose(np.linalg.norm(c.features("any text")), 1)
    assert np.array_equal(c.features("A  b,C"), c.features("a b\nc"))
    assert not np.array_equal(c.features("É"), c.features("e"))
    text = "ab é"
    data = b" " + text.encode() + b" "
    grams = Counter(data[i : i + n] for n in c.LENGTHS for i in range(len(data) - n + 1))
    assert np.isclose((c.features(text) ** 2).sum() * grams.total(), grams.total())
    assert np.count_nonzero(c.features(text)) <= len(grams)


def test_odd_texts(spark, docs, no_docs, texts):
    model = c.train(docs)
    rows = c.identify(docs, model).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in texts)
    assert set(model.languages) <= {"en", "de", "fr"} and "en" in model.languages
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (400, 401, 402))
    assert by_id[300][1:] == by_id[301][1:] and all(0 <= r.score <= 1 for r in rows)
    # Rows that may not be learned from change nothing.
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    other = docs.withColumn("lang", F.when(held_out, "xx").otherwise(F.col("lang"))).repartition(2)
    assert c.train(other).packed() == model.packed()
    assert c.identify(no_docs, c.train(no_docs)).count() == 0
    assert {r.lang_pred for r in c.identify(docs, c.Model()).collect()} == {"und"}
    one = c.train(docs.where("lang = 'en'"))
    assert {(r.lang_pred, r.score) for r in c.identify(docs, one).collect()} == {("en", 1.0), ("und", 0.0)}
