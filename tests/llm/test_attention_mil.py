import random
from collections import Counter

import numpy as np
from smudgelex.llm import attention_mil as a

from tests.llm.conftest import sentence


def made(seed, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        text = sentence(rng, rng.randint(20, 400))
        bad = rng.random() < 0.4
        if bad:
            at = rng.randrange(len(text))
            text = text[:at] + " " + " ".join(w + "$$$" for w in sentence(rng, 60).split()) + " " + text[at:]
        rows.append((text, int(not bad)))
    return rows


def test_held_out_accuracy_and_attention():
    net = a.fit(made(1, 300), steps=120)
    held = made(2, 200)
    x, text_of = a.encode([t for t, _ in held])
    scores, seen = net.forward(x, text_of, len(held))
    labels = np.array([y for _, y in held])
    assert ((scores >= a.THRESHOLD) == labels).mean() > 0.95
    assert np.allclose(np.bincount(text_of, weights=seen["a"]), 1)


def test_gradient_by_differences():
    sample = made(3, 12)
    net = a.fit(sample, steps=3)
    net.weights = {k: v.astype(float) for k, v in net.weights.items()}
    x, text_of = a.encode([t for t, _ in sample])
    y, weight = np.array([y for _, y in sample], float), np.full(12, 1 / 12)

    def loss():
        p = net.forward(x, text_of, 12)[0]
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    gradient = net.gradient(x, text_of, y, weight)
    for k, w in net.weights.items():
        at = (0,) * w.ndim
        old = w[at]
        w[at] = old + 1e-4
        up = loss()
        w[at] = old - 1e-4
        down = loss()
        w[at] = old
        assert abs((up - down) / 2e-4 - gradient[k][at]) < 1e-4


def test_odd_texts(docs, no_docs, texts):
    net = a.fit(made(4, 60), steps=20)
    rows = a.score_quality(docs, net).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in texts)
    assert all(0 <= r.score <= 1 and r.n_passages == len(r.attention) for r in rows)
    same = {}
    for r in rows:  # a score does not depend on the rows around
        if r.doc_id in (300, 301, 0):
            assert abs(same.setdefault(r.doc_id // 300 * 300, r.score) - r.score) < 1e-6
    assert a.score_quality(no_docs, net).count() == 0
    assert {r.score for r in a.score_quality(docs, None).collect()} == {1.0}
    assert a.fit([("x", 1)]) is None
