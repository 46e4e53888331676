import random
from collections import Counter
from itertools import combinations

import numpy as np
from smudgelex.llm import string_kernel as k

from tests.llm.conftest import sentence


def brute(a, b, n=k.ORDER, decay=k.DECAY):
    a, b = f"\x01{a}\x02", f"\x01{b}\x02"

    def spans(w):
        out = Counter()
        for at in combinations(range(len(w)), n):
            out["".join(w[i] for i in at)] += decay ** (at[-1] - at[0] + 1)
        return out

    left, right = spans(a), spans(b)
    return sum(v * right[s] for s, v in left.items())


def test_kernel_by_brute_force():
    words = ["idiot", "idoiot", "i.d.iot", "moron", "notid", "clown", "id"]
    got = k.kernel(words, words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            value = brute(a, b) / np.sqrt(brute(a, a) * brute(b, b)) if brute(a, a) and brute(b, b) else 0
            assert got[i, j] == 0 or abs(got[i, j] - value) < 1e-4
    assert got[0, 1] > 0.2 and got[0, 3] < 0.1
    assert np.allclose(np.diag(got), 1, atol=1e-3)


def made(seed, n):
    rng = random.Random(seed)
    insults = ["zorgot", "quemble", "fraxid"]
    rows = []
    for _ in range(n):
        parts = [sentence(rng, 8) for _ in range(rng.randint(3, 12))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(3):
                parts[rng.randrange(len(parts))] += " " + rng.choice(insults)
        rows.append((". ".join(parts), int(toxic)))
    return rows


def test_held_out_and_tolerant():
    model = k.fit(made(1, 400))
    scorer = k.Scorer(model)
    held = made(2, 200)
    scores = np.array(scorer.score([t for t, _ in held]))
    assert ((scores >= k.THRESHOLD) == [y == 1 for _, y in held]).mean() > 0.97
    plain, spaced, filled = scorer.score(["the zorgot. a quemble. this fraxid", "the z o r g o t. the q u e m b l e. this f r a x i d", "the zor-got. a quem.ble. this fra_xid"])
    clean = scorer.score(["the thing is on. re shan"])[0]
    assert plain >= k.THRESHOLD and spaced >= k.THRESHOLD and filled > clean


def test_odd_texts(docs, no_docs, texts):
    model = k.fit(made(3, 150))
    rows = k.score_toxicity(docs, model).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in texts)
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (300, 301)}) == 1
    assert len({r.score for r in rows if r.doc_id in (400, 401, 402)}) == 1
    assert k.score_toxicity(no_docs, model).count() == 0
    assert k.fit([]).score([5.0]) == 0.0
