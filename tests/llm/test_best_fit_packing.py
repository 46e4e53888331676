import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from smudgelex.llm import best_fit_packing as b

PATH = P.path("word_bpe_49k.json")


def least_bins(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {room: k for k, room in enumerate(bins)}.values():
            if bins[k] >= items[i]:
                bins[k] -= items[i]
                put(i + 1, bins)
                bins[k] += items[i]
        put(i + 1, [*bins, capacity - items[i]])

    put(0, [])
    return best[0]


def test_fixed_groups_belong_to_a_best_packing():
    rng = random.Random(4)
    for _ in range(1500):
        capacity = rng.randint(5, 40)
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        fixed, rest = b.dominating_groups(Counter(items), capacity)
        held = Counter(w for g, n in fixed for w in g * n) + Counter(rest)
        assert held == Counter(items)
        left = [w for w, n in rest.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + least_bins(left, capacity) == least_bins(items, capacity)
        plan = b.packing_plan(Counter(items), capacity)
        assert Counter(w for g, n in plan for w in g * n) == Counter(items)
        assert all(sum(g) <= capacity for g, _ in plan)


def test_tokens_like_the_library():
    rng, words = random.Random(6), b.Words(PATH)
    parts = ["a", "B", "Σ", "İ", "the", " ", "\n", "é", "́", "日本", "🙂", "1", "23", ".", "'s", "'re", "\x1c", "\x85", "\xa0", "<|endoftext|>", "text|>", "ſ"]
    made = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(600)]
    for text, ids in zip(made, words.encode(made), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [2048, 64])
def test_places(docs, texts, capacity):
    out = b.pack_documents(docs, capacity=capacity).collect()
    words = b.Words(PATH)
    want = Counter()
    for i, text, *_ in texts:
        ids = words.encode([text or ""])[0] + bytes(4)
        for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
            part = ids[at : at + 4 * capacity]
            want[i, piece, at // 4, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    places = defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == [sum(w for _, w in held[:k]) for k in range(len(held))]
        assert sum(w for _, w in held) <= capacity
    assert len(places) <= -(-sum(r.length for r in out) // capacity) * 1.1 + 1


def test_empty(no_docs):
    assert b.pack_documents(no_docs).count() == 0
