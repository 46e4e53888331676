import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from smudgelex.llm import suffix_dedup as s


def brute(blobs, n=s.LENGTH):
    seen = Counter(b[k : k + n] for b in blobs for k in range(len(b) - n + 1))
    out = []
    for b in blobs:
        cut = np.zeros(len(b) + 1, dtype=bool)
        for k in range(len(b) - n + 1):
            if seen[b[k : k + n]] > 1:
                cut[k : k + n] = True
        runs = int((np.diff(np.r_[False, cut].astype(int)) == 1).sum())
        out.append((len(b), int(cut.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~cut[:-1]])))
    return out


def near_copies(rng):
    word = lambda: "".join(rng.choices("abcdeé", k=5))
    shared = " ".join(word() for _ in range(150))
    texts = []
    for _ in range(12):  # a passage between different neighbours, changed here and there
        middle = list(shared)
        for _ in range(rng.randint(0, 2)):
            middle[rng.randrange(len(middle))] = "#"
        texts.append(word() + "".join(middle) + word() + shared[: rng.randint(300, 500)])
    return texts + [shared[10:600] * 2, shared[:399], shared[:400], "ab" * 700]


@pytest.mark.parametrize(("many", "length"), [(400, s.LENGTH), (2, s.LENGTH), (400, 100), (2, 64)])
def test_by_brute_force(spark, docs, texts, many, length, monkeypatch):
    monkeypatch.setattr(s, "MANY", many)
    rows = [(i, t) for i, t, *_ in texts] + [(1000 + i, t) for i, t in enumerate(near_copies(random.Random(many)))]
    df = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id bigint, text string, kept string").repartition(4)
    out = s.remove_repeats(df, length=length).collect()
    found = brute([(t or "").encode() for _, t in rows], length)
    want = Counter((i, *f) for (i, _), f in zip(rows, found, strict=True))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out) == want
    for r in out:
        assert r.rest == bytes(r.kept).decode("utf-8", "ignore") or r.n_removed


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(s, "SEGMENT", 1000)
    blob = bytes(random.Random(1).choices(b"abc", k=5000))
    starts = Counter()
    for home, part, ends in s._segments([b"x", blob, blob[:700]]):
        text, first, last, place, _ = s.anchored_runs(np.frombuffer(part, np.uint8), ends)
        begin = np.r_[0, ends[:-1]]
        for t, a, b, p in zip(text, first, last, place, strict=True):
            assert a <= p <= b + s.LENGTH - s.GRAM
            starts.update((home[t][0], home[t][1] + k - begin[t]) for k in range(a, b + 1))
    assert starts == Counter([(1, k) for k in range(4601)] + [(2, k) for k in range(301)])


def test_suffixes_against_sorting():
    rng = random.Random(8)
    for limit in (40, 64, 100):
        data = bytes(rng.choices(b"ab", k=300)) * 2 + bytes(rng.choices(b"a", k=400))
        starts = np.arange(0, len(data) - limit + 1)
        group = np.array(rng.choices(range(2), k=len(starts)))
        seen = Counter((g, data[k : k + limit]) for g, k in zip(group, starts, strict=True))
        want = [seen[g, data[k : k + limit]] > 1 for g, k in zip(group, starts, strict=True)]
        assert s.repeated_suffixes(np.frombuffer(data, np.uint8), starts, group, limit).tolist() == want


def test_empty(no_docs):
    assert s.remove_repeats(no_docs).count() == 0


def test_a_task_holds_parts_of_a_batch():
    rng = np.random.default_rng(3)
    texts = [bytes(x).decode() for x in rng.integers(97, 123, (3000, 1500)).astype(np.uint8)]
    texts += [texts[0], texts[0] * 300]
    batch = pa.RecordBatch.from_arrays([pa.array([str(i).encode() for i in range(len(texts))]), pa.array(texts)], names=["text", "body"])
    tracemalloc.start()
    runs = [len(out) for out in s._find_runs(iter([batch]), 300)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(runs) > 3 and sum(runs) > 10 * len(texts)
    # For 4.9 MB of text, most of it the batch and its copy as bytes.
    assert peak < 80e6
