"""Quality by attention-based multiple-instance learning.

A text is a bag of passages of 64 words. Every passage of the whole text is encoded by
statistics of its bytes and words; a gated attention, learned with the rest from
document labels alone, weighs the passages, and the weighted sum is scored. So a few bad
passages can decide over a long document, and nobody has to say which.

The network is fitted with plain gradient steps on a bounded, documented sample of
labelled rows. Scoring encodes Arrow batches of whole texts with array operations; no
shuffle. Null and empty texts are one empty passage. Repeated rows give repeated
results; the score reads nothing but the text. Without labels of both kinds every score
is 1, so that nothing is lost for want of labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smudgelex.llm.common import fitted, table
from smudgelex.llm.word_arrays import window_hashes, word_hashes, words_of

# Labelled rows of each kind that a fit may see.
PER_CLASS = 1500
PASSAGE = 64
HASHED = 48
HIDDEN = 24
GATE = 12
THRESHOLD = 0.3
ROWS = 1024

_GROUPS = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" \t\r\x0b\x0c",
    b"\n",
    b".,;:",
    b"!",
    b"?",
    b"|",
    b"#*",
    b"$%&",
    b"<>=/\\{}[]()_+~^",
    b"'\"-`",
    b"@",
)
_CLASS = np.full(256, len(_GROUPS), dtype=np.int64)  # other controls
_CLASS[128:] = len(_GROUPS) + 1
for _k, _group in enumerate(_GROUPS):
    _CLASS[list(_group)] = _k
CLASSES = len(_GROUPS) + 2
WIDTH = CLASSES + HASHED + 4


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the text of each; every text has a passage."""
    words = words_of([t.lstrip(" \t\n\r\x0b\x0c") for t in texts])
    per_text = words.counts(len(texts))
    passages = np.maximum(1, -(-per_text // PASSAGE))
    first = np.cumsum(passages) - passages
    text_of = np.repeat(np.arange(len(texts)), passages)
    x = np.zeros((int(passages.sum()), WIDTH), dtype=np.float32)
    if not len(words.starts):
        return x, text_of
    ordinal = np.arange(len(words.doc)) - (np.cumsum(per_text) - per_text)[words.doc]
    passage = first[words.doc] + ordinal // PASSAGE
    n_words = np.bincount(passage, minlength=len(x)).astype(np.float32)
    body = words.data[words.starts[0] :]
    of = passage[words.word_of[words.starts[0] :]]
    # What parts two texts counts for neither.
    of[words.doc_ends[words.doc_ends >= words.starts[0]] - words.starts[0]] = len(x)
    rows = len(x) + 1
    kinds = np.bincount(of * CLASSES + _CLASS[body], minlength=rows * CLASSES).reshape(-1, CLASSES)[:-1]
    pair = body[:-1].astype(np.uint32) * np.uint32(2654435761) + body[1:] * np.uint32(2246822519)
    at = of[:-1] * HASHED + (pair >> np.uint32(8)) % HASHED
    pairs = np.bincount(at, minlength=rows * HASHED).reshape(-1, HASHED)[:-1]
    size = np.maximum(kinds.sum(axis=1, keepdims=True), 1)
    x[:, :CLASSES] = np.log1p(100.0 * kinds / size)
    x[:, CLASSES : CLASSES + HASHED] = np.log1p(100.0 * pairs / size)
    # Runs of three words that the text holds more than once.
    hashes = word_hashes(words)
    runs, run_doc = window_hashes(hashes, words.doc, 3)
    inside = np.flatnonzero(words.doc[: len(hashes) - 2] == words.doc[2:]) if len(hashes) > 2 else np.zeros(0, int)
    key = runs ^ (run_doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, back, seen = np.unique(key, return_inverse=True, return_counts=True)
    again = np.bincount(passage[inside], weights=(seen[back] > 1), minlength=len(x))
    # Distinct words of a passage.
    word_key = hashes ^ (passage.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    _, where = np.unique(word_key, return_index=True)
    distinct = np.bincount(passage[where], minlength=len(x))
    some = np.maximum(n_words, 1)
    x[:, -4] = np.log1p(100.0 * again / some)
    x[:, -3] = distinct / some
    x[:, -2] = np.log(size[:, 0] / some)
    x[:, -1] = n_words / PASSAGE
    return x, text_of


@dataclass
class Net:
    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, text_of: np.ndarray, texts: int) -> tuple[np.ndarray, dict]:
        w = self.weights
        x = np.clip((x - self.mean) / self.spread, -6, 6)
        h = np.tanh(x @ w["in"] + w["in_b"])
        v, u = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
        e = (v * u) @ w["a"]
        first = np.flatnonzero(np.r_[True, text_of[1:] != text_of[:-1]])
        e = np.exp(e - np.maximum.reduceat(e, first)[text_of])
        a = e / np.add.reduceat(e, first)[text_of]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        logit = z @ w["out"] + w["out_b"][0]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30))), {"x": x, "h": h, "v": v, "u": u, "a": a, "z": z}

    def gradient(self, x: np.ndarray, text_of: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        p, s = self.forward(x, text_of, len(y))
        d = (p - y) * weight
        out = {"out": s["z"].T @ d, "out_b": np.array([d.sum()])}
        dz = d[:, None] * w["out"]
        dh = s["a"][:, None] * dz[text_of]
        along = (s["h"] * dz[text_of]).sum(axis=1)
        first = np.flatnonzero(np.r_[True, text_of[1:] != text_of[:-1]])
        de = s["a"] * (along - np.add.reduceat(s["a"] * along, first)[text_of])
        out["a"] = (s["v"] * s["u"]).T @ de
        dg = de[:, None] * w["a"]
        dv, du = dg * s["u"] * (1 - s["v"] ** 2), dg * s["v"] * s["u"] * (1 - s["u"])
        out["v"], out["u"] = s["h"].T @ dv, s["h"].T @ du
        dh = dh + dv @ w["v"].T + du @ w["u"].T
        di = dh * (1 - s["h"] ** 2)
        out["in"], out["in_b"] = s["x"].T @ di, di.sum(axis=0)
        return out


def fit(sample: list[tuple[str, int]], steps: int = 160, seed: int = 7) -> Net | None:
    y = np.array([label for _, label in sample], dtype=np.float32)
    if len(set(y.tolist())) < 2:
        return None
    x, text_of = encode([text for text, _ in sample])
    mean, spread = x.mean(axis=0), x.std(axis=0) + 0.05
    random = np.random.default_rng(seed)
    shape = {"in": (WIDTH, HIDDEN), "in_b": (HIDDEN,), "v": (HIDDEN, GATE), "u": (HIDDEN, GATE), "a": (GATE,), "out": (HIDDEN,), "out_b": (1,)}
    weights = {
        k: (np.zeros(s) if k.endswith("_b") else random.normal(0, 1 / np.sqrt(s[0]), s)).astype(np.float32)
        for k, s in shape.items()
    }
    net = Net(mean, spread, weights)
    weight = np.full(len(y), 1 / len(y), dtype=np.float32)
    m = {k: np.zeros_like(v) for k, v in weights.items()}
    s = {k: np.zeros_like(v) for k, v in weights.items()}
    for t in range(1, steps + 1):
        for k, g in net.gradient(x, text_of, y, weight).items():
            g = g + (0 if k.endswith("_b") else 1e-4) * weights[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.999 * s[k] + 0.001 * g * g
            weights[k] -= 0.02 * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
    return net


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Net | None:
    """Fit on labelled rows whose crc32(doc_id) mod 5 is not 0."""
    learned = lambda id: F.crc32(id.cast("string")) % 5 != 0
    return fitted(docs, labels, "quality", learned, fit, per_class)


def score_quality(df: DataFrame, net: Net | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, score, n_passages, attention)``: the attention of the passages is an array
    that sums to 1."""
    rows = df.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                texts = part.column(1).to_pylist()
                x, text_of = encode(texts)
                if net is None:
                    scores, weights = np.ones(len(texts)), 1.0 / np.bincount(text_of)[text_of]
                else:
                    scores, seen = net.forward(x, text_of, len(texts))
                    weights = seen["a"]
                ends = np.searchsorted(text_of, np.arange(len(texts) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, pa.array(weights, pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores, pa.float64()), lists], names=["id", "score", "attention"]
                )

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, score double, attention array<double>")
    return out.select(F.col("id").alias(id), "score", F.size("attention").alias("n_passages"), "attention")


def op5_attention_mil(spark, sf):
    docs = table(spark, sf, "documents")
    net = train(docs, table(spark, sf, "labels"))
    return score_quality(docs, net).select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
