"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

A word is compared with landmark words by the letters they share in order, gaps allowed
at a price, so that inserted characters, spellings with separators and unseen endings of
a known stem still match. Landmarks are chosen from labelled text; the kernel values
with them, whitened, are the features of a support vector machine trained on the words
of labelled sentences: every word of a clean sentence is a negative, and of a toxic
document the sentences' most suspect words are positives, chosen anew after each fit.
A sentence is worth its worst word, a document its three worst sentences.

The fit sees a bounded, documented sample of labelled rows. Scoring runs over Arrow
batches of whole texts without a shuffle. Null and empty texts have no words and get the
score of a text without any suspect word. Repeated rows give repeated results; the score
reads nothing but the text. Without labels of both kinds every score is 0.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smudgelex.llm.common import fitted, slices, table

# Labelled rows of each kind that a fit may see.
PER_CLASS = 1500
# Length of the shared subsequences, and the price of a position spanned.
ORDER = 4
DECAY = 0.5
LANDMARKS = 32
HARD_LANDMARKS = 8
# Neighbouring letters of a landmark that a word must hold, at most REACH apart, before
# the two are compared at all.
SHARED = 3
REACH = 3
# Decisions are kept between these.
LOW, HIGH = -0.5, 2.0
# Longer words are read in overlapping windows.
WINDOW = 32
CACHE_WORDS = 200_000
THRESHOLD = 0.7
ROWS = 2048
PART_BYTES = 1 << 21

_WORD = re.compile(r"[^\W_](?:\S*[^\W_])?")
_SENTENCE = re.compile(r"[.!?]\s+|\n")
# Letters set apart one by one are one word; it does not cross the end of a sentence.
_SPACED = re.compile(r"(?<!\S)[^\W\d_](?:(?:[ \-_*]{1,2}|\.)[^\W\d_]){3,}(?!\w)")
_APART = re.compile(r"[ .\-_*]")


def words_of(text: str) -> set[str]:
    """Distinct words, lower case; letters set apart are also put together."""
    text = text.lower()
    found = set(_WORD.findall(text))
    for run in _SPACED.findall(text):
        found.add(_APART.sub("", run))
    long = [w for w in found if len(w) > WINDOW]
    for word in long:
        found.discard(word)
        found.update(word[i : i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2))
    return found


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters between a mark at the start and one at the end, and the lengths."""
    sizes = np.array([len(w) + 2 for w in words], dtype=np.int64)
    codes = np.zeros((len(words), int(sizes.max(initial=2))), dtype=np.uint32)
    flat = np.frombuffer("".join([f"\x01{w}\x02" for w in words]).encode("utf-32-le"), dtype=np.uint32)
    codes[np.arange(codes.shape[1]) < sizes[:, None]] = flat
    return codes, sizes


def _pairs_within(codes: np.ndarray, reach: int) -> np.ndarray:
    """512 bits for each word, set by the pairs of letters up to ``reach`` apart."""
    bits = np.zeros((8, len(codes)), dtype=np.uint64)
    for gap in range(1, min(reach, codes.shape[1] - 1) + 1):
        left, right = codes[:, :-gap], codes[:, gap:]
        at = (left * np.uint32(2654435761) + right * np.uint32(2246822519)) >> np.uint32(23)
        one = np.where(right > 0, np.uint64(1) << (at & np.uint32(63)).astype(np.uint64), np.uint64(0))
        word = at >> np.uint32(6)
        for k in range(8):
            bits[k] |= np.bitwise_or.reduce(np.where(word == k, one, np.uint64(0)), axis=1)
    return bits


def _pair_kernel(s: np.ndarray, t: np.ndarray, order: int, decay: float) -> np.ndarray:
    """Gap-weighted common subsequences of ``order`` letters of paired words.

    Rows are letters, columns are pairs; 0 pads a column and matches nothing.
    """
    m, pairs = len(t), s.shape[1]
    total = np.zeros(pairs, dtype=np.float32)
    # state[j, k]: weight of shared runs of k letters before letter j of t, spans to here.
    state = np.zeros((m + 1, order, pairs), dtype=np.float32)
    state[:, 0] = 1.0
    decay, twice = np.float32(decay), np.float32(decay * decay)
    for letter in s:
        same = np.where((t == letter) & (letter != 0), twice, np.float32(0))
        run = np.zeros((order - 1, pairs), dtype=np.float32)
        before = state[0]
        for j in range(m):
            hit = before * same[j]
            total += hit[-1]
            run *= decay
            run += hit[:-1]
            before = state[j + 1].copy()
            state[j + 1, 1:] *= decay
            state[j + 1, 1:] += run
    return total


def _self_kernel(words: list[str]) -> np.ndarray:
    out = np.zeros(len(words), dtype=np.float32)
    codes, sizes = _letters(words)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        column = np.ascontiguousarray(codes[at, :size].T)
        out[at] = _pair_kernel(column, column, ORDER, DECAY)
    return out


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel; pairs that share too few neighbouring letters count as 0."""
    out = np.zeros((len(words), len(landmarks)), dtype=np.float32)
    if not words or not landmarks:
        return out
    codes, sizes = _letters(words)
    marks, lengths = _letters(landmarks)
    bits, mark_bits = _pairs_within(codes, REACH), _pairs_within(marks, 1)
    shared = sum(np.bitwise_count(b[:, None] & m[None, :]) for b, m in zip(bits, mark_bits, strict=True))
    at, of = np.nonzero(shared >= SHARED)
    shape = (sizes[at] + 7) // 8 * 8 * 64 + (lengths[of] + 3) // 4 * 4
    values = np.zeros(len(at), dtype=np.float32)
    for one in np.unique(shape):
        rows = np.flatnonzero(shape == one)
        width, m = min(one // 64, codes.shape[1]), min(one % 64, marks.shape[1])
        for start in range(0, len(rows), 4096):
            part = rows[start : start + 4096]
            s = np.ascontiguousarray(codes[at[part], :width].T)
            t = np.ascontiguousarray(marks[of[part], :m].T)
            values[part] = _pair_kernel(s, t, ORDER, DECAY)
    used, back = np.unique(at, return_inverse=True)
    own = _self_kernel([words[i] for i in used])[back] * _self_kernel(landmarks)[of]
    out[at, of] = np.where(own > 0, values / np.sqrt(np.maximum(own, 1e-20)), 0)
    return out


@dataclass
class Model:
    landmarks: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    # Of the three worst sentences, worst first, and the constant.
    document: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    trained: bool = False

    def decide(self, words: list[str]) -> np.ndarray:
        return kernel(words, self.landmarks) @ self.weights + self.bias

    def score(self, worst: list[float]) -> float:
        if not self.trained:
            return 0.0
        top = sorted([*worst, *[LOW] * 3], reverse=True)[:3]
        z = sum(w * max(LOW, min(HIGH, x)) for w, x in zip(self.document, top)) + self.document[3]
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def _suspicion(docs: list[set[str]], labels: np.ndarray) -> dict[str, float]:
    """How strongly the most telling four letters of a word speak for toxic documents:
    the lower end of their log odds, from counts of documents, but never more than the
    upper end of the word's own."""
    counts = {0: Counter(), 1: Counter()}
    grams = lambda w: {f"^{w}$"[i : i + 4] for i in range(max(1, len(w) - 1))}
    for words, label in zip(docs, labels, strict=True):
        counts[int(label)].update(set().union(*map(grams, words)) if words else ())
    n1, n0 = labels.sum() + 1.0, (1 - labels).sum() + 1.0
    low = {}
    for gram, p in counts[1].items():
        if p >= 4:
            q = counts[0][gram]
            odds = np.log((p + 0.5) / n1) - np.log((q + 0.5) / n0)
            low[gram] = odds - 1.64 * np.sqrt(1 / (p + 0.5) + 1 / (q + 0.5))
    own = {y: Counter(w for d, z in zip(docs, labels, strict=True) if z == y for w in d) for y in (0, 1)}
    out = {}
    for word in {**own[0], **own[1]}:
        best = max((low.get(g, -9.0) for g in grams(word)), default=-9.0)
        if best > 0:
            p, q = own[1][word], own[0][word]
            odds = np.log((p + 0.5) / n1) - np.log((q + 0.5) / n0)
            best = min(best, odds + 1.64 * np.sqrt(1 / (p + 0.5) + 1 / (q + 0.5)))
        out[word] = best
    return out


def _spread_out(words: list[str], most: int, alike: float, chosen: list[str] = []) -> list[str]:
    """``chosen`` and the first words that are not too like an earlier one."""
    words = [w for w in words if 3 <= len(w) <= 12 and w not in chosen]
    every = [*chosen, *words]
    like = kernel(every, every)
    out = list(range(len(chosen)))
    for i in range(len(chosen), len(every)):
        if len(out) >= most:
            break
        if not out or like[i, out].max() < alike:
            out.append(i)
    return [every[i] for i in out]


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float, steps: int = 200) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by accelerated gradient descent."""
    sign = np.where(y == 1, 1.0, -1.0)
    z = np.hstack([x, np.ones((len(x), 1))]) * sign[:, None]
    total = weight / weight.sum() * cost
    step = 1.0 / (1.0 + 2.0 * np.linalg.norm(z * np.sqrt(total)[:, None], 2) ** 2)
    w = ahead = np.zeros(z.shape[1])
    momentum = 1.0
    for _ in range(steps):
        slack = np.maximum(0.0, 1.0 - z @ ahead)
        new = ahead - step * (np.append(ahead[:-1], 0.0) - 2.0 * z.T @ (total * slack))
        follow = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / follow * (new - w)
        w, momentum = new, follow
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Weights that do not fall below 0, by Newton's method."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + 0.5 * np.append(w[:-1], 0)
        curve = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + 0.5 * np.eye(len(w))
        w = w - np.linalg.solve(curve, gradient)
        w[:-1] = np.maximum(w[:-1], 0.0)
    return w


def fit(sample: list[tuple[str, int]], rounds: int = 3) -> Model:
    labels = np.array([y for _, y in sample], dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        return Model()
    # One object for each word, since most of them recur.
    one = lambda text: {sys.intern(w) for w in words_of(text)}
    sentences = [[s for s in map(one, _SENTENCE.split(text)) if s] for text, _ in sample]
    docs = [set().union(*parts) if parts else set() for parts in sentences]
    suspicion = _suspicion(docs, labels)
    witness = Counter(w for d, y in zip(docs, labels, strict=True) if y for w in d if suspicion[w] > 0.5)
    ranked = sorted(witness, key=lambda w: (-suspicion[w] * np.log1p(witness[w]), w))
    # Words unlike each other come first, so that no family of words fills the list.
    marks = _spread_out(ranked[:600], LANDMARKS * 3 // 4, 0.3)
    marks = _spread_out(ranked[:600], LANDMARKS, 0.7, marks)
    if not marks:
        return Model()
    words = sorted(suspicion)
    near = kernel(words, marks)
    index = {w: i for i, w in enumerate(words)}
    clean = Counter(w for d, y in zip(docs, labels, strict=True) if not y for w in d)
    hard = sorted(clean, key=lambda w: (-near[index[w]].max(), w))
    marks = _spread_out(hard[:400], len(marks) + HARD_LANDMARKS, 0.8, marks)
    near = kernel(words, marks)
    values, vectors = np.linalg.eigh(kernel(marks, marks).astype(float) + 1e-3 * np.eye(len(marks)))
    whiten = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T
    # Words without any kernel value are all alike: one negative of their weight.
    count = np.array([clean.get(w, 0) for w in words], dtype=float)
    touched = near.max(axis=1) > 0.1
    negatives = np.flatnonzero(touched & (count > 0))
    decide = np.array([suspicion[w] - 0.5 for w in words])
    model = Model()
    for _ in range(rounds):
        found: Counter = Counter()
        for parts, y in zip(sentences, labels, strict=True):
            if y:
                best = sorted({max(s, key=lambda w: (decide[index[w]], w)) for s in parts}, key=lambda w: -decide[index[w]])
                found.update(w for w in best[:4] if decide[index[w]] > 0)
        positives = np.array(sorted(index[w] for w in found if touched[index[w]]), dtype=int)
        if not len(positives):
            break
        x = np.vstack([near[positives] @ whiten, near[negatives] @ whiten, np.zeros((1, len(marks)))])
        y = np.concatenate([np.ones(len(positives)), np.zeros(len(negatives) + 1)])
        weight = np.concatenate(
            [np.array([found[words[i]] for i in positives], float), np.log1p(count[negatives]), [count[~touched].sum() ** 0.5 + 1]]
        )
        weight[: len(positives)] *= weight[len(positives) :].sum() / weight[: len(positives)].sum() / 6
        w, b = _svm(x, y, weight, cost=20000.0)
        model = Model(marks, (whiten @ w).astype(np.float32), b)
        decide = near @ model.weights + b
    if not model.landmarks:
        return Model()
    worst = [sorted((max(decide[index[w]] for w in s) for s in parts), reverse=True)[:3] for parts in sentences]
    top = np.array([[max(LOW, min(HIGH, v)) for v in [*w, *[LOW] * 3][:3]] for w in worst])
    document = _logistic(top, labels)
    return Model(model.landmarks, model.weights, model.bias, tuple(document.tolist()), True)


class Scorer:
    """Scores texts; words without a landmark in reach are worth the bias alone."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, float] = {}

    def score(self, texts: list[str]) -> list[float]:
        if not self.model.trained:
            return [0.0] * len(texts)
        words = [words_of(t) for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        new = list(set().union(*words).difference(self.known))
        for start in range(0, len(new), 16384):
            part = new[start : start + 16384]
            self.known.update(zip(part, self.model.decide(part).tolist(), strict=True))
        out = []
        for text, own in zip(texts, words, strict=True):
            suspect = {w for w in own if self.known[w] > LOW}
            worst = []
            if suspect:
                for sentence in _SENTENCE.split(text):
                    if found := words_of(sentence) & suspect:
                        worst.append(max(self.known[w] for w in found))
            out.append(self.model.score(worst))
        return out


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fit on labelled rows whose crc32(doc_id) mod 3 is not 1."""
    learned = lambda id: F.crc32(id.cast("string")) % 3 != 1
    return fitted(docs, labels, "toxic", learned, fit, per_class)


def with_scores(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """All columns as they are, and the score as ``name``, higher for likelier toxic."""
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for part in slices(batch, at, ROWS, PART_BYTES):
                texts = [t or "" for t in part.column(at).to_pylist()]
                scores = pa.array(scorer.score(texts), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, scores], names=[*part.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())]))


def score_toxicity(df: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, score)``."""
    rows = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return with_scores(rows, model).select(F.col("id").alias(id), "score")


def op9_string_kernel(spark, sf):
    docs = table(spark, sf, "documents")
    model = train(docs, table(spark, sf, "labels"))
    scored = score_toxicity(docs, model)
    return scored.select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
