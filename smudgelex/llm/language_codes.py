"""Language identification by error-correcting output codes.

Every learned language gets a codeword of bits: all ways of halving the languages where
they are few, otherwise random ones of which the set with the largest distance is taken.
For every bit a linear classifier of byte n-grams (squared hinge loss) is learned that
tells the languages with a 1 from those with a 0. Decoding is weighted by losses: bit by
bit, a language weighs a classifier by how often it was right on that language's
training texts, and pays an exponential loss of the margin against its own codeword. The
language that pays least is chosen; a text is ``ambiguous`` if the runner-up pays nearly
as little.

Texts are lower-cased; ASCII characters that are no letters count as one space. Runs of
one to four bytes are hashed to ``WIDTH`` features, damped by the square root and scaled
to unit length, so that texts of all lengths are alike. The fit sees at most ``SAMPLE``
rows, dealt evenly to the languages, in the order of a hash of the id; a row reaches it
as features, of bounded size however long its text, and one task does the fitting.
Scoring runs over Arrow batches of whole texts without a shuffle.

A null text and one without any letter are ``und`` with score 0 and not ambiguous. If
nothing was learned every text is ``und``, if one language was, every other text is in
that one with score 1. Rows with a null language or text are not learned from; ids and
rows may repeat, then they count again; equal losses go to the first language in the
order of the alphabet; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smudgelex.llm.common import slices, table

WIDTH = 1 << 13
LENGTHS = (1, 2, 3, 4)
# Rows of all languages together that the fit sees.
SAMPLE = 2400
# Parts in which the rows of a language are ranked first.
RANK_PARTS = 32
COST = 4.0
# Up to so many languages all halvings are used, beyond it random codes.
EXHAUSTIVE = 6
TRIES = 50
# How sharply losses become a score, and the lead below which a text is ambiguous.
SHARPNESS = 4.0
LEAD = 0.2
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_PLAIN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def features(text: str) -> np.ndarray:
    """Hashed n-grams of a whole text, of unit length."""
    data = b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split()) + b" "
    codes = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    out = np.zeros(WIDTH, dtype=np.float32)
    value = np.zeros(len(codes), dtype=np.uint32)
    for n in range(1, max(LENGTHS) + 1):
        if n > len(codes):
            break
        value = value[: len(codes) - n + 1] * np.uint32(257) + codes[n - 1 :] + np.uint32(1)
        if n in LENGTHS:
            at = (value * np.uint32(2654435761)) >> np.uint32(32 - (WIDTH.bit_length() - 1))
            out += np.bincount(at, minlength=WIDTH)
    out = np.sqrt(out)
    return out / max(float(np.linalg.norm(out)), 1e-9)


def codewords(k: int) -> np.ndarray:
    """A row of bits for each of ``k`` languages, distinct and far apart; no bit is the
    same for all."""
    if k < 2:
        return np.zeros((k, 0), dtype=np.int8)
    if k <= EXHAUSTIVE:
        # The first language has a 1 throughout, so no halving is used twice.
        chosen = [set(c) | {0} for n in range(k - 1) for c in combinations(range(1, k), n)]
        return np.array([[int(i in c) for c in chosen] for i in range(k)], dtype=np.int8)
    random = np.random.default_rng(k)
    size = int(np.ceil(15 * np.log2(k)))
    best, most = None, -1
    for _ in range(TRIES):
        code = random.integers(0, 2, (k, size), dtype=np.int8)
        if (code.min(axis=0) == code.max(axis=0)).any():
            continue
        signs = 2 * code.astype(np.float32) - 1
        alike = signs @ signs.T
        np.fill_diagonal(alike, -size)
        least = int(size - alike.max()) // 2
        if least > most:
            best, most = code, least
    return best


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    code: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.int8))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((WIDTH, 0), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    # By language and bit, summing to 1 for a language.
    trust: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def losses(self, x: np.ndarray) -> np.ndarray:
        """What every language pays for each row of features."""
        margin = np.clip(x @ self.weights + self.bias, -3, 3)
        signs = 2.0 * self.code - 1.0
        loss = np.exp(-margin[:, None, :] * signs[None, :, :])
        return (loss * self.trust[None, :, :]).sum(axis=2)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chosen language, score, and whether another one is nearly as good."""
        loss = self.losses(x)
        share = np.exp(-SHARPNESS * (loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        chosen = loss.argmin(axis=1)
        if loss.shape[1] < 2:
            return chosen, share.max(axis=1), np.zeros(len(x), dtype=bool)
        two = np.sort(loss, axis=1)[:, :2]
        return chosen, share.max(axis=1), two[:, 1] - two[:, 0] < LEAD

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, languages=np.array(self.languages, dtype=str), code=self.code, weights=self.weights, bias=self.bias, trust=self.trust)
        return out.getvalue()

    @staticmethod
    def unpacked(data: bytes) -> Model:
        held = np.load(io.BytesIO(data))
        return Model(held["languages"].tolist(), held["code"], held["weights"], held["bias"], held["trust"])


def fit(x: np.ndarray, languages: list[str], steps: int = 150) -> Model:
    """One linear machine for every bit, all by the same accelerated descent."""
    names = sorted(set(languages))
    if not names:
        return Model()
    which = np.searchsorted(names, languages)
    code = codewords(len(names))
    if not code.shape[1]:
        return Model(names, code, np.zeros((WIDTH, 0), np.float32), np.zeros(0, np.float32), np.zeros((1, 0)))
    sign = (2.0 * code - 1.0)[which].astype(np.float32)
    # Every language weighs alike, however many rows it has.
    share = (1.0 / np.bincount(which)[which] / len(names)).astype(np.float32)
    z = np.hstack([x, np.ones((len(x), 1), np.float32)])
    penalty = np.full((z.shape[1], 1), 1.0 / (COST * len(x)), np.float32)
    penalty[-1] = 0
    # Rows have length 1 and a constant, so the slope changes by 4 at most.
    rate = np.float32(1.0 / (4.0 + penalty.max()))
    w = ahead = np.zeros((z.shape[1], code.shape[1]), np.float32)
    momentum = 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - sign * (z @ ahead)) * share[:, None]
        new = ahead - rate * (penalty * ahead - 2 * (z.T @ (sign * slack)))
        follow = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + np.float32((momentum - 1) / follow) * (new - w)
        w, momentum = new, follow
    right = (z @ w) * sign > 0
    trust = np.array([(right[which == i].sum(axis=0) + 1) / ((which == i).sum() + 1) for i in range(len(names))])
    return Model(names, code, w[:-1], w[-1], trust / trust.sum(axis=1, keepdims=True))


def _learned(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string")) % 3 != 1, F.lit(True))


def train(df: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Fit on rows whose crc32(id) mod 3 is not 1."""
    rows = df.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where(_learned(F.col("id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    kinds = rows.select("lang").distinct().limit(sample).count()
    each = sample // max(1, kinds)
    # Only ids and hashes are ranked: in parts first, so that no task gets more rows of a
    # language than parts times rows wanted.
    rank = rows.select("id", "lang", F.pmod(F.xxhash64("id"), F.lit(RANK_PARTS)).alias("part"))
    for keys in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy(F.xxhash64("id"), "id")
        rank = rank.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= each)
    chosen = rank.select(F.col("id").alias("_id"), F.col("lang").alias("_lang")).distinct()
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("lang") == F.col("_lang"))
    # At most ``sample`` rows of an id and a language.
    found = rows.join(F.broadcast(chosen), same, "left_semi").select("lang", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                rows = [features(t).astype(np.float16).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.binary())], names=["lang", "x"])

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.frombuffer(v, np.float16) for v in group["x"]]).astype(np.float32)
        return pd.DataFrame({"model": [fit(x, group["lang"].tolist()).packed()]})

    # In a fixed order, so that the model does not depend on the partitions.
    sampled = found.mapInArrow(read, "lang string, x binary").orderBy("lang", "x").limit(2 * sample)
    models = sampled.groupBy(F.lit(0).alias("one")).applyInPandas(learn, "model binary").collect()
    return Model.unpacked(models[0]["model"]) if models else Model()


def identify(df: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, lang_pred, score, ambiguous)``."""
    # The weights of a bounded number of bits.
    shared = df.sparkSession.sparkContext.broadcast(model.packed())
    rows = df.select(F.col(id).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.unpacked(shared.value)
        for batch in batches:
            for part in slices(batch, 1, rows=512):
                texts = part.column(1).to_pylist()
                known = [i for i, t in enumerate(texts) if model.languages and t and _LETTER.search(t)]
                names, scores, doubt = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
                if known:
                    for i, k, s, d in zip(known, *model.decode(np.stack([features(texts[i]) for i in known])), strict=True):
                        names[i], scores[i], doubt[i] = model.languages[k], float(s), bool(d)
                columns = [part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(doubt, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "lang_pred", "score", "ambiguous"])

    kind = dict(rows.dtypes)["id"]
    out = rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, ambiguous boolean")
    return out.withColumnRenamed("id", id)


def op13_language_codes(spark, sf):
    docs = table(spark, sf, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    found = identify(docs, train(docs))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")
