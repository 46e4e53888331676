"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is the multiset of its runs of five words, weighted by how often it holds them
and by how few documents do. Consistent weighted samples of that set agree between two
texts as often as their weighted Jaccard similarity says; four samples make a band key,
and texts that share a key are candidates. Candidates are verified with the exact
weighted Jaccard similarity of their whole texts.

Document frequencies are counted exactly over all documents, as packed sorted hashes
that are dealt out by range. A run in fewer than one of ``RARE`` documents has the
weight of one in exactly that many; so the runs with a frequency of their own number at
most ``RARE`` times the mean length of a text, and that bounded table goes to every
task.

Equal word sequences count as one text. A band's bucket is never expanded into pairs:
its members are compared with the bucket's first, then, as far as they are still in
different classes, with its last. In the end the members of buckets with the same first
are a group, and all pairs of a group and of different classes are settled by how they
differ from the group's middle, the runs that most of a few members hold. Two texts
reach the similarity exactly if their excesses (the weight they differ in from the
middle, less a share of their weight) are together at most twice the weight of the
differences that both have. Without any in common, both reach it with the member of
least excess: one comparison for each member. All others have to share a part of their
differences, which are few and seldom the same; only pairs with a common element among
the first, rare ones are verified. The middle is no estimate of anything in the result:
any set gives the same links. Classes are the connected components of the links.

Words are split at white space, ASCII capitals count as small letters. A text of fewer
than five words has one run, all of it. Null and empty texts have none and are classes
of their own. Repeated rows are in the class of their text, repeated ids too. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smudgelex.llm.common import joined, materialized, slices, table
from smudgelex.llm.components import connected
from smudgelex.llm.word_arrays import mix, window_hashes, word_hashes, words_of

SIZE = 5
SIMILARITY = 0.8
BANDS = 24
BAND_ROWS = 4
SAMPLES = BANDS * BAND_ROWS
RARE = 1000
# Rows of the table of random numbers; runs share a row by their hash.
RANDOM_ROWS = 1 << 16
TABLE_ROWS = 1 << 12
# Texts that are cut into runs at once, and their bytes.
ROWS = 1024
PART_BYTES = 1 << 20
RANGE_CHARS = 4_000_000
BLOCK = 8192
# Members that the middle of a group is made of; it may be any set.
MIDDLE = 64
# Part of a weight that sums may be off by.
SLACK = 1e-5


def shingles_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Sorted by text and hash: hashes, counts and texts of the runs; and a key of every
    text's word sequence."""
    words = words_of(texts)
    hashes = word_hashes(words)
    runs, doc = window_hashes(hashes, words.doc, SIZE)
    counts = words.counts(len(texts))
    ends = np.cumsum(counts)
    keys = [xxhash.xxh3_128_digest(hashes[e - c : e].tobytes()) for c, e in zip(counts, ends, strict=True)]
    short = np.flatnonzero((counts > 0) & (counts < SIZE))
    if len(short):
        extra = np.array([xxhash.xxh3_64_intdigest(keys[i]) for i in short], dtype=np.uint64)
        runs, doc = np.concatenate([runs, extra]), np.concatenate([doc, short])
    order = np.lexsort((runs, doc))
    runs, doc = runs[order], doc[order]
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:] != runs[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    return runs[at], np.diff(np.r_[at, len(runs)]), doc[at], keys


def _texts(part: pa.RecordBatch, column: int) -> list[str]:
    return part.column(column).to_pylist()


def common_runs(rows: DataFrame, chars: int, least: int) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    """Hashes and frequencies of the runs in ``least`` documents or more, and the low
    bits of a hash that were left out of the count (18 at most)."""
    bits = max(6, int(np.ceil(np.log2(chars / RANGE_CHARS + 1))))
    shift, width = np.uint64(64 - bits), 5
    low = np.uint64((1 << (8 * width)) - 1)
    drop = np.uint64(64 - bits - 8 * width)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, ROWS, PART_BYTES):
                runs = np.sort(shingles_of(_texts(part, 0))[0])
                ranges = (runs >> shift).astype(np.int64)
                bytes_ = ((runs >> drop) & low).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
                found, first = np.unique(ranges, return_index=True)
                blobs = [x.tobytes() for x in np.split(bytes_, first[1:])] if len(found) else []
                columns = [pa.array(found, pa.int64()), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["range", "blob"])

    def count(key, group: pd.DataFrame) -> pd.DataFrame:
        data = np.frombuffer(b"".join(group["blob"]), dtype=np.uint8).reshape(-1, width)
        values = np.zeros((len(data), 8), dtype=np.uint8)
        values[:, :width] = data
        runs, n = np.unique(values.view("<u8").ravel(), return_counts=True)
        keep = n >= least
        full = (np.uint64(key[0]) << np.uint64(8 * width)) | runs[keep]
        return pd.DataFrame({"run": full.astype(np.int64), "n": n[keep]})

    packed = rows.select("text").mapInArrow(pack, "range bigint, blob binary")
    # At most RARE times the mean number of runs of a text.
    found = packed.groupBy("range").applyInPandas(count, "run bigint, n bigint").toPandas()
    found = found.sort_values("run")
    return found["run"].to_numpy(np.uint64) << drop, found["n"].to_numpy(np.int64), drop


class Weights:
    def __init__(self, runs: np.ndarray, counts: np.ndarray, drop: np.uint64, documents: int):
        self.runs, self.drop = runs, drop
        self.idf = (1.0 + np.log(documents / np.maximum(counts, 1))).astype(np.float32)
        self.base = np.float32(1.0 + np.log(documents / max(1.0, documents / RARE)))

    def of(self, runs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(runs), self.base, dtype=np.float32)
        if len(self.runs) and len(runs):
            short = (runs >> self.drop) << self.drop
            at = np.minimum(np.searchsorted(self.runs, short), len(self.runs) - 1)
            hit = self.runs[at] == short
            out[hit] = self.idf[at[hit]]
        return out * counts.astype(np.float32)


@lru_cache(maxsize=1)
def _tables(base: float) -> tuple[np.ndarray, ...]:
    """Scale, offset and log cost of the sampling, and what they give for weight ``base``."""
    random = np.random.default_rng(99)
    starts = range(0, RANDOM_ROWS, TABLE_ROWS)

    def drawn(numbers, kind) -> np.ndarray:
        """A table filled in parts, so that full precision is held for a part alone."""
        out = np.empty((RANDOM_ROWS, SAMPLES), dtype=kind)
        for start in starts:
            out[start : start + TABLE_ROWS] = numbers(start)
        return out

    shape = (TABLE_ROWS, SAMPLES)
    # Half precision is enough for numbers that only have to be random.
    scale = drawn(lambda _: random.gamma(2.0, 1.0, shape), np.float16)
    offset = drawn(lambda _: random.random(shape, dtype=np.float32), np.float16)
    cost = drawn(lambda _: np.log(random.gamma(2.0, 1.0, shape)), np.float16)
    log_base = np.float32(np.log(base))
    parts = lambda k: lambda at: _sampled(log_base, *(x[at : at + TABLE_ROWS] for x in (scale, offset, cost)))[k]
    return scale, offset, cost, drawn(parts(0), np.float32), drawn(parts(1), np.int16)


def _sampled(log_weight, scale, offset, cost):
    scale, offset = np.maximum(scale.astype(np.float32), np.float32(1e-3)), offset.astype(np.float32)
    level = np.floor(log_weight / scale + offset)
    return cost - scale * (level - offset + 1), level.astype(np.int16)


def signature(runs: np.ndarray, weights: np.ndarray, base: np.float32) -> np.ndarray:
    """One consistent weighted sample for each of ``SAMPLES``; ties go to the smaller run."""
    scale, offset, cost, base_value, base_level = _tables(float(base))
    best = np.full(SAMPLES, np.inf, dtype=np.float32)
    out = np.zeros(SAMPLES, dtype=np.uint64)
    every = np.arange(SAMPLES)
    for start in range(0, len(runs), BLOCK):
        part, own = runs[start : start + BLOCK], weights[start : start + BLOCK]
        at = (part & np.uint64(RANDOM_ROWS - 1)).astype(np.int64)
        value = base_value[at]
        other = np.flatnonzero(own != base)
        level = None
        if len(other):
            rows = at[other]
            log_weight = np.log(own[other])[:, None]
            value[other], level = _sampled(log_weight, scale[rows], offset[rows], cost[rows])
        who = value.argmin(axis=0)
        least = value[who, every]
        levels = base_level[at[who], every].astype(np.int64)
        if level is not None:
            place = np.full(len(part), -1)
            place[other] = np.arange(len(other))
            mine = place[who]
            levels = np.where(mine >= 0, level[np.maximum(mine, 0), every], levels)
        better = least < best
        sample = mix(part[who] + levels.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[better] = sample[better]
        best[better] = least[better]
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples.reshape(BANDS, BAND_ROWS)
    out = np.arange(BANDS, dtype=np.uint64)
    for k in range(BAND_ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return out.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sorted sets with weights."""
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][left], b[1][right]).sum(dtype=float)
    total = a[1].sum(dtype=float) + b[1].sum(dtype=float) - shared
    return shared / total if total > 0 else 0.0


def _signed(rows: DataFrame, weights) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            for part in slices(batch, 1, ROWS, PART_BYTES):
                runs, counts, doc, keys = shingles_of(_texts(part, 1))
                own = w.of(runs, counts)
                ends = np.searchsorted(doc, np.arange(part.num_rows + 1))
                bands, sizes = [], []
                for a, b in zip(ends[:-1], ends[1:], strict=True):
                    if b > a:
                        bands.append(band_keys(signature(runs[a:b], own[a:b], w.base)))
                    sizes.append(BANDS * (b > a))
                flat = np.concatenate([*bands, np.zeros(0, np.int64)])
                lists = pa.ListArray.from_arrays(np.cumsum([0, *sizes], dtype=np.int32), pa.array(flat))
                columns = [part.column(0), pa.array(keys, pa.binary()), lists, part.column(2)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "key", "bands", "note"])
        # The worker lives on in other stages, which need the memory.
        _tables.cache_clear()

    return rows.mapInArrow(sign, "id bigint, key binary, bands array<bigint>, note string")


def prefix_of(runs: np.ndarray, weights: np.ndarray, each: np.ndarray, least: float) -> np.ndarray:
    """The first runs, rare ones first, whose weight is more than two texts that reach
    ``least`` can differ in: such texts have one of these runs in common."""
    order = np.lexsort((runs, -each))
    so_far = np.cumsum(weights[order], dtype=float)
    spare = (1.0 - least + 1e-6) * so_far[-1] if len(runs) else 0.0
    return runs[order[: np.searchsorted(so_far, spare, side="right") + 1]]


def middle_of(sets: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Of all runs that two sets hold: the weight that more than half of the sets reach,
    and the number of sets that hold them."""
    runs, weights = (np.concatenate(x) for x in zip(*sets, strict=True))
    order = np.lexsort((-weights, runs))
    runs, weights = runs[order], weights[order]
    first = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]][: len(runs)])
    held = np.diff(np.r_[first, len(runs)])
    half = len(sets) // 2
    weight = np.where(held > half, weights[np.minimum(first + half, len(runs) - 1)], np.float32(0))
    keep = held > 1
    return runs[first[keep]], weight[keep], held[keep].astype(np.uint8)


def difference(runs: np.ndarray, weights: np.ndarray, middle: tuple[np.ndarray, ...], sets: int) -> tuple[np.ndarray, ...]:
    """Where a text has more or less weight than the middle: sorted numbers of run and
    sign, by how much, and how many of the middle's ``sets`` differ in the same way."""
    every = np.union1d(runs, middle[0])
    more, seen = np.zeros(len(every)), np.zeros(len(every), dtype=np.int64)
    more[np.searchsorted(every, runs)] = weights
    at = np.searchsorted(every, middle[0])
    more[at] -= middle[1]
    seen[at] = middle[2]
    apart = np.flatnonzero(more)
    less = more[apart] < 0
    elements = every[apart] ^ (less.astype(np.uint64) << np.uint64(63))
    order = np.argsort(elements)
    seen = np.where(less, sets - seen[apart], seen[apart])
    return elements[order], np.abs(more[apart])[order], seen[order]


def _middles(members: DataFrame, texts: DataFrame, weights) -> DataFrame:
    """``(low, runs, own, seen, sets)``: the middle of ``MIDDLE`` members of a group."""
    order = Window.partitionBy("low").orderBy(F.xxhash64("id"), "id")
    some = members.select("low", "id", F.row_number().over(order).alias("place")).where(F.col("place") <= MIDDLE)
    some = some.select("low", "id").join(texts, "id")

    def middle(group: pa.Table) -> pa.Table:
        runs, counts, doc, _ = shingles_of(group.column("text").to_pylist())
        own = weights.value.of(runs, counts)
        ends = np.searchsorted(doc, np.arange(group.num_rows + 1))
        found = middle_of([(runs[a:b], own[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)])
        blobs = [pa.array([x.tobytes()], pa.binary()) for x in found]
        columns = [group.column("low").slice(0, 1).combine_chunks(), *blobs, pa.array([group.num_rows], pa.int64())]
        return pa.Table.from_arrays(columns, names=["low", "runs", "own", "seen", "sets"])

    return some.groupBy("low").applyInArrow(middle, "low bigint, runs binary, own binary, seen binary, sets bigint")


def _differences(members: DataFrame, texts: DataFrame, weights, least: float) -> DataFrame:
    """``(low, id, total, size, elements, rest)`` for each member of a group: its weight,
    the weight it differs in from the group's middle, the first elements of that
    difference, rare ones first, and the weight from each on.

    Texts that reach ``least`` differ by at most ``1 / least - 1`` of either's weight from
    each other, so they share all of their differences but that, and an element of the
    first ones.
    """
    middles = materialized(_middles(members, texts, weights))
    both = members.select("low", "id").join(texts, "id")
    both = joined(both, middles, ["low"], "inner").select("low", "id", "text", "runs", "own", "seen", "sets")

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            for part in slices(batch, 2, ROWS // 4, PART_BYTES // 2):
                runs, counts, doc, _ = shingles_of(_texts(part, 2))
                own = w.of(runs, counts)
                ends = np.searchsorted(doc, np.arange(part.num_rows + 1))
                totals, sizes, kept, rest = [], [], [], []
                middles = zip(*[part.column(k).to_pylist() for k in range(3, 7)], strict=True)
                for a, b, (x, y, z, sets) in zip(ends[:-1], ends[1:], middles, strict=True):
                    middle = np.frombuffer(x, np.uint64), np.frombuffer(y, np.float32), np.frombuffer(z, np.uint8)
                    elements, by, seen = difference(runs[a:b], own[a:b], middle, sets)
                    totals.append(float(own[a:b].sum(dtype=float)))
                    sizes.append(float(by.sum()))
                    part_of = 1.0 - (1.0 / least - 1.0 + SLACK) * totals[-1] / max(sizes[-1], 1e-9)
                    kept.append(prefix_of(elements, by, -seen, part_of))
                    first = by[np.searchsorted(elements, kept[-1])]
                    rest.append((sizes[-1] - np.cumsum(first) + first).astype(np.float32))
                at = np.cumsum([0, *map(len, kept)], dtype=np.int32)
                flat = [np.concatenate([*x, np.zeros(0, kind)]) for x, kind in ((kept, np.uint64), (rest, np.float32))]
                lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (flat[0].view(np.int64), flat[1])]
                columns = [part.column(0), part.column(1), pa.array(totals, pa.float64()), pa.array(sizes, pa.float64()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=["low", "id", "total", "size", "elements", "rest"])

    schema = "low bigint, id bigint, total double, size double, elements array<bigint>, rest array<float>"
    found = materialized(both.mapInArrow(differ, schema))
    # Two texts reach ``least`` if their excesses are at most twice what they share of
    # their differences.
    return found.withColumn("excess", F.col("size") - (1.0 - least) / (1.0 + least) * F.col("total"))


def _nearest_middle(differences: DataFrame, labels: DataFrame) -> DataFrame:
    """``(a, b)``: in each group the member of least excess with all that reach the
    similarity without a difference in common. Two others that do so both reach it."""
    least = differences.groupBy("low").agg(F.min(F.struct("excess", "id")).alias("one"))
    least = least.select("low", F.col("one.id").alias("a"), F.col("one.excess").alias("a_excess"))
    pairs = joined(differences.select("low", "id", "excess", "total"), least, ["low"], "inner")
    pairs = pairs.where((F.col("id") != F.col("a")) & (F.col("excess") + F.col("a_excess") <= SLACK * F.col("total")))
    pairs = pairs.select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct()
    return _across(pairs, labels)


def _alike_differences(differences: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """``(a, b)``: all pairs of a group and of different classes that can share so much
    of their differences that they reach ``least``.

    What a member has to share at least follows from the least excess in other classes.
    Of a pair, the first element that both have leaves enough on both sides.
    """
    rows = _classed(differences, "id", labels)
    by_class = materialized(rows.groupBy("low", "id_class").agg(F.min("excess").alias("e")))
    one = by_class.groupBy("low").agg(F.min(F.struct("e", "id_class")).alias("one")).select("low", F.col("one.e").alias("e_one"), F.col("one.id_class").alias("c_one"))
    other = by_class.join(one, "low").where("id_class != c_one").groupBy("low").agg(F.min("e").alias("e_other"))
    bounds = one.join(other, "low")
    rows = joined(rows, bounds, ["low"], "inner")
    nearest = F.when(F.col("id_class") == F.col("c_one"), F.col("e_other")).otherwise(F.col("e_one"))
    spare = SLACK * F.col("total")
    rows = rows.withColumn("need", (F.col("excess") + nearest) / 2 - spare)
    rows = rows.where("size >= need").select("low", "id", "id_class", "total", "excess", "need", F.explode(F.arrays_zip("elements", "rest")).alias("at"))
    rows = rows.where("at.rest >= need").select("low", "id", "id_class", "total", "excess", F.col("at.elements").alias("element"), F.col("at.rest").alias("rest"))
    rows = materialized(rows)
    mixed = rows.groupBy("low", "element").agg(F.min("id_class").alias("x"), F.max("id_class").alias("y"))
    rows = rows.join(mixed.where("x != y").select("low", "element"), ["low", "element"])
    names = ("id", "id_class", "total", "excess", "rest")
    left, right = (rows.withColumnsRenamed({x: x.replace("id", to) if x.startswith("id") else f"{to}_{x}" for x in names}) for to in "ab")
    near = F.least("a_total", "b_total") >= (least - SLACK) * F.greatest("a_total", "b_total")
    shared = F.least("a_rest", "b_rest") >= (F.col("a_excess") + F.col("b_excess")) / 2 - SLACK * F.least("a_total", "b_total")
    apart = (F.col("a") < F.col("b")) & (F.col("a_class") != F.col("b_class"))
    return left.join(right, ["low", "element"]).where(apart & near & shared).select("a", "b").distinct()


def _of_ids(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of the ids in the one column of a finished table."""
    return joined(texts.select("id", "text"), ids.toDF("id").distinct(), ["id"], "inner")


def _verified(pairs: DataFrame, texts: DataFrame, weights, least: float) -> DataFrame:
    """Of finished pairs ``(a, b)`` those whose texts, one row for each id, reach the
    similarity, as a finished table."""
    needed = _of_ids(texts, pairs.select("a").union(pairs.select("b")))
    both = pairs.join(needed.withColumnsRenamed({"id": "a", "text": "left"}), "a")
    both = both.join(needed.withColumnsRenamed({"id": "b", "text": "right"}), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            for part in slices(batch, 2, ROWS // 4, PART_BYTES // 2):
                left, right = _texts(part, 2), _texts(part, 3)
                place = {t: i for i, t in enumerate(dict.fromkeys([*left, *right]))}
                runs, counts, doc, _ = shingles_of(list(place))
                own = w.of(runs, counts)
                ends = np.searchsorted(doc, np.arange(len(place) + 1))
                one = lambda t: (runs[ends[place[t]] : ends[place[t] + 1]], own[ends[place[t]] : ends[place[t] + 1]])
                like = [similarity(one(x), one(y)) for x, y in zip(left, right, strict=True)]
                columns = [part.column(0), part.column(1), pa.array(like, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "similarity"])

    links = both.select("a", "b", "left", "right").mapInArrow(check, "a bigint, b bigint, similarity double")
    return materialized(links.where(F.col("similarity") >= least).select("a", "b"))


def _classed(rows: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """Adds ``class``: the label of the id in ``column``, or the id where it has none."""
    names = labels.select(F.col("node").alias(column), "label")
    out = rows.join(names, column, "left")
    return out.withColumn(f"{column}_class", F.coalesce("label", column)).drop("label")


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of different classes."""
    return _classed(_classed(pairs, "a", labels), "b", labels).where("a_class != b_class").select("a", "b")


def near_duplicate_classes(
    df: DataFrame, id: str = "doc_id", text: str = "text", least: float = SIMILARITY, note: str | None = None
) -> DataFrame:
    """``(id, class_id, n_links[, note])``: the smallest id of the class, and the number
    of verified links of the document's text that the classes were built from. The
    string column ``note`` goes along. A null id counts as a negative number made from
    the text."""
    body = F.coalesce(F.col(text), F.lit(""))
    made = -1 - F.pmod(F.xxhash64(body), F.lit(2**62))
    rows = df.select(
        F.coalesce(F.col(id).cast("bigint"), made).alias("id"),
        body.alias("text"),
        (F.lit(None).cast("string") if note is None else F.col(note)).alias("note"),
    )
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    n = max(1, size["n"])
    runs, counts, drop = common_runs(rows, size["chars"], max(2, int(np.ceil(n / RARE))))
    weights = rows.sparkSession.sparkContext.broadcast(Weights(runs, counts, drop, n))
    signed = materialized(_signed(rows, weights))
    one = signed.where(F.size("bands") > 0).groupBy("key").agg(F.min(F.struct("id", "bands")).alias("one"))
    reps = materialized(one.select("key", "one.*"))
    spread = reps.select("id", F.posexplode("bands").alias("band", "h"))
    buckets = spread.groupBy("band", "h").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high")
    )
    buckets = buckets.where("n > 1").drop("n")
    held = materialized(spread.join(buckets, ["band", "h"]))
    # First the leader that most bands name, then all others still in another class.
    named = held.where("id != low").groupBy("id", "low").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("id").orderBy(F.desc("n"), "low")
    named = materialized(named.select("id", "low", (F.row_number().over(order) == 1).alias("best")))
    # The texts that any pair may need, one row for each id.
    texts = _of_ids(rows, named.select("id").union(named.select("low")))
    texts = materialized(texts.groupBy("id").agg(F.min("text").alias("text")))
    led = lambda which: named.where(which).select(F.col("low").alias("a"), F.col("id").alias("b"))
    tried = led("best")
    links = _verified(tried, texts, weights, least)
    labels = connected(links)
    last = held.where("id != high").select(F.least("id", "high").alias("a"), F.greatest("id", "high").alias("b"))
    differences = None
    for step in range(4):
        if step < 2:
            more = _across((led("not best"), last.distinct())[step], labels)
        elif step == 2:
            # Groups have a leader in common; whoever is in a bucket is in its leader's.
            mine = _classed(named.select("low", "id"), "id", labels)
            mixed = mine.groupBy("low").agg(F.min("id_class").alias("x"), F.max("id_class").alias("y"))
            mine = materialized(mine.join(mixed.where("x != y").select("low"), "low").select("low", "id"))
            differences = _differences(mine, _of_ids(texts, mine.select("id")), weights, least)
            more = _nearest_middle(differences, labels).join(tried, ["a", "b"], "left_anti")
        else:
            more = _alike_differences(differences, labels, least).join(tried, ["a", "b"], "left_anti")
        more = materialized(more)
        tried = tried.union(more)
        if more.isEmpty():
            continue
        found = _verified(more, texts, weights, least)
        if found.isEmpty():
            continue
        links = links.union(found)
        labels = connected(found, labels)
    ends = links.select(F.col("a").alias("id")).union(links.select("b"))
    degree = ends.groupBy("id").agg(F.count(F.lit(1)).alias("n_links"))
    texts = reps.select("key", F.col("id").alias("first"))
    texts = texts.join(labels.withColumnRenamed("node", "first"), "first", "left")
    texts = texts.join(degree.withColumnRenamed("id", "first"), "first", "left")
    texts = texts.select("key", F.coalesce("label", "first").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))
    texts = materialized(texts)
    # Copies of one text may be many: only texts with copies or links need the join.
    out = joined(signed.select("id", "key", "note", (F.size("bands") > 0).alias("some")), texts, ["key"])
    class_id = F.when(F.col("some"), F.col("class_id")).otherwise(F.col("id"))
    links_of = F.when(F.col("some"), F.col("n_links")).otherwise(F.lit(0).cast("bigint"))
    kept = [] if note is None else [F.col("note").alias(note)]
    return out.select(F.col("id").alias(id), class_id.alias("class_id"), links_of.alias("n_links"), *kept)


def op10_weighted_minhash(spark, sf):
    return near_duplicate_classes(table(spark, sf, "documents"))
