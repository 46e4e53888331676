"""Remove byte strings that occur twice, by sorting suffixes deep and shallow.

A string of 400 bytes (or another length, a parameter) is judged where it starts. Among the 64-byte grams inside it the one
with the smallest hash is its anchor, so equal strings have equal anchors at equal
places, and only strings with the same anchor need to be compared. Consecutive starts
with one anchor form a run, one row for several hundred bytes of text:

* a run whose anchor occurs once has no repeated string;
* runs that share an anchor and are equal as a whole are repeated as a whole;
* the suffixes of all other runs with the same anchor are sorted: by multikey quicksort,
  eight bytes a key, to a shallow depth, and groups that still agree are ordered by blind
  tries, which compare a suffix with one leader and branch at the first difference.

Runs are counted by hash before the shuffle, so copies of a text and passages that many
texts share are counts, not groups. Only the distinct runs of an anchor meet in a task;
where one anchor has more than ``MANY`` of them (some 6 MB), their strings are counted by digest
instead, spread over all tasks. Digests have 128 bits.

Texts are UTF-8 bytes and strings never cross texts. Null texts count as empty; texts
below that length keep everything. Repeated rows are copies of each other, so long ones
are removed whole. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smudgelex.llm.common import joined, materialized, slices, table

# Bytes of a string; any length from a gram on can be asked for.
LENGTH = 400
GRAM = 64
SHALLOW = 32
MANY = 10_000
# Starts that are looked at together, at some 300 bytes each; their places take
# PLACE_BITS of a word.
SEGMENT = 1 << 18
PLACE_BITS = np.uint64(23)
# Bytes whose suffixes are sorted together, or one group of runs that has more.
SORT_BYTES = 1 << 20
# Texts of a batch that are taken out of it at once, and their bytes.
ROWS = 1024
PART_BYTES = 1 << 20

_CODES = np.random.default_rng(400).integers(0, 2**64, 256, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 64 bytes from each place, by doubling."""
    h, width = _CODES[data], 1
    factor = 0xD1342543DE82EF95
    while width < GRAM:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor = factor * factor % 2**64
        width *= 2
    return _mix(h)


def _least(values: np.ndarray, window: int) -> np.ndarray:
    """Least of each ``window`` consecutive values."""
    width = 1
    while width * 2 <= window:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = window - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchored_runs(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Text, first start, last start, anchor place and anchor hash of all runs."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    hashes = gram_hashes(data)
    places = np.arange(len(hashes), dtype=np.uint64)
    least = _least((hashes >> PLACE_BITS) << PLACE_BITS | places, length - GRAM + 1)
    starts = np.arange(len(data) - length + 1)
    text = np.searchsorted(ends, starts, side="right")
    inside = np.flatnonzero(starts + length <= ends[np.minimum(text, len(ends) - 1)])
    if not len(inside):
        return none, none, none, none, none.astype(np.uint64)
    anchor = (least[inside] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    text = text[inside]
    new = np.ones(len(inside), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(inside)] - 1
    return text[first], inside[first], inside[last], anchor[first], hashes[anchor[first]]


def _segments(blobs: list[bytes], length: int = LENGTH) -> Iterator[tuple[list[tuple[int, int]], bytes, np.ndarray]]:
    """Texts put together up to a size; a longer one in parts that overlap."""
    step = SEGMENT - length + 1
    home, parts, size = [], [], 0
    for i, blob in enumerate(blobs):
        if len(blob) < length:
            continue
        for at in range(0, max(1, len(blob) - length + 1), step):
            part = blob[at : at + SEGMENT]
            if size + len(part) > SEGMENT and parts:
                yield home, b"".join(parts), np.cumsum([len(p) for p in parts])
                home, parts, size = [], [], 0
            home.append((i, at))
            parts.append(part)
            size += len(part)
    if parts:
        yield home, b"".join(parts), np.cumsum([len(p) for p in parts])


RUN_SCHEMA = "text binary, first bigint, last bigint, place bigint, anchor bigint, h1 bigint, h2 bigint"


def _find_runs(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    names = ["text", "first", "last", "place", "anchor", "h1", "h2"]
    for part in (part for batch in batches for part in slices(batch, 1, ROWS, PART_BYTES)):
        keys = part.column(0)
        blobs = part.column(1).cast(pa.binary()).to_pylist()
        for home, blob, ends in _segments(blobs, length):
            text, first, last, place, anchor = anchored_runs(np.frombuffer(blob, dtype=np.uint8), ends, length)
            if not len(text):
                continue
            view = memoryview(blob)
            digest = xxhash.xxh3_128_digest
            bounds = zip(first.tolist(), (last + length).tolist(), (place - first).tolist(), strict=True)
            hashes = np.frombuffer(b"".join([digest(view[a:b], seed=p) for a, b, p in bounds]), dtype="<i8").reshape(-1, 2)
            shift = np.array([at for _, at in home]) - np.r_[0, ends[:-1]]
            of = np.array([i for i, _ in home])[text]
            columns = [keys.take(pa.array(of))]
            columns += [pa.array(x + shift[text]) for x in (first, last, place)]
            columns += [pa.array(x) for x in (anchor.view(np.int64), hashes[:, 0].copy(), hashes[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number, the first byte on top."""
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
    n = len(data) + 8
    out = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        out |= padded[k : k + n].astype(np.uint64) << np.uint64(56 - 8 * k)
    return out


def _shared_bytes(words: np.ndarray, a: np.ndarray, b: np.ndarray, depth: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix, up to ``limit``; ``depth`` bytes are known to agree."""
    out = depth.copy()
    todo = np.arange(len(a))
    while len(todo):
        differ = words[a[todo] + out[todo]] ^ words[b[todo] + out[todo]]
        same = differ == 0
        other = todo[~same]
        # Leading zero bytes, by comparison with powers of two.
        top = differ[~same]
        zeros = np.zeros(len(top), dtype=np.int64)
        for k in range(1, 8):
            zeros += top < np.uint64(1 << (64 - 8 * k))
        out[other] = np.minimum(limit, out[other] + zeros)
        todo = todo[same]
        out[todo] += 8
        out[todo] = np.minimum(out[todo], limit)
        todo = todo[out[todo] < limit]
    return out


def repeated_suffixes(data: np.ndarray, starts: np.ndarray, group: np.ndarray, limit: int = LENGTH) -> np.ndarray:
    """Which suffixes share their first ``limit`` bytes with another of their group.

    Every start has ``limit`` bytes behind it.
    """
    words = words_at(data)
    found = np.zeros(len(starts), dtype=bool)
    active, cls = np.arange(len(starts)), group.astype(np.int64)
    # Multikey quicksort with eight bytes a key, to the shallow depth.
    for depth in range(0, min(SHALLOW, limit - 7), 8):
        key = words[starts[active] + depth]
        order = np.lexsort((key, cls))
        active, cls, key = active[order], cls[order], key[order]
        active, cls = _split(active, (cls[1:] != cls[:-1]) | (key[1:] != key[:-1]))
    depth = np.full(len(active), min(SHALLOW, limit // 8 * 8), dtype=np.int64)
    # Blind tries: a leader for each class; the others branch where they leave it.
    while len(active):
        first = np.flatnonzero(np.r_[True, cls[1:] != cls[:-1]])
        leader = np.repeat(first, np.diff(np.r_[first, len(cls)]))
        others = np.flatnonzero(leader != np.arange(len(cls)))
        mine, lead = active[others], active[leader[others]]
        lcp = _shared_bytes(words, starts[mine], starts[lead], depth[others], limit)
        equal = lcp >= limit
        found[mine[equal]] = True
        found[lead[equal]] = True
        rest = others[~equal]
        branch = lcp[~equal]
        letter = data[starts[active[rest]] + branch]
        order = np.lexsort((letter, branch, cls[rest]))
        rest, branch, letter = rest[order], branch[order], letter[order]
        was = cls[rest]
        cut = (was[1:] != was[:-1]) | (branch[1:] != branch[:-1]) | (letter[1:] != letter[:-1])
        at = active[rest]
        keep, cls = _split(np.arange(len(rest)), cut)
        active, depth = at[keep], branch[keep] + 1
    return found


def _split(items: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items of classes with two members or more, and the number of their class."""
    if not len(items):
        return items, items
    cls = np.r_[0, np.cumsum(cut)]
    keep = np.bincount(cls)[cls] > 1
    return items[keep], cls[keep]


def _stretches(flags: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of the maximal stretches of flags inside one owner."""
    on = np.flatnonzero(flags)
    if not len(on):
        return on, on
    new = np.ones(len(on), dtype=bool)
    new[1:] = (on[1:] != on[:-1] + 1) | (owner[on[1:]] != owner[on[:-1]])
    first = np.flatnonzero(new)
    return on[first], on[np.r_[first[1:], len(on)] - 1]


MARK_SCHEMA = "anchor bigint, h1 bigint, h2 bigint, low bigint, high bigint"


def _sort_groups(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Sorts the suffixes of whole groups of runs that arrive in the order of anchors."""

    def done(rows: list[tuple]) -> pa.RecordBatch:
        blobs = [r[4] for r in rows]
        sizes = np.array([len(b) for b in blobs])
        counts = sizes - length + 1
        owner = np.repeat(np.arange(len(rows)), counts)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = (np.cumsum(sizes) - sizes)[owner] + within
        group = np.unique([r[0] for r in rows], return_inverse=True)[1]
        data = np.frombuffer(b"".join(blobs), dtype=np.uint8)
        first, last = _stretches(repeated_suffixes(data, starts, group[owner], length), owner)
        of = owner[first]
        low = np.array([r[3] for r in rows], dtype=np.int64)[of]
        keys = [np.array([r[k] for r in rows], dtype=np.int64)[of] for k in range(3)]
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, keys), pa.array(low + within[first]), pa.array(low + within[last])],
            names=["anchor", "h1", "h2", "low", "high"],
        )

    rows: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if size > SORT_BYTES and row[0] != rows[-1][0]:
                yield done(rows)
                rows, size = [], 0
            rows.append(row)
            size += len(row[4])
    if rows:
        yield done(rows)


def _digests(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "h1", "h2", "offset", "digest"]
    for batch in batches:
        for anchor, h1, h2, low, blob in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            view, n = memoryview(blob), len(blob) - length + 1
            digests = [xxhash.xxh3_128_digest(view[i : i + length]) for i in range(n)]
            same = [pa.array(np.full(n, x, dtype=np.int64)) for x in (anchor, h1, h2)]
            offsets = pa.array(np.arange(low, low + n, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*same, offsets, pa.array(digests, pa.binary())], names=names)


def _cut_runs(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "h1", "h2", "low", "content", "many"]
    for part in (part for batch in batches for part in slices(batch, 0, ROWS, PART_BYTES)):
        out: list[list] = [[] for _ in names]
        for text, runs in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            blob = text.encode()
            for r in runs:
                row = (r["anchor"], r["h1"], r["h2"], r["first"] - r["place"], blob[r["first"] : r["last"] + length], r["many"])
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        kinds = [pa.int64()] * 4 + [pa.binary(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=names)


def _mixed_marks(mixed: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """Repeated starts, from the anchor, of the distinct runs that share an anchor."""
    keys = ["anchor", "h1", "h2"]
    one = F.min(F.struct("text", "first", "last", "place")).alias("one")
    runs = mixed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), one)
    runs = materialized(runs.select(*keys, "n", "one.*"))
    sizes = runs.groupBy("anchor").agg((F.count(F.lit(1)) > MANY).alias("many"))
    runs = joined(runs, materialized(sizes), ["anchor"])
    per_text = runs.groupBy("text").agg(F.collect_list(F.struct(*keys, "first", "last", "place", "many")).alias("runs"))
    per_text = materialized(per_text)
    # Only texts that hold a run to be compared are moved, each once.
    needed = joined(texts, materialized(per_text.select("text")), ["text"], "inner")
    needed = needed.groupBy("text").agg(F.min("body").alias("body"))
    cut = needed.join(per_text, "text").select("body", "runs")
    cut = materialized(cut.mapInArrow(partial(_cut_runs, length=length), "anchor bigint, h1 bigint, h2 bigint, low bigint, content binary, many boolean"))
    few = cut.where("not many").drop("many").repartition("anchor").sortWithinPartitions("anchor")
    sorted_ = few.mapInArrow(partial(_sort_groups, length=length), MARK_SCHEMA)
    spelled = cut.where("many").drop("many").mapInArrow(
        partial(_digests, length=length), "anchor bigint, h1 bigint, h2 bigint, offset bigint, digest binary"
    )
    counts = spelled.groupBy("anchor", "offset", "digest").agg(F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    again = spelled.join(counts, ["anchor", "offset", "digest"])
    counted = again.select(*keys, F.col("offset").alias("low"), F.col("offset").alias("high"))
    settled = runs.where("n > 1").select(
        *keys, (F.col("first") - F.col("place")).alias("low"), (F.col("last") - F.col("place")).alias("high")
    )
    return sorted_.unionByName(counted).unionByName(settled)


def repeated_spans(df: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``(text, spans)``: by MD5 of a text, the starts of repeated strings, as an array
    of first and last; texts without any are left out."""
    rows = df.select(F.coalesce(F.col(text), F.lit("")).alias("body"))
    texts = rows.select(F.unhex(F.md5("body")).alias("text"), "body")
    runs = materialized(texts.mapInArrow(partial(_find_runs, length=length), RUN_SCHEMA))
    shared = runs.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"),
        (
            (F.min("h1") != F.max("h1")) | (F.min("h2") != F.max("h2"))
        ).alias("mixed"),
    )
    shared = materialized(shared.where("n > 1").drop("n"))
    hits = materialized(joined(runs, shared, ["anchor"], "inner"))
    whole = hits.where("not mixed").select("text", "first", "last")
    mixed = hits.where("mixed").drop("mixed")
    marks = materialized(_mixed_marks(mixed, texts, length))
    keys = ["anchor", "h1", "h2"]
    parts = mixed.join(marks, keys).select(
        "text", (F.col("place") + F.col("low")).alias("first"), (F.col("place") + F.col("high")).alias("last")
    )
    # Copies of a text say the same, and are one row before they are gathered.
    spans = whole.unionByName(parts).distinct()
    return spans.groupBy("text").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))


RESULT_SCHEMA = "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, rest string"


def _remove(blob: bytes, spans: list[tuple[int, int]], length: int = LENGTH) -> tuple[int, int, bytes, str]:
    """Bytes removed, maximal runs removed, what remains, and its whole characters."""
    kept, removed, n, at = [], 0, 0, 0
    for first, last in spans:
        start, end = max(first, at), last + length
        if first > at or not n:
            kept.append(blob[at:first])
            n += 1
            at = first
            start = first
        if end > start:
            removed += end - start
            at = max(at, end)
    kept.append(blob[at:])
    return removed, n, b"".join(kept), "".join([k.decode("utf-8", "ignore") for k in kept])


def remove_repeats(
    df: DataFrame, id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), length: int = LENGTH
) -> DataFrame:
    """Removes what strings of ``length`` bytes that start more than once cover.

    ``(id, carry..., n_bytes, n_removed, n_spans, kept, rest)``; ``kept`` is what
    remains, as bytes, since a removed string may end inside a character; ``rest`` holds
    the characters that remain whole, as text."""
    if length < GRAM:
        raise ValueError(f"a string has {GRAM} bytes at least")
    spans = materialized(repeated_spans(df, id, text, length))
    body = F.coalesce(F.col(text), F.lit(""))
    extra = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    rows = df.select(F.col(id).alias("id"), *extra, F.unhex(F.md5(body)).alias("text"), body.alias("body"))
    flags = materialized(spans.select("text", F.lit(True).alias("cut")))
    rows = joined(rows, flags, ["text"])
    names = ["id", *[f"carry_{i}" for i in range(len(carry))]]
    clean = rows.where("cut is null").select(
        *names,
        F.octet_length("body").cast("bigint").alias("n_bytes"),
        F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"),
        F.col("body").cast("binary").alias("kept"),
        F.col("body").alias("rest"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in slices(batch, len(names), ROWS, PART_BYTES)):
            out = []
            for body, found in zip(part.column(len(names)).to_pylist(), part.column(len(names) + 1).to_pylist(), strict=True):
                blob = body.encode()
                out.append((len(blob), *_remove(blob, [(s["first"], s["last"]) for s in found], length)))
            types = [pa.int64()] * 3 + [pa.binary(), pa.string()]
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(types)]
            found = [*names, "n_bytes", "n_removed", "n_spans", "kept", "rest"]
            yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], *columns], names=found)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in names)
    dirty = rows.where("cut").drop("cut").join(spans, "text").select(*names, "body", "spans")
    dirty = dirty.mapInArrow(cut, f"{kinds}, {RESULT_SCHEMA}")
    back = {"id": id} | {f"carry_{i}": c for i, c in enumerate(carry)}
    return clean.unionByName(dirty).withColumnsRenamed(back)


def op8_suffix_dedup(spark, sf):
    out = remove_repeats(table(spark, sf, "documents"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", digest, (F.col("n_removed") > 0).alias("repeats"))
