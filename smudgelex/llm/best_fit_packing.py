"""Pack tokenized documents into few sequences of bounded length.

Documents are tokenized and cut into pieces no longer than a sequence. Which pieces
share a sequence depends on their lengths alone, so the plan is made from the histogram
of lengths: at most ``capacity`` numbers, whatever the corpus. Small sets of lengths that
provably dominate every alternative for the longest piece (Martello and Toth) are fixed
for good, and what remains is packed by best fit, longest first, in bulk. Then every
piece takes its place by its rank among the pieces of its length; ranks are counted
within parts, so that a length with much of the corpus is shared by many tasks.

Null texts count as empty; an empty text is one piece that holds the end token. Repeated
rows are packed as often as they occur. An empty table gives an empty result. Columns
other than id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from smudgelex.llm.common import joined, materialized, table

CAPACITY = 2048
END = 0
# Words a worker remembers before it starts anew, and the longest remembered one.
CACHE_WORDS = 500_000
CACHE_CHARS = 64
ROWS = 512
# Pieces of one length that are ranked together, on average, where a length has more.
PART_ROWS = 20_000

# Characters whose class, case and normal form no version of Unicode will change; an
# apostrophe may begin a word of its own, and a less-than sign a special token.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIGNS = r"!-&(-/:;=-@\[-`{-~"
_BLANKS = r" \t\n\r\f\v"
_PLAIN = re.compile(f"[{_LETTERS}0-9{_SIGNS}{_BLANKS}]*")
_WORD = re.compile(f"[{_LETTERS}]+|[0-9]|[{_SIGNS}]+")
_CHUNK = re.compile(f"[^{_BLANKS}]+")

Group = tuple[tuple[int, ...], int]


@lru_cache(maxsize=2)
def tokenizer_of(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


class Words:
    """Token ids of a text as little-endian bytes.

    The tokenizer's normal form and pattern never look across ASCII white space and
    drop it, so a text is the chain of its chunks. Chunks of plain characters are cut
    here as the tokenizer would cut them. Most words recur and are remembered.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer_of(path)
        self.ids: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _cut(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return _WORD.findall(text.lower())
        out = []
        for chunk in _CHUNK.findall(text):
            out += _WORD.findall(chunk.lower()) if _PLAIN.fullmatch(chunk) else [chunk]
        return out

    def _learn(self, words: list[str]) -> None:
        """Words go through the tokenizer as one text, since each of them ends in a
        token that ends a word; a chunk that is not plain goes through it by itself."""
        plain = [w for w in words if _PLAIN.fullmatch(w)]
        ids = np.array(self.tokenizer.encode(" ".join(plain), add_special_tokens=False).ids, dtype="<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(plain):
            raise ValueError("the tokenizer cuts words in another way")
        stops = (ends * 4).tolist()
        self.ids.update(zip(plain, map(ids.tobytes().__getitem__, map(slice, [0, *stops], stops)), strict=True))
        if len(plain) < len(words):
            other = [w for w in words if not _PLAIN.fullmatch(w)]
            found = self.tokenizer.encode_batch(other, add_special_tokens=False)
            for chunk, one in zip(other, found, strict=True):
                self.ids[chunk] = np.array(one.ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self._cut(t) for t in texts]
        if len(self.ids) > CACHE_WORDS:
            self.ids.clear()
        new = set().union(*cut).difference(self.ids)
        if new:
            self._learn(list(new))
        out = [b"".join(map(self.ids.__getitem__, words)) for words in cut]
        for word in new:
            if len(word) > CACHE_CHARS:
                del self.ids[word]
        return out


def tokenized_pieces(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32[, ids])``: tokens and the end token, cut
    into pieces of ``capacity``; ``ids`` are unsigned 32-bit little-endian numbers."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    rows = df.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    names = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    width = 4 * capacity
    end = np.array([END], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                of, pieces, starts, sizes, crcs, blobs = [], [], [], [], [], []
                for row, ids in enumerate(words.encode(part.column(1).to_pylist())):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), width)):
                        blob = ids[at : at + width]
                        of.append(row)
                        pieces.append(piece)
                        starts.append(at // 4)
                        sizes.append(len(blob) // 4)
                        crcs.append(zlib.crc32(blob))
                        if with_ids:
                            blobs.append(blob)
                columns = [
                    part.column(0).take(pa.array(of, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    *[pa.array(x, pa.int64()) for x in (starts, sizes, crcs)],
                    *[pa.array(blobs, pa.binary())] * with_ids,
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    out = rows.mapInArrow(cut, schema + ", ids binary" * with_ids)
    return out.withColumnRenamed("id", id)


def _largest(lengths: list[int], most: int) -> int:
    """Index of the largest length up to ``most``, or -1."""
    return bisect_left(lengths, most + 1) - 1


def dominating_groups(counts: dict[int, int], capacity: int) -> tuple[list[Group], dict[int, int]]:
    """Groups that some best packing holds, and the lengths left over.

    From the longest down, ``w`` with room ``r``: alone if nothing fits; with its exact
    complement; with the largest that fits, if no two others fit, or if no two others
    that fit together exceed it; with the largest and the largest beside it, if at most
    two fit and no two others beat the smaller of them.
    """
    left = dict(counts)
    lengths = sorted(left)  # those with pieces left
    fixed: list[Group] = []

    def take(group: tuple[int, ...], copies: int) -> None:
        fixed.append((group, copies))
        for w in group:
            left[w] -= copies
        for w in set(group):
            if not left[w]:
                del lengths[bisect_left(lengths, w)]

    def smallest(n: int, but: int) -> list[int]:
        """The n smallest pieces besides one of length ``but``."""
        out: list[int] = []
        for w in lengths:
            out += [w] * min(n - len(out), left[w] - (w == but))
            if len(out) >= n:
                break
        return out

    def copies_of(group: tuple[int, ...]) -> int:
        return min(left[w] // group.count(w) for w in set(group))

    def best(w: int) -> tuple[int, ...] | None:
        room = capacity - w
        low = smallest(3, w)
        if not low or low[0] > room:
            return (w,)
        k = _largest(lengths, room)
        if lengths[k] == w and left[w] == 1:
            k -= 1
        top = lengths[k]
        if top == room or len(low) < 2 or low[0] + low[1] > room:
            return (w, top)
        if len(low) < 3 or sum(low) > room:
            # At most two more fit; compare with every pair by its larger member.
            others = {x: left[x] - (x == w) for x in lengths if x <= room - low[0]}
            keys = sorted(x for x, n in others.items() if n > 0)
            pair_sum, pair_low = 0, 0
            for a in keys:
                j = _largest(keys, room - a)
                while j >= 0 and (keys[j] > a or keys[j] == a and others[a] < 2):
                    j = _largest(keys, a) if keys[j] > a else j - 1
                if j >= 0:
                    pair_sum, pair_low = max(pair_sum, a + keys[j]), max(pair_low, keys[j])
            if pair_sum <= top:
                return (w, top)
            j = _largest(keys, room - top)
            while j >= 0 and keys[j] == top and others[top] < 2:
                j -= 1
            if j >= 0 and keys[j] <= top and keys[j] >= pair_low:
                return (w, top, keys[j])
        return None

    # Lengths that stay unfixed remain partners for the smaller ones.
    bound = capacity + 1
    while (k := _largest(lengths, bound - 1)) >= 0:
        w = lengths[k]
        group = best(w)
        if group is None:
            bound = w
        else:
            # Taking pieces away only removes alternatives, so all copies follow.
            take(group, copies_of(group))
    return fixed, {w: left[w] for w in lengths}


def best_fit_groups(counts: dict[int, int], capacity: int) -> list[Group]:
    """Best fit, longest first, many equal sequences at a time."""
    rooms: list[int] = []
    open_groups: dict[int, list[list]] = {}
    done: list[Group] = []

    def put(group: tuple[int, ...], copies: int, room: int) -> None:
        if not copies:
            return
        if not room:
            done.append((group, copies))
            return
        if room not in open_groups:
            insort(rooms, room)
            open_groups[room] = []
        open_groups[room].append([group, copies])

    for w in sorted(counts, reverse=True):
        c = counts[w]
        while c:
            k = bisect_left(rooms, w)
            if k == len(rooms):
                group, copies, room = (), -(-c // (capacity // w)), capacity
            else:
                room = rooms[k]
                group, copies = open_groups[room].pop()
                if not open_groups[room]:
                    del open_groups[room], rooms[k]
            each = room // w
            full = min(copies, c // each)
            c -= full * each
            put(group + (w,) * each, full, room - each * w)
            copies -= full
            if copies and c:
                put(group + (w,) * c, 1, room - c * w)
                copies -= 1
                c = 0
            if group:
                put(group, copies, room)
    return done + [(g, n) for groups in open_groups.values() for g, n in groups]


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Groups of lengths and how many sequences hold each."""
    fixed, rest = dominating_groups(counts, capacity)
    return fixed + best_fit_groups(rest, capacity)


def _places(plan: list[Group]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: rank from which a place serves, its first sequence, its offset."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    given: dict[int, int] = {}
    first = 0
    for group, copies in plan:
        offset = 0
        for w in group:
            slots.setdefault(w, []).append((given.get(w, 0), first, offset))
            given[w] = given.get(w, 0) + copies
            offset += w
        first += copies
    return {w: tuple(np.array(x, dtype=np.int64) for x in zip(*s, strict=True)) for w, s in slots.items()}


def pack_pieces(pieces: DataFrame, id: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a finished table of pieces.

    ``pieces`` has a ``length`` from 1 to ``capacity``; it is read three times.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = _places(packing_plan(counts, capacity))
    order = [id, "piece", "start", "ids_crc32"]
    # One row for each length, so at most ``capacity``; only a length with many pieces has
    # several parts, which keeps the table of ranks at a row per PART_ROWS pieces.
    parts = [(w, n // PART_ROWS + 1) for w, n in sorted(counts.items())]
    parts = pieces.sparkSession.createDataFrame(parts, "length bigint, _parts bigint")
    rows = pieces.join(F.broadcast(parts), "length")
    part = F.pmod(F.xxhash64(id, "piece"), F.col("_parts"))
    rows = rows.select(*pieces.columns, part.alias("_part"))
    sizes = rows.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_part")) - F.col("_n")
    sizes = materialized(sizes.select("length", "_part", before.alias("_before")))
    within = F.row_number().over(Window.partitionBy("length", "_part").orderBy(*order))
    rows = joined(rows.select("*", within.alias("_row")), sizes, ["length", "_part"])
    rank = (F.col("_before") + F.col("_row") - 1).alias("_rank")
    rows = rows.select(*pieces.columns, rank)

    def place(batches):
        for batch in batches:
            sequence = np.zeros(len(batch), dtype=np.int64)
            offset = np.zeros(len(batch), dtype=np.int64)
            ranks = batch["_rank"].to_numpy()
            for w, rows_of in batch.groupby("length").indices.items():
                starts, firsts, offsets = places[w]
                slot = np.searchsorted(starts, ranks[rows_of], side="right") - 1
                sequence[rows_of] = firsts[slot] + ranks[rows_of] - starts[slot]
                offset[rows_of] = offsets[slot]
            yield batch.drop(columns="_rank").assign(sequence_id=sequence, offset=offset)

    kinds = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes)
    return rows.mapInPandas(place, f"{kinds}, sequence_id bigint, offset bigint")


def pack_documents(
    df: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32, sequence_id, offset)``."""
    pieces = materialized(tokenized_pieces(df, id, text, path, capacity))
    return pack_pieces(pieces, id, capacity)


def op6_best_fit_packing(spark, sf):
    return pack_documents(table(spark, sf, "documents"))
