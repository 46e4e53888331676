"""Byte-level BPE, exact and in linear time, by backtracking from longest matches.

A piece of text is laid out from left to right with the longest vocabulary entries that
an Aho-Corasick automaton finds (bytes mapped to Latin-1). Two neighbours are
compatible if merging in rank order would never have joined bytes across their border;
that answer depends on the two tokens alone and is memoised. Where the longest entry is
not compatible with the token before it, shorter ones are tried, and at a dead end the
last token is taken back. Positions known to be dead ends are remembered, so each is
left at most once.

Tasks work on Arrow batches; nothing is shuffled. The vocabulary is read from a path on
every worker. Null texts count as empty, and an empty text has no tokens. Repeated rows
give repeated results; columns other than id and text are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smudgelex.llm.common import table

# Pieces remembered by a worker before it starts anew, and the longest remembered one.
CACHE_PIECES = 500_000
CACHE_CHARS = 64
# Rows handed back at a time, so that a batch of long texts stays small.
ROWS = 256


class Merges:
    """The ranks of a vocabulary: lower ranks merge first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.joins: dict[tuple[int, int], int] = {}
        # The two tokens that were merged into a token; a byte has none.
        self.halves: dict[int, tuple[int, int]] = {}
        self.known: dict[tuple[int, int], bool] = {}
        for rank in sorted(self.tokens):
            self._find_halves(rank)
        self.known.clear()
        # The longest shorter entry with which an entry begins.
        self.shorter = {r: self._shorter(t) for r, t in self.tokens.items()}

    def _find_halves(self, rank: int) -> None:
        token = self.tokens[rank]
        for cut in range(len(token) - 1, 0, -1):
            left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
            if left is None or right is None or max(left, right) >= rank:
                continue
            if self._stays_apart(left, right):
                self.joins[left, right] = rank
                self.halves[rank] = (left, right)
                return

    def _shorter(self, token: bytes) -> int | None:
        for cut in range(len(token) - 1, 0, -1):
            if (rank := self.ranks.get(token[:cut])) is not None:
                return rank
        return None

    def _stays_apart(self, left: int, right: int) -> bool:
        """Undo the later of both tokens' merges, step by step, and see whether a
        merge across the border would have come before it."""
        limit = len(self.tokens) + 1 << 32
        while True:
            across = self.joins.get((left, right))
            if across is not None and across < limit:
                return False
            undo_left = left in self.halves and (left > right or right not in self.halves)
            if undo_left:
                limit, left = left, self.halves[left][1]
            elif right in self.halves:
                # At equal rank the merge further left came first.
                limit, right = right + 1, self.halves[right][0]
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        pair = (left, right)
        answer = self.known.get(pair)
        if answer is None:
            if len(self.known) > 2_000_000:
                self.known.clear()
            answer = self.known[pair] = self._stays_apart(left, right)
        return answer

    def encode(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        longest: list[int | None] = [None] * len(piece)
        for end, (size, rank) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - size + 1] = rank  # ends rise, so the last is the longest
        tokens, shorter, known = self.tokens, self.shorter, self.known
        dead = bytearray(len(piece) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < len(piece):
            while token is not None:
                to = at + len(tokens[token])
                if not dead[to]:
                    if not out:
                        break
                    answer = known.get((out[-1], token))
                    if answer is None:
                        answer = self.compatible(out[-1], token)
                    if answer:
                        break
                token = shorter[token]
            if token is not None:
                out.append(token)
                at = to
                token = longest[at] if at < len(piece) else None
            else:
                if not out:
                    raise ValueError("the vocabulary cannot spell this text")
                dead[at] = 1
                token = out.pop()
                at -= len(tokens[token])
                token = shorter[token]
        return out


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


@lru_cache(maxsize=2)
def merges_of(path: str) -> Merges:
    return Merges(_ranks(path))


@lru_cache(maxsize=2)
def spelling_of(path: str) -> list[bytes]:
    """The bytes of every id, none for an id that the vocabulary leaves out."""
    tokens = {rank: token for token, rank in _ranks(path).items()}
    return [tokens.get(i, b"") for i in range(max(tokens) + 1)]


class _Pieces(dict):
    """Token ids of a piece, worked out when first asked for."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges

    def __missing__(self, piece: str) -> tuple[int, ...]:
        found = tuple(self.merges.encode(piece.encode()))
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = found
        return found


@lru_cache(maxsize=1)
def pieces_of(path: str) -> _Pieces:
    """What a worker remembers from task to task."""
    return _Pieces(merges_of(path))


def encode_texts(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``(id, ids)``, the token ids of every whole text in order."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = df.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        cut = regex.compile(pattern).findall
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                ids = [
                    np.fromiter(chain.from_iterable(map(pieces.__getitem__, cut(t))), dtype=np.int32)
                    for t in part.column(1).to_pylist()
                ]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(ends, np.concatenate(ids))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["id", "ids"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(encode, f"id {kind}, ids array<int>")
    return out.withColumnRenamed("id", id)


def decode_ids(df: DataFrame, id: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """``(id, ids, bytes)``; null ids decode to no bytes."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = df.select(F.col(id).alias("id"), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = spelling_of(path).__getitem__
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                lists = part.column(1)
                flat = lists.flatten().to_numpy().tolist()
                ends = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
                texts = [b"".join(map(token, flat[a:b])) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                decoded = pa.array(texts, pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), lists, decoded], names=["id", "ids", "bytes"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(decode, f"id {kind}, ids array<int>, bytes binary")
    return out.withColumnRenamed("id", id)


def op7_byte_bpe(spark, sf):
    decoded = decode_ids(encode_texts(table(spark, sf, "documents")))
    spelled = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(spelled.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
