"""Words of many texts at once, as arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_RANDOM = np.random.default_rng(20240607)
# An odd number for every place in a word and a number for every byte.
_LETTER = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_PLACE = _RANDOM.integers(0, 2**64, 4096, dtype=np.uint64) | np.uint64(1)

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts, a line end behind each
    word_of: np.ndarray  # by byte: the last word begun, -1 before the first
    starts: np.ndarray  # by word: its first byte
    doc: np.ndarray  # by word: its text
    doc_ends: np.ndarray  # by text: its end in ``data``, without the line end

    def counts(self, texts: int) -> np.ndarray:
        return np.bincount(self.doc, minlength=texts)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the word (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(texts: list[str]) -> Words:
    blobs = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*blobs, b""]), dtype=np.uint8)
    ends = np.cumsum([len(b) + 1 for b in blobs], dtype=np.int64) - 1 if blobs else np.zeros(0, np.int64)
    blank = _BLANK[data]
    first = ~blank
    first[1:] &= blank[:-1]
    starts = np.flatnonzero(first)
    word_of = np.cumsum(first, dtype=np.int64) - 1
    return Words(data, word_of, starts, np.searchsorted(ends, starts, side="right"), ends)


def word_hashes(words: Words, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each word; ASCII capitals count as small letters if folded."""
    if not len(words.starts):
        return np.zeros(0, dtype=np.uint64)
    body = words.data[words.starts[0] :]
    if fold:
        body = _LOWER[body]
    place = np.arange(words.starts[0], len(words.data)) - words.starts[words.word_of[words.starts[0] :]]
    value = _LETTER[body] * _PLACE[place % len(_PLACE)] + (place // len(_PLACE)).astype(np.uint64)
    value[_BLANK[body]] = 0
    return mix(np.add.reduceat(value, words.starts - words.starts[0]))


def window_hashes(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside a text, and the text of each."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=doc.dtype)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    inside = doc[:n] == doc[size - 1 :]
    return mix(out[inside]), doc[:n][inside]
