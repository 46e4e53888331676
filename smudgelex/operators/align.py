"""Compare two readings of a text by alignment.

By position alone one lost token marks all that follow. Here the two token sequences of
a row are aligned by a longest common subsequence, so a token that only one side has is
one difference, and what follows is compared with its counterpart.

The subsequence is exact: its length is computed with one bit per token of the longer
side in Python's integers, 64 pairs of tokens in one step, and a split of one side in
halves finds the way in memory that grows with the tokens, not with their product.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smudgelex.functions.tokens import token_array
from smudgelex.operators.tokenize import id_columns
from smudgelex.plans.scan import spread
from smudgelex.plans.workers import ship

# Sides of so many pairs of tokens are aligned with all states kept.
_KEPT = 1 << 24
ROWS = 64


def _states(a: Sequence[Hashable], b: Sequence[Hashable]) -> Iterator[int]:
    """For every prefix of ``a`` a number whose bit j is 0 where the common subsequence
    with ``b`` grows from j to j + 1 tokens."""
    places: dict[Hashable, int] = {}
    for j, token in enumerate(b):
        places[token] = places.get(token, 0) | 1 << j
    full = (1 << len(b)) - 1
    state = full
    for token in a:
        hit = state & places.get(token, 0)
        state = ((state + hit) | (state - hit)) & full
        yield state


def _lengths(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[int]:
    """Lengths of the common subsequences of ``a`` and every prefix of ``b``."""
    state = (1 << len(b)) - 1
    for state in _states(a, b):
        pass
    out = [0]
    for bit in bin(state | 1 << len(b))[:2:-1]:
        out.append(out[-1] + (bit == "0"))
    return out


def common(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence in both."""
    found: list[tuple[int, int]] = []
    # Parts still to align, the first one on top.
    work = [(0, len(a), 0, len(b))]
    while work:
        i, m, j, n = work.pop()
        while i < m and j < n and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        same = 0
        while i < m - same and j < n - same and a[m - same - 1] == b[n - same - 1]:
            same += 1
        if same:
            work.append((m - same, m, n - same, n))
            m, n = m - same, n - same
        if i == m or j == n:
            continue
        if (m - i) * (n - j) <= _KEPT or m - i == 1:
            found.extend((i + x, j + y) for x, y in _traced(a[i:m], b[j:n]))
            continue
        middle = (i + m) // 2
        head = _lengths(a[i:middle], b[j:n])
        tail = _lengths(a[middle:m][::-1], b[j:n][::-1])[::-1]
        at = max(range(len(head)), key=lambda k: head[k] + tail[k])
        work.append((middle, m, j + at, n))
        work.append((i, middle, j, j + at))
    return found


def _traced(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[tuple[int, int]]:
    states = [(1 << len(b)) - 1, *_states(a, b)]
    found, j = [], len(b)
    for i in range(len(a), 0, -1):
        # The length grows at j - 1 in this state; if it did before, row i is not needed.
        while j and states[i] >> (j - 1) & 1:
            j -= 1
        if not j:
            break
        if states[i - 1] >> (j - 1) & 1:
            found.append((i - 1, j - 1))
            j -= 1
    return found[::-1]


def differences(a: Sequence[Hashable], b: Sequence[Hashable]) -> Iterator[tuple[int | None, int | None]]:
    """Places outside the common subsequence, in order; those of one gap stand side by
    side as far as both sides have some."""
    i = j = 0
    for x, y in [*common(a, b), (len(a), len(b))]:
        for k in range(max(x - i, y - j)):
            yield (i + k if i + k < x else None), (j + k if j + k < y else None)
        i, j = x + 1, y + 1


def align_readings(
    df: DataFrame,
    left: dict,
    right: dict,
    id: str | Sequence[str] = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(id…, left_position, left_token, left_type, right_position, right_token,
    right_type)``: the least differences between two readings of a text, given by their
    options ``markup``, ``numeric`` and ``tags``.

    A token that only one side has leaves the other side null. Texts stay in their rows;
    nothing is shuffled.
    """
    ship(df.sparkSession)
    on = id_columns(id)
    sides = [token_array(text, **options) for options in (left, right)]
    columns = [s[f].alias(f"{side}_{f}") for side, s in zip("ab", sides) for f in ("token", "type")]
    rows = spread(df.select(*on, text)).select(*on, *columns)
    kinds = [f"`{c}` {t}" for c, t in df.select(*on).dtypes]
    names = [f"{side}_{f}" for side in ("left", "right") for f in ("position", "token", "type")]
    kinds += [f"{c} {'int' if c.endswith('position') else 'string'}" for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                row, out = [], [[] for _ in names]
                tokens = [c.to_pylist() for c in part.columns[len(on) :]]
                for at, (a, a_types, b, b_types) in enumerate(zip(*tokens, strict=True)):
                    one, other = list(zip(a, a_types)), list(zip(b, b_types))
                    for i, j in differences(one, other):
                        row.append(at)
                        values = (None,) * 3 if i is None else (i + 1, *one[i])
                        values += (None,) * 3 if j is None else (j + 1, *other[j])
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
                ids = [part.column(k).take(pa.array(row, pa.int64())) for k in range(len(on))]
                arrays = [pa.array(c, pa.int32() if n.endswith("position") else pa.string()) for c, n in zip(out, names)]
                yield pa.RecordBatch.from_arrays([*ids, *arrays], names=[*on, *names])

    return rows.mapInArrow(run, ", ".join(kinds))


def difference_counts(aligned: DataFrame, id: str | Sequence[str] = "doc_id") -> DataFrame:
    """``(id…, n_left, n_right)``: tokens that are not on the other side, of texts that
    have any."""
    return aligned.groupBy(*id_columns(id)).agg(
        F.count("left_position").alias("n_left"), F.count("right_position").alias("n_right")
    )
