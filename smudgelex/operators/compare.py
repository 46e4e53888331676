"""Compare token tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smudgelex.functions import tokens as t
from smudgelex.operators.tokenize import id_columns
from smudgelex.plans.scan import spread
from smudgelex.plans.storage import BROADCAST_BYTES, materialized

_DIGEST = ("_d0", "_d1", "_d2", "_d3")
# A block in a broadcast table, in bytes.
_BLOCK_COST = 160


def same_token(left: Column, right: Column) -> Column:
    """Type and text agree, whatever the position. A NULL-type left side always does.

    Both sides are structs with ``type`` and ``token``.
    """
    agree = left["type"].eqNullSafe(right["type"]) & left["token"].eqNullSafe(
        right["token"]
    )
    return F.coalesce(left["type"] == "NULL", F.lit(False)) | agree


def same_token_and_position(left: Column, right: Column) -> Column:
    return same_token(left, right) & left["position"].eqNullSafe(right["position"])


def reconcile(
    left: DataFrame, right: DataFrame, id: str | Sequence[str] = "doc_id"
) -> DataFrame:
    """Rows where two token tables differ, or where only one has a token."""
    on = [*id_columns(id), "position"]
    a = left.select(*on, F.struct("type", "token").alias("a"))
    b = right.select(*on, F.struct("type", "token").alias("b"))
    both = a.join(b, on, "full_outer")
    return both.where(~same_token(F.col("a"), F.col("b"))).select(
        *on,
        F.col("a.token").alias("left_token"),
        F.col("a.type").alias("left_type"),
        F.col("b.token").alias("right_token"),
        F.col("b.type").alias("right_type"),
    )


def reconcile_readings(
    df: DataFrame,
    left: dict,
    right: dict,
    id: str | Sequence[str] = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``reconcile`` for two readings of one text, given by their options ``markup``,
    ``numeric`` and ``tags``: compared inside the row, without a join or a shuffle."""
    on = id_columns(id)
    sides = [_options(**options) for options in (left, right)]
    # Passes that both readings share run once.
    shared = list(dict.fromkeys((markup, tags) for markup, _, tags, _ in sides))
    texts = [t.prepared(text, *options).alias(f"_text{i}") for i, options in enumerate(shared)]
    rows = spread(df.select(*on, text)).select(*on, *texts)
    read = []
    for name, (markup, numeric, tags, _) in zip(("_left", "_right"), sides, strict=True):
        prepared = F.col(f"_text{shared.index((markup, tags))}")
        read.append(t.rewritten(prepared, markup, numeric, tags).alias(name))
    rows = rows.select(*on, *read)
    a, b = (t.marked_words(F.col(n), s[3]).alias(k) for n, k, s in zip(("_left", "_right"), "ab", sides, strict=True))
    # Most pairs agree, so they are left out before any becomes a row; most texts do, too.
    placed = F.transform(F.arrays_zip(a, b), lambda p, i: F.struct(i.alias("pos"), p["a"].alias("a"), p["b"].alias("b")))
    agree = lambda p: F.coalesce(p["a"] == t.c.FINAL, F.lit(False)) | p["a"].eqNullSafe(p["b"])
    apart = F.filter(placed, lambda p: ~agree(p))
    if sides[0][3] == sides[1][3]:
        apart = F.when(F.col("_left") != F.col("_right"), apart)
    rows = rows.select(*on, F.explode(apart).alias("_pair"))
    left_token, left_type = t.marked_token(F.col("_pair.a"))
    right_token, right_type = t.marked_token(F.col("_pair.b"))
    return rows.select(
        *on,
        (F.col("_pair.pos") + 1).alias("position"),
        left_token.alias("left_token"),
        left_type.alias("left_type"),
        right_token.alias("right_token"),
        right_type.alias("right_type"),
    )


def _options(
    markup: str = "none", numeric: str = "drop", tags: bool = False, final: bool = False
) -> tuple[str, str, bool, bool]:
    return markup, numeric, tags, final


def different_places(
    left: DataFrame, right: DataFrame, id: str | Sequence[str] = "doc_id"
) -> DataFrame:
    """Tokens of ``left`` that ``right`` does not have at the same position.

    Only blocks of 1,024 positions that differ, by a digest of 128 bits, are joined. Where
    these are too many to broadcast, all rows are.
    """
    on = id_columns(id)
    keys = [*on, "position", "token", "type"]
    left, right = left.select(*keys), right.select(*keys)
    # Blocks of positions with the same rows on both sides need no look at their rows. A
    # row with a null matches none, so its block is never the same.
    here, there = (_block_digests(side, on) for side in (left, right))
    same = [*on, "_block", "_nulls", "_n", *_DIGEST]
    apart = materialized(here.join(there.where("_nulls = 0"), same, "left_anti").select(*on, "_block"))
    if apart.count() <= BROADCAST_BYTES // _BLOCK_COST:
        left, right = (_of_blocks(side, apart, on) for side in (left, right))
    return left.join(right, keys, "left_anti")


def _block() -> Column:
    return F.shiftright(F.col("position").cast("bigint"), 10)


def _block_digests(tokens: DataFrame, on: list[str]) -> DataFrame:
    """Rows, rows with a null and a digest of 128 bits, whatever the order of the rows, of
    each block of positions. All are sums, so a task combines its rows before the shuffle."""
    row = [*on, "position", "token", "type"]
    some_null = F.greatest(*[F.col(c).isNull().cast("int") for c in row])
    rows = tokens.select(
        *on,
        _block().alias("_block"),
        some_null.alias("_null"),
        F.xxhash64(*row).alias("_a"),
        F.xxhash64(F.lit(1), *row).alias("_b"),
    )
    # Halves, since a sum of whole hashes overflows.
    halves = [h for c in ("_a", "_b") for h in (F.shiftright(c, 32), F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)))]
    return rows.groupBy(*on, "_block").agg(
        F.sum("_null").alias("_nulls"),
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(h).alias(name) for h, name in zip(halves, _DIGEST, strict=True)],
    )


def _of_blocks(tokens: DataFrame, blocks: DataFrame, on: list[str]) -> DataFrame:
    few = F.broadcast(blocks.select(*[F.col(c).alias(f"_of{i}") for i, c in enumerate([*on, "_block"])]))
    places = [*[tokens[c] for c in on], _block()]
    equal = [p.eqNullSafe(F.col(f"_of{i}")) for i, p in enumerate(places)]
    return tokens.join(few, reduce(and_, equal), "left_semi")
