"""Helpers that several operators share."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import TypeVar

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smudgelex.plans.storage import materialized
from smudgelex.plans.workers import ship

__all__ = ["fitted", "joined", "let", "materialized", "ship", "slices", "table"]

# A side is broadcast only while its measured size stays below this.
BROADCAST_BYTES = 32 * 1024 * 1024
# Keys that a join spreads, and keys that the sketch which finds them keeps count of.
HEAVY_KEYS = 1000
TRACKED_KEYS = 8192
# Text that a fit may see.
SAMPLE_BYTES = 48 * 1024 * 1024

T = TypeVar("T")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: int, rows: int = 2048, size: int = 4 * 1024 * 1024) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most ``rows`` rows and ``size`` bytes of ``column``, or one
    row that is longer."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for at, length in enumerate(lengths.tolist()):
        if at > start and (at - start >= rows or held + length > size):
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += length
    if start < batch.num_rows:
        yield batch.slice(start)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def joined(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    limit: int = BROADCAST_BYTES,
    salts: int = 32,
) -> DataFrame:
    """Equi-join a large table with a finished one that has one row per key.

    The right side is measured and broadcast when it fits. Otherwise a sketch of bounded
    size finds the ``HEAVY_KEYS`` most frequent keys of the left side, in a pass over its
    keys: their rows are spread over ``salts`` tasks and only their right rows repeated.
    Null keys match null keys.
    """
    width = 16 + 8 * len(right.columns)
    texts = [F.octet_length(c) for c, t in right.dtypes if t in ("string", "binary")]
    cost = F.lit(width)
    for part in texts:
        cost = cost + F.coalesce(part, F.lit(0))
    size = right.agg(F.coalesce(F.sum(2 * cost), F.lit(0)).alias("size")).first()["size"]
    names = {k: f"_key_{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    match = F.lit(True)
    for k, other in names.items():
        match = match & F.col(k).eqNullSafe(F.col(other))
    if size <= limit:
        return left.join(F.broadcast(right), match, how).drop(*names.values())
    hashed = left.select(F.xxhash64(*keys).alias("_hash"))
    top = hashed.agg(F.expr(f"approx_top_k(_hash, {HEAVY_KEYS}, {TRACKED_KEYS})").alias("top")).first()["top"]
    heavy = [r["item"] for r in top or []]
    place = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int")
    left = left.withColumn("_salt", F.when(F.xxhash64(*keys).isin(heavy), place).otherwise(0))
    every = F.when(F.xxhash64(*names.values()).isin(heavy), F.sequence(F.lit(0), F.lit(salts - 1)))
    every = F.explode(F.coalesce(every, F.array(F.lit(0)))).alias("_salt_r")
    match = match & (F.col("_salt") == F.col("_salt_r"))
    out = left.join(right.select("*", every), match, how)
    return out.drop("_salt", "_salt_r", *names.values())


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learned: Callable[[Column], Column],
    fit: Callable[[list[tuple[str, int]]], T],
    per_class: int,
    most_bytes: int = SAMPLE_BYTES,
) -> T:
    """What ``fit`` makes of whole texts and labels, in one task.

    It sees at most ``per_class`` rows of each label and ``most_bytes`` of text: rows
    whose id ``learned`` admits, taken in the order of a hash of the id, so the sample
    does not depend on the partitions. Null labels and texts are left out. Texts do not
    pass through the driver, which gets the model alone.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label"))
    known = known.where(learned(F.col("_id")) & F.col("_label").isin(0, 1)).distinct()
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("_label") == value)
        part = part.orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most twice ``per_class`` rows of two numbers.
    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text"))
    found = rows.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    found = found.select("_id", "_label", "_text", F.xxhash64("_id").alias("_place")).distinct()
    # An id that is repeated with other texts cannot exceed the bounds either.
    order = ["_place", "_id", "_text", "_label"]
    sizes = found.select("_place", "_id", F.md5("_text").alias("_digest"), "_label", F.octet_length("_text").alias("_size"))
    sizes = sizes.orderBy("_place", "_id", "_digest", "_label").limit(2 * per_class)
    so_far = F.sum("_size").over(Window.orderBy("_place", "_id", "_digest", "_label"))
    fitting = sizes.withColumn("_so_far", so_far).where(F.col("_so_far") <= most_bytes).select("_id", "_digest", "_label")
    found = found.withColumn("_digest", F.md5("_text")).join(F.broadcast(fitting), ["_id", "_digest", "_label"], "left_semi")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(order[:2] + order[3:] + ["_digest"])
        sample = [(t, int(y)) for t, y in zip(group["_text"], group["_label"], strict=True)]
        return pd.DataFrame({"model": [pickle.dumps(fit(sample))]})

    models = found.groupBy(F.lit(0).alias("one")).applyInPandas(run, "model binary").collect()
    return pickle.loads(models[0]["model"]) if models else fit([])
