"""Look tokens up in the names, dictionary and places tables.

Each table is asked in turn and the first that has the token decides. That order
becomes a rank: the three tables are merged to one row per key with the smallest
rank, and one equi-join answers all three questions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smudgelex.plans.storage import BROADCAST_BYTES, fits_broadcast, materialized

# Kinds in the order in which the tables are asked.
KINDS = ("names", "dict", "geo")
MISSING = "missing"
COLLATIONS = ("ignore_case", "exact", "ignore_accents")
# Words that are looked up apart when occurrences are joined by shuffle, and the words
# the sketch that finds them keeps track of; a word that is not among them has at most
# one of HEAVY occurrences.
HEAVY = 1000
_TRACKED = 10_000


def lookup_key(word: Column | str, collation: str = "ignore_case") -> Column:
    """What two words must share to be equal.

    ``ignore_accents`` compares letters alone, as a general collation of a database
    does: without case, accents and width, by the root collation of Unicode.
    """
    if collation not in COLLATIONS:
        raise ValueError(f"collation must be one of {COLLATIONS}, not {collation!r}")
    word = F.col(word) if isinstance(word, str) else word
    if collation == "ignore_accents":
        return F.collate(F.rtrim(word), "UNICODE_CI_AI")
    return word if collation == "exact" else F.lower(F.rtrim(word))


def reference_keys(
    names: DataFrame,
    dict: DataFrame,
    geo: DataFrame,
    collation: str = "ignore_case",
    path: str | None = None,
) -> DataFrame:
    """``(key, kind)``, one row per key, from the first column of each table.

    The tables may repeat words.

    The result is written to the shared folder, so that every later join reads a
    finished table whose size can be measured; or to ``path``, where the caller may
    keep it and read it again with ``read_reference_keys``.
    """
    merged = None
    for rank, table in enumerate((names, dict, geo)):
        word = lookup_key(F.col(f"`{table.columns[0]}`"), collation)
        side = table.select(word.alias("key"), F.lit(rank).alias("rank"))
        merged = side if merged is None else merged.unionByName(side)
    keys = (
        merged.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.min("rank").alias("rank"))
    )
    kinds = F.array(*[F.lit(k) for k in KINDS])
    keys = keys.select("key", F.get(kinds, F.col("rank")).alias("kind"))
    if path is None:
        return materialized(keys)
    keys.write.mode("overwrite").parquet(path)
    return read_reference_keys(keys.sparkSession, path)


def read_reference_keys(spark: SparkSession, path: str) -> DataFrame:
    """Keys written by ``reference_keys``, built once and used by many jobs."""
    return spark.read.parquet(path)


def _with_key(df: DataFrame, collation: str) -> DataFrame:
    lookup = lookup_key("token", collation).alias("key")
    return df.where(F.length("token") > 0).select("*", lookup)


def _lexicon_join(
    lexicon: DataFrame, keys: DataFrame, how: str, collation: str, limit: int
) -> DataFrame:
    """Both sides have one row per word, so no key is hot and a shuffle needs no
    salt; keys that are measured to fit save the lexicon the second shuffle."""
    side = F.broadcast(keys) if fits_broadcast(keys, "key", limit) else keys
    return _with_key(lexicon, collation).join(side, "key", how)


def tag_lexicon(
    lexicon: DataFrame,
    keys: DataFrame,
    collation: str = "ignore_case",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(token, n, kind)``; the kind of a word in no table is ``missing``."""
    joined = _lexicon_join(lexicon, keys, "left", collation, broadcast_bytes)
    kind = F.coalesce("kind", F.lit(MISSING)).alias("kind")
    return joined.select("token", "n", kind)


def missing_tokens(
    lexicon: DataFrame,
    keys: DataFrame,
    collation: str = "ignore_case",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Words found in none of the tables."""
    out = _lexicon_join(lexicon, keys, "left_anti", collation, broadcast_bytes)
    return out.select("token", "n")


def known_tokens(
    lexicon: DataFrame,
    keys: DataFrame,
    collation: str = "ignore_case",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Words found in at least one of the tables."""
    out = _lexicon_join(lexicon, keys, "left_semi", collation, broadcast_bytes)
    return out.select("token", "n")


def heavy_words(tokens: DataFrame, most: int = HEAVY) -> DataFrame:
    """``(token)``: the words that may be more than one in ``most`` of all tokens.

    A sketch of bounded size for each task, merged; no word is shuffled.
    """
    sketch = F.expr(f"approx_top_k(token, {most}, {max(_TRACKED, 4 * most)})")
    top = tokens.where(F.length("token") > 0).agg(sketch.alias("top"))
    return top.select(F.explode("top.item").alias("token"))


def tag_tokens(
    tokens: DataFrame,
    keys: DataFrame,
    collation: str = "ignore_case",
    broadcast_bytes: int = BROADCAST_BYTES,
    heavy: DataFrame | None = None,
    salts: int = 64,
) -> DataFrame:
    """The token table with a ``kind`` for every occurrence; empty tokens are skipped.

    Reference tables that are measured to fit are broadcast and the occurrences
    stay where they are. Larger ones are joined by shuffle, but for the ``heavy`` words:
    these are looked up first, at most ``HEAVY`` of them, and broadcast with their kinds.
    So a word that makes up a third of the corpus meets in no task, and no key is
    repeated. A caller that has counts can name the heavy words; otherwise a sketch finds
    them in a pass of its own. A stream has no such pass: without ``heavy`` each of its
    keys is repeated once per salt.
    """
    kind = F.coalesce("kind", F.lit(MISSING)).alias("kind")
    # The row stays together, so that no column of its own can clash with the lookup's.
    left = tokens.where(F.length("token") > 0).select(
        F.struct("*").alias("_row"), lookup_key("token", collation).alias("key")
    )
    if fits_broadcast(keys, "key", broadcast_bytes):
        return left.join(F.broadcast(keys), "key", "left").select("_row.*", kind)
    if heavy is None and tokens.isStreaming:
        return _salted_join(left, keys, salts).select("_row.*", kind)
    heavy = heavy_words(tokens) if heavy is None else heavy.select("token").distinct()
    known = _with_key(heavy, collation).join(keys, "key", "left")
    known = materialized(known.select(F.col("token").alias("_word"), F.struct("kind").alias("_known")))
    left = left.join(F.broadcast(known), F.col("_row.token") == F.col("_word"), "left")
    # Occurrences that are done match no key; they are dealt out evenly, by the row and
    # its partition, so that a retried task deals alike. Keys are compared with their
    # place, 0 for all that have to be looked up, as one value that is hashed whole.
    done = F.col("_known").isNotNull()
    place = F.xxhash64("_row", F.spark_partition_id()).bitwiseOR(F.lit(1))
    own = F.struct(F.when(~done, F.col("key")), F.when(done, place).otherwise(0))
    left = left.select("_row", "_known", own.alias("_key"))
    rest = keys.select(F.struct("key", F.lit(0).cast("bigint")).alias("_other"), "kind")
    match = F.col("_key") == F.col("_other")
    joined = left.join(rest, match, "left")
    found = F.when(done, F.col("_known.kind")).otherwise(F.col("kind"))
    return joined.select("_row.*", F.coalesce(found, F.lit(MISSING)).alias("kind"))


def _salted_join(left: DataFrame, keys: DataFrame, salts: int) -> DataFrame:
    # Derived from the row and its partition, not drawn, so that a retried task
    # deals alike; the partition keeps rows of equal content apart.
    place = F.xxhash64("_row", F.spark_partition_id())
    deal = F.pmod(place, F.lit(salts))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    salted = keys.select("*", F.explode(every).alias("salt"))
    return left.select("*", deal.alias("salt")).join(salted, ["key", "salt"], "left")


def of_kind(tagged: DataFrame, kind: str) -> DataFrame:
    return tagged.where(F.col("kind") == kind)


def kind_counts(tagged: DataFrame) -> DataFrame:
    """``(kind, n_words, n_tokens)``; a kind without words has a row of zeros."""
    counts = tagged.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_words"), F.sum("n").alias("n_tokens")
    )
    kinds = F.array(*[F.lit(k) for k in (*KINDS, MISSING)])
    all_kinds = tagged.sparkSession.range(1).select(F.explode(kinds).alias("kind"))
    zero = F.lit(0).cast("bigint")
    return all_kinds.join(counts, "kind", "left").select(
        "kind",
        F.coalesce("n_words", zero).alias("n_words"),
        F.coalesce("n_tokens", zero).alias("n_tokens"),
    )


def tokens_processed(tagged: DataFrame) -> DataFrame:
    """``(n_processed)``: all non-empty tokens looked up."""
    total = F.coalesce(F.sum("n"), F.lit(0).cast("bigint"))
    return tagged.agg(total.alias("n_processed"))
