"""Token counts over a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smudgelex.functions.tokens import word_array
from smudgelex.plans.scan import spread


def build_lexicon(tokens: DataFrame) -> DataFrame:
    """``(token, n)`` of any table with a ``token`` column; empty tokens are skipped.

    Counts are combined before the shuffle, so a word that makes up a third of all
    tokens reaches the reducer as one row per map task.
    """
    words = tokens.select("token").where(F.length("token") > 0)
    return words.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def words_of(
    df: DataFrame, text: str = "text", markup: str = "none", numeric: str = "drop"
) -> DataFrame:
    """``(token)``: every TEXT and SYMBOL token, without its place. The columns that
    number positions and phrases are not computed at all."""
    words = F.explode(word_array(text, markup, numeric)).alias("token")
    return spread(df.select(text)).select(words)


def lexicon_of(
    df: DataFrame, text: str = "text", markup: str = "none", numeric: str = "drop"
) -> DataFrame:
    """The lexicon straight from the text."""
    return build_lexicon(words_of(df, text, markup, numeric))


def documents_per_source(df: DataFrame, source: str = "source") -> DataFrame:
    """``(source, n_docs)``."""
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("n_docs"))
