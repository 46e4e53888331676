"""The two batch jobs and the report on top of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from smudgelex.operators.lexicon import build_lexicon, lexicon_of
from smudgelex.operators.tag import kind_counts, tag_lexicon
from smudgelex.operators.tokenize import of_type, tokenize
from smudgelex.sources.corpus import DEFAULT_PATTERN, read_corpus, well_formed
from smudgelex.sources.sinks import write_missing, write_tokens
from smudgelex.sources.tables import read_lexicon


def print_tokens(
    spark: SparkSession,
    root: str,
    output: str,
    pattern: str = DEFAULT_PATTERN,
    numeric: str = "drop",
    with_final: bool = False,
) -> None:
    """Directory of SGML files to token files. One stage, no shuffle.

    ``with_final`` writes a blank line behind each document.
    """
    documents = well_formed(read_corpus(spark, root, pattern))
    tokens = tokenize(documents, markup="trec", numeric=numeric, with_final=with_final)
    write_tokens(of_type(tokens, "TEXT", "SYMBOL", "NULL"), output)


def tag_words(
    spark: SparkSession,
    lexicon_path: str,
    keys: DataFrame,
    output: str,
    collation: str = "ignore_case",
) -> DataFrame:
    """Token files to the file of words found in no reference table.

    Returns the tagged lexicon.
    """
    tagged = tag_lexicon(build_lexicon(read_lexicon(spark, lexicon_path)), keys, collation)
    write_missing(tagged, output)
    return tagged


def corpus_report(
    documents: DataFrame,
    keys: DataFrame,
    text: str = "text",
    markup: str = "none",
    numeric: str = "drop",
) -> DataFrame:
    """Documents to word and token counts per kind."""
    return kind_counts(tag_lexicon(lexicon_of(documents, text, markup, numeric), keys))
