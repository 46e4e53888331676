"""Documents to tokens, phrases and counts. None of these shuffles the tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smudgelex.functions import charset as c
from smudgelex.functions import tokens as t
from smudgelex.plans.scan import spread


def id_columns(id: str | Sequence[str]) -> list[str]:
    return [id] if isinstance(id, str) else list(id)


def tokenize(
    df: DataFrame,
    id: str | Sequence[str] = "doc_id",
    text: str = "text",
    markup: str = "none",
    numeric: str = "drop",
    with_tags: bool = False,
    with_final: bool = False,
) -> DataFrame:
    """``(id…, position, token, type, phrase_id[, is_final])``, one row per token.

    ``markup`` is ``none`` for plain text, ``trec`` for SGML whose tags carry no
    attributes (attributes of others are read as text) and ``html`` to strip whole
    tags. ``numeric="drop"`` leaves bare numbers out, ``"keep"`` keeps them.
    ``with_tags`` adds XMLSTART and XMLEND rows, ``with_final`` the end sentinel.
    """
    ids = id_columns(id)
    # Arrays of words and of their phrases are columns of their own, so that rows are made
    # of them in compiled code and without a struct for each token. An inner generator of
    # a column would be filtered by its size, which computes the text twice.
    read = t.rewritten_text(text, markup, numeric, with_tags).alias("_read")
    rows = spread(df.select(*ids, text)).select(*ids, read)
    words = t.marked_words(F.col("_read"), with_final).alias("_words")
    rows = rows.select(*ids, words, t.word_phrases(F.col("_read")).alias("_phrases"))
    rows = rows.select(*ids, "_phrases", F.posexplode_outer("_words").alias("_pos", "_word"))
    rows = rows.where(F.col("_pos").isNotNull())
    phrase = F.get("_phrases", F.col("_pos"))
    fields = t.token_columns(F.col("_word"), phrase, markup, with_final)
    return rows.select(*ids, (F.col("_pos") + 1).alias("position"), *fields)


def phrases(
    df: DataFrame,
    id: str | Sequence[str] = "doc_id",
    text: str = "text",
    markup: str = "none",
    numeric: str = "drop",
) -> DataFrame:
    """``(id…, phrase_id, n_tokens, phrase)``: the TEXT tokens between two breaks."""
    ids = id_columns(id)
    pieces = t.phrase_pieces(text, markup, numeric)
    rows = spread(df.select(*ids, text)).select(
        *ids, F.posexplode(pieces).alias("phrase_id", "piece")
    )
    words = F.filter(
        t.piece_tokens(F.col("piece")), lambda w: ~F.startswith(w, F.lit(c.SYMBOL))
    )
    rows = rows.select(*ids, "phrase_id", words.alias("words"))
    rows = rows.select(
        *ids,
        "phrase_id",
        F.size("words").alias("n_tokens"),
        F.array_join("words", " ").alias("phrase"),
    )
    return rows.where(F.col("n_tokens") > 0)


def doc_stats(
    df: DataFrame,
    id: str | Sequence[str] = "doc_id",
    text: str = "text",
    markup: str = "none",
    numeric: str = "drop",
) -> DataFrame:
    """``(id…, n_tokens, n_phrases)``; documents without tokens count zero."""
    ids = id_columns(id)
    tokens = t.token_array(text, markup, numeric)
    rows = spread(df.select(*ids, text)).select(*ids, tokens.alias("tokens"))
    in_text = F.filter("tokens", lambda x: x["type"] == "TEXT")
    n_phrases = F.size(F.array_distinct(in_text["phrase_id"]))
    return rows.select(
        *ids,
        F.size("tokens").cast("bigint").alias("n_tokens"),
        n_phrases.cast("bigint").alias("n_phrases"),
    )


def doc_lengths(
    tokens: DataFrame, documents: DataFrame, id: str | Sequence[str] = "doc_id"
) -> DataFrame:
    """Token counts from a stored token table; the sentinel does not count."""
    ids = id_columns(id)
    counts = (
        tokens.where(F.col("type") != "NULL")
        .groupBy(*ids)
        .agg(F.count(F.lit(1)).alias("n_tokens"))
    )
    out = documents.select(*ids).join(counts, ids, "left")
    return out.select(*ids, F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))


def last_tokens(
    df: DataFrame,
    id: str | Sequence[str] = "doc_id",
    text: str = "text",
    markup: str = "none",
    numeric: str = "drop",
) -> DataFrame:
    """The last token of each document that has one, taken inside its row."""
    ids = id_columns(id)
    tokens = t.token_array(text, markup, numeric).alias("tokens")
    rows = spread(df.select(*ids, text)).select(*ids, tokens)
    last = F.explode(F.slice("tokens", F.lit(-1), F.lit(1))).alias("last")
    rows = rows.select(*ids, F.size("tokens").alias("position"), last)
    return rows.select(*ids, "position", "last.*")


def with_last_flag(
    tokens: DataFrame, id: str | Sequence[str] = "doc_id"
) -> DataFrame:
    """Flag the last token of each document of a stored token table.

    The maximum is aggregated before it is joined back, so a long document does
    not become one sorted group.
    """
    ids = id_columns(id)
    last = tokens.groupBy(*ids).agg(F.max("position").alias("position"))
    last = last.select(*ids, "position", F.lit(True).alias("is_last"))
    out = tokens.join(last, [*ids, "position"], "left")
    flag = F.coalesce("is_last", F.lit(False)).alias("is_last")
    return out.select(*tokens.columns, flag)


def of_type(tokens: DataFrame, *types: str) -> DataFrame:
    return tokens.where(F.col("type").isin(*types))


def tag_events(
    df: DataFrame, id: str | Sequence[str] = "doc_id", text: str = "text"
) -> DataFrame:
    """``(id…, seq, tag, type)``: complete tags without attributes, in order."""
    ids = id_columns(id)
    tagged = t.up_to_last_tag_end(text)
    lexemes = F.regexp_extract_all(tagged, F.lit(t.tag_pattern("trec")), F.lit(0))
    complete = F.filter(
        lexemes, lambda x: F.rlike(x, F.lit(t.COMPLETE_TAG))
    )
    rows = spread(df.select(*ids, text)).select(*ids, F.posexplode(complete))
    kind = F.when(F.startswith("col", F.lit("</")), "XMLEND").otherwise("XMLSTART")
    return rows.select(
        *ids,
        (F.col("pos") + 1).alias("seq"),
        F.regexp_extract("col", r"^</?(.*)>$", 1).alias("tag"),
        kind.alias("type"),
    )


def entity_counts(df: DataFrame, text: str = "text", markup: str = "trec") -> DataFrame:
    """``(entity, treatment, n)``: a quality report on the entities of a corpus.

    ``unknown`` names are dropped from the text like the ``dropped`` ones, but a
    high count of one points at text the decoder does not cover.
    """
    t.check_options(markup)
    plain = F.col(text)
    if markup != "none":
        plain = t.without_tags(plain, markup, " ")
    names = F.regexp_extract_all(plain, F.lit(t.ENTITY), F.lit(1))
    rows = spread(df.select(text)).select(F.explode(names).alias("entity"))
    return (
        rows.groupBy("entity")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("entity", entity_treatment(F.col("entity")).alias("treatment"), "n")
    )


def entity_treatment(name: Column) -> Column:
    """What becomes of an entity, by its name."""
    return (
        F.when(name.isin(*c.KEPT_ENTITIES), "kept")
        .when(name.isin(*c.DROPPED_ENTITIES), "dropped")
        .otherwise("unknown")
    )
