"""Token tables to files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tokens(tokens: DataFrame, path: str) -> None:
    """Text files with one token per line, repeats kept. Replaces what is there."""
    tokens.select("token").write.mode("overwrite").text(path)


def write_token_table(tokens: DataFrame, path: str) -> None:
    tokens.write.mode("overwrite").parquet(path)


def write_missing(tagged: DataFrame, path: str) -> None:
    """Text files with the words found in no reference table, one per line."""
    write_tokens(tagged.where(F.col("kind") == "missing"), path)


def write_trec(
    documents: DataFrame,
    path: str,
    id: str = "doc_id",
    text: str = "text",
    by: str | None = None,
    escape: bool = False,
    compression: str = "none",
) -> DataFrame:
    """A table as SGML files that ``read_corpus`` reads back; a NULL text is empty.

    A text that holds a tag of the format or opens a comment would come back as
    something else. Such rows are not written but returned, as they are; with ``escape``
    they are written too, every ``<`` of theirs as an entity. ``by`` names a column that
    gives the files of each value a folder of their own.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    clashes = F.rlike(value, F.lit("</?(?:DOC|DOCNO|TEXT)>|<!"))
    if escape:
        value = F.when(clashes, F.replace(value, F.lit("<"), F.lit("&lt;"))).otherwise(value)
        clashes = F.lit(False)
    number = F.coalesce(F.col(id).cast("string"), F.lit(""))
    doc = F.format_string("<DOC>\n<DOCNO>%s</DOCNO>\n<TEXT>\n%s\n</TEXT>\n</DOC>", number, value)
    folder = [] if by is None else [F.col(by)]
    written = documents.where(~clashes).select(*folder, doc.alias("value"))
    writer = written.write.mode("overwrite").option("compression", compression)
    (writer if by is None else writer.partitionBy(by)).text(path)
    return documents.where(clashes)
