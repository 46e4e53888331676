"""Printed and JSON forms of tokens and documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How tokens and documents are printed.
TOKEN_FORMAT = "%s [%s@%d:%d]"
DOCUMENT_FORMAT = "{Doc: %s, Tokens: %d}"


def token_string(
    token: str = "token",
    type: str = "type",
    position: str = "position",
    phrase_id: str = "phrase_id",
) -> Column:
    """``text [TYPE@position:phrase]``."""
    columns = map(F.col, (token, type, position, phrase_id))
    return F.format_string(TOKEN_FORMAT, *columns)


def document_string(doc_id: str = "doc_id", n_tokens: str = "n_tokens") -> Column:
    return F.format_string(DOCUMENT_FORMAT, F.col(doc_id).cast("string"), F.col(n_tokens))


def document_json(*columns: str) -> Column:
    """JSON object of the columns; an id is a number, not a string."""
    return F.to_json(F.struct(*columns))
