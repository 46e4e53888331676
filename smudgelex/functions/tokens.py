"""The tokenizer as column expressions.

A text becomes a string of blank-separated tokens with one mark for each phrase
end. Splitting it at the marks gives the phrases, and the index of a piece is the
number of phrase ends before it, so phrases are numbered inside the row. Nothing
is shuffled and no Python runs.

Three things happen on the way:

1. Whole-text passes decode entities, turn tags and slashes into phrase ends and
   cut a single closing mark off a plain word ("word," -> "word" and an end).
2. Pieces made of letters and blanks only are done, and they are most of a text.
3. Other pieces are cut into lexemes, and each lexeme is rewritten on its own. A
   lexeme is a *run* (a word with the symbols inside and behind it), a leading
   punctuation mark, a tag, or an entity that stands alone.

A run keeps the part up to its last *solid* character. What follows is dropped,
and each dropped symbol that is neither an apostrophe nor a currency sign ends a
phrase. "Solid" is what makes the right-recursive word rule a plain greedy match.
A symbol inside a word survives only if something valid follows it. With the
numeric filter on, a tail of digits, hyphens, dots, commas and dollar signs is not
valid, so the last character outside that set decides for everything to its left.
Without the filter, or when the word is ended by markup or a slash, any word
character or currency sign is solid.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from smudgelex.functions import charset as c

MARKUPS = ("none", "trec", "html")
NUMERICS = ("drop", "keep")

_BOUNDARY = r"[\p{P}`]"
_PLAIN_WORD = r"^\p{L}++$"
_PLAIN_PIECE = r"^[\p{L} ]*+$"
_BLANKED = rf"[\t-\r\x85{c.MARKS}]"

# One phrase-ending symbol between a letter and the end of its run.
_CLOSING_MARK = rf"{c.CLOSING}(?<=\p{{L}}.)(?= |(?!{c.run_body('')}))"

_LAST_SOLID_ANY = rf"(?s)^.*[{c.WORD}\p{{Sc}}]"
_LAST_SOLID_NOT_NUMERIC = (
    rf"(?s)^.*(?:[{c.SOLID}][{c.NUMBER}]*\$?|{c.SOLID_CURRENCY})"
)
# A start or end tag with no blank inside; group 1 of ENTITY is the name.
COMPLETE_TAG = rf"^<(?!!)[^{c.SPACE}>]*>$"
ENTITY = rf"&([^{c.SPACE};&<>{c.ENTITY_FROM}]*);"

_NO_BREAK = rf"[{c.WORD}'\p{{Sc}}{c.HARD}]"

# An apostrophe and a closing bracket vanish inside a word, an opening bracket
# turns into a hyphen.
_GLUE_FROM = "(" + c.ENTITY_FROM + "')"
_GLUE_TO = "-" + c.ENTITY_TO


def check_options(markup: str, numeric: str = "drop", tags: bool = False) -> None:
    if markup not in MARKUPS:
        raise ValueError(f"markup must be one of {MARKUPS}, not {markup!r}")
    if numeric not in NUMERICS:
        raise ValueError(f"numeric must be one of {NUMERICS}, not {numeric!r}")
    if tags and markup != "trec":
        raise ValueError("tags are only read with markup='trec'")


def tag_pattern(markup: str) -> str:
    """A comment, a tag, the dropped part of a broken tag, or a lone ``<``."""
    if markup == "html":
        return r"<(?:[^>]*>)?"
    return rf"<(?:![^>]*>|[^!{c.SPACE}>][^{c.SPACE}>]*[{c.SPACE}>]|[{c.SPACE}>])?"


def up_to_last_tag_end(text: Column | str) -> Column:
    return F.regexp_extract(text, "(?s)^.*>", 0)


def without_tags(text: Column, markup: str, mark: str, keep: bool = False) -> Column:
    """Replace tags by ``mark``; ``keep`` spares those that have an end.

    A tag pattern that finds no end fails once per ``<``, each time after reading to
    the end of the text. So the text is cut where the last possible ends are, and in
    each part every attempt succeeds: up to the last ``>`` there are tags, up to the
    last blank there are broken tags, and behind it a ``<`` stands alone.
    """

    def cut(x: Column) -> Column:
        tagged, tail = up_to_last_tag_end(x), F.substring_index(x, ">", -1)
        if not keep:
            tagged = F.regexp_replace(tagged, tag_pattern(markup), mark)
        if markup == "html":
            return F.concat(tagged, F.replace(tail, F.lit("<"), F.lit(mark)))
        broken = F.regexp_extract(tail, rf"(?s)^.*[{c.SPACE}]", 0)
        rest = F.substring(tail, F.length(broken) + 1, F.length(tail))
        broken = F.regexp_replace(
            broken, rf"<(?:[^!{c.SPACE}][^{c.SPACE}]*+[{c.SPACE}]|[{c.SPACE}])?", mark
        )
        return F.concat(tagged, broken, F.replace(rest, F.lit("<"), F.lit(mark)))

    def behind(x: Column) -> Column:
        # What stands before the first ``<`` is in no tag, and most of a text does.
        before = F.substring_index(x, "<", 1)
        rest = F.substring(x, F.length(before) + 1, F.length(x))
        done = F.concat(before, F.element_at(F.transform(F.array(rest), cut), 1))
        return F.when(F.contains(x, F.lit("<")), done).otherwise(x)

    return F.element_at(F.transform(F.array(text), behind), 1)


def _decoded(text: Column) -> Column:
    out = text
    for name, mark in c.ENTITY_MARKS.items():
        out = F.replace(out, F.lit(f"&{name};"), F.lit(mark))
    return F.regexp_replace(out, ENTITY, c.HARD)


def _prepared(text: Column, markup: str, tags: bool) -> Column:
    # Line ends are most of what is blanked, and need no pattern.
    lines = F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" "))
    out = F.regexp_replace(lines, _BLANKED, " ")
    if markup != "none":
        ampersand = F.contains(text, F.lit("&"))
        out = F.when(ampersand, _decoded(out)).otherwise(out)
        out = without_tags(out, markup, c.HARD + c.BREAK, keep=tags)
    if tags:
        return F.regexp_replace(out, r"(?=<)|(?=(?<!<)/)", c.HARD)
    out = F.replace(out, F.lit("/"), F.lit(c.HARD + c.BREAK))
    return F.regexp_replace(out, _CLOSING_MARK, c.BREAK)


def _lexeme_pattern(markup: str, tags: bool) -> str:
    closed = "/<" if tags else ""
    out = f"{c.run_head(closed)}{c.run_body(closed)}*+{c.HARD}?|{_BOUNDARY}"
    if tags:
        out += f"|{tag_pattern(markup)}"
    if markup != "none":
        out += f"|[{c.ENTITY_FROM}]"
    return out


def _core(run: Column, numeric: str) -> Column:
    """The part of a run that is kept, symbols inside it not yet rewritten."""
    any_solid = F.regexp_extract(run, _LAST_SOLID_ANY, 0)
    if numeric == "keep":
        return any_solid
    return F.when(F.endswith(run, F.lit(c.HARD)), any_solid).otherwise(
        F.regexp_extract(run, _LAST_SOLID_NOT_NUMERIC, 0)
    )


def _glued(core: Column) -> Column:
    return F.translate(core, _GLUE_FROM, _GLUE_TO)


def _rewritten_run(run: Column, numeric: str) -> Column:
    core = _core(run, numeric)
    rest = F.substring(run, F.length(core) + 1, F.length(run))
    n_breaks = F.length(F.regexp_replace(rest, _NO_BREAK, ""))
    return F.concat(_glued(core), F.repeat(F.lit(c.BREAK), n_breaks))


def _rewritten_tag(lexeme: Column) -> Column:
    """A complete tag gives its name; comments and broken tags only end a phrase."""
    complete = F.rlike(lexeme, F.lit(COMPLETE_TAG))
    kind = F.when(F.startswith(lexeme, F.lit("</")), c.END_TAG).otherwise(c.START_TAG)
    name = F.regexp_extract(lexeme, r"^</?(.*)>$", 1)
    name = F.translate(name, c.ENTITY_FROM + c.HARD, c.ENTITY_TO)
    end = F.lit(c.BREAK)
    return F.when(complete, F.concat(kind, name, end)).otherwise(end)


def _rewritten(lexeme: Column, markup: str, numeric: str, tags: bool) -> Column:
    out = F.when(F.rlike(lexeme, F.lit(_PLAIN_WORD)), lexeme)
    out = out.when(F.rlike(lexeme, F.lit(f"^{_BOUNDARY}$")), F.lit(c.BREAK))
    if tags:
        out = out.when(F.startswith(lexeme, F.lit("<")), _rewritten_tag(lexeme))
    if markup != "none":
        alone = F.rlike(lexeme, F.lit(f"^[{c.ENTITY_FROM}]$"))
        symbol = F.concat(F.lit(c.SYMBOL), _glued(lexeme), F.lit(c.BREAK))
        out = out.when(alone, symbol)
    return out.otherwise(_rewritten_run(lexeme, numeric))


def prepared(text: Column | str, markup: str = "none", tags: bool = False) -> Column:
    """A text behind the passes that do not depend on how numbers are read."""
    check_options(markup, tags=tags)
    return _prepared(F.col(text) if isinstance(text, str) else text, markup, tags)


def rewritten(
    prepared: Column, markup: str = "none", numeric: str = "drop", tags: bool = False
) -> Column:
    """The tokens of a prepared text, blanks between them and a mark at each phrase end."""
    check_options(markup, numeric, tags)
    pattern = F.lit(_lexeme_pattern(markup, tags))

    def piece(p: Column) -> Column:
        parts = F.regexp_extract_all(p, pattern, F.lit(0))
        parts = F.transform(parts, lambda x: _rewritten(x, markup, numeric, tags))
        plain = F.rlike(p, F.lit(_PLAIN_PIECE))
        return F.when(plain, p).otherwise(F.array_join(parts, " "))

    pieces = F.transform(F.split(prepared, c.BREAK), piece)
    return F.array_join(pieces, c.BREAK)


def rewritten_text(text: Column | str, markup: str, numeric: str, tags: bool) -> Column:
    """``rewritten`` of a text that is not prepared."""
    return _rewritten_of(text, markup, numeric, tags)


def _rewritten_text(text: Column, markup: str, numeric: str, tags: bool) -> Column:
    return rewritten(_prepared(text, markup, tags), markup, numeric, tags)


@lru_cache(maxsize=128)
def _rewritten_column(
    application: str, text: str, markup: str, numeric: str, tags: bool
) -> Column:
    # Building the expression takes some hundred calls into the JVM, and it depends
    # on nothing but a column name and options; it lives as long as the application.
    return _rewritten_text(F.col(text), markup, numeric, tags)


def _rewritten_of(
    text: Column | str, markup: str, numeric: str, tags: bool = False
) -> Column:
    check_options(markup, numeric, tags)
    session = SparkSession.getActiveSession()
    if session is None or not isinstance(text, str):
        text = F.col(text) if isinstance(text, str) else text
        return _rewritten_text(text, markup, numeric, tags)
    application = session.sparkContext.applicationId
    return _rewritten_column(application, text, markup, numeric, tags)


def phrase_pieces(
    text: Column | str, markup: str = "none", numeric: str = "drop", tags: bool = False
) -> Column:
    """``array<string>``: element *i* holds the tokens of phrase *i* and blanks."""
    return F.split(_rewritten_of(text, markup, numeric, tags), c.BREAK)


def piece_tokens(piece: Column) -> Column:
    """Tokens of one piece, type marks still in front."""
    return F.array_remove(F.split(piece, " "), "")


def word_array(
    text: Column | str, markup: str = "none", numeric: str = "drop"
) -> Column:
    """``array<string>`` of all TEXT and SYMBOL tokens, without their places."""
    rewritten = _rewritten_of(text, markup, numeric)
    return F.array_remove(F.split(rewritten, f"[ {c.BREAK}{c.SYMBOL}]+"), "")


def marked_words(rewritten: Column, final: bool = False) -> Column:
    """``array<string>`` of all tokens of a rewritten text, type marks still in front:
    two are the same if and only if type and text are."""
    words = piece_tokens(F.replace(rewritten, F.lit(c.BREAK), F.lit(" ")))
    return F.concat(words, F.array(F.lit(c.FINAL))) if final else words


def word_phrases(rewritten: Column) -> Column:
    """``array<int>``: the phrase of each of ``marked_words``."""

    def of_piece(piece: Column, i: Column) -> Column:
        return F.array_repeat(i, F.size(piece_tokens(piece)))

    return F.flatten(F.transform(F.split(rewritten, c.BREAK), of_piece))


def marked_token(marked: Column, typed: bool = True) -> tuple[Column, Column]:
    """Text and type of a token whose type mark stands in front; of null, two nulls.
    Without ``typed`` there are no marks but the sentinel's."""
    kinds = {c.START_TAG: "XMLSTART", c.END_TAG: "XMLEND", c.SYMBOL: "SYMBOL"} if typed else {}
    mark = F.substring(marked, 1, 1)
    kind = F.when(mark == c.FINAL, "NULL")
    for sign, name in kinds.items():
        kind = kind.when(mark == sign, name)
    kind = kind.when(marked.isNotNull(), "TEXT")
    name = F.substring(marked, F.lit(2), F.length(marked))
    return F.when(mark.isin(c.FINAL, *kinds), name).otherwise(marked), kind


def token_columns(
    marked: Column, phrase: Column, markup: str = "none", final: bool = False
) -> list[Column]:
    """``token, type, phrase_id[, is_final]`` of one of ``marked_words``."""
    if markup == "none" and not final:
        return [marked.alias("token"), F.lit("TEXT").alias("type"), phrase.alias("phrase_id")]
    token, kind = marked_token(marked, markup != "none")
    phrase = F.when(kind == "TEXT", phrase).otherwise(0)
    fields = [token.alias("token"), kind.alias("type"), phrase.alias("phrase_id")]
    if final:
        fields.append((kind == "NULL").alias("is_final"))
    return fields


def _text_token(token: Column, phrase: Column, final: bool) -> Column:
    fields = [token.alias("token"), F.lit("TEXT").alias("type")]
    fields.append(phrase.alias("phrase_id"))
    if final:
        fields.append(F.lit(False).alias("is_final"))
    return F.struct(*fields)


def _any_token(token: Column, phrase: Column, final: bool) -> Column:
    mark = F.substring(token, 1, 1)
    kind = (
        F.when(mark == c.START_TAG, "XMLSTART")
        .when(mark == c.END_TAG, "XMLEND")
        .when(mark == c.SYMBOL, "SYMBOL")
        .otherwise("TEXT")
    )
    marked = mark.isin(c.START_TAG, c.END_TAG, c.SYMBOL)
    name = F.substring(token, F.lit(2), F.length(token))
    fields = [
        F.when(marked, name).otherwise(token).alias("token"),
        kind.alias("type"),
        F.when(marked, F.lit(0)).otherwise(phrase).alias("phrase_id"),
    ]
    if final:
        fields.append(F.lit(False).alias("is_final"))
    return F.struct(*fields)


def token_array(
    text: Column | str,
    markup: str = "none",
    numeric: str = "drop",
    tags: bool = False,
    final: bool = False,
) -> Column:
    """``array<struct<token, type, phrase_id[, is_final]>>`` of one text, in order.

    ``final`` adds the end sentinel, an empty NULL token behind the last one.
    """

    def of_piece(piece: Column, i: Column) -> Column:
        plain = F.transform(piece_tokens(piece), lambda t: _text_token(t, i, final))
        if markup == "none":
            return plain
        # Few pieces hold anything but TEXT, so types are looked up only there.
        mixed = F.transform(piece_tokens(piece), lambda t: _any_token(t, i, final))
        marks = f"[{c.START_TAG}{c.END_TAG}{c.SYMBOL}]"
        return F.when(F.rlike(piece, F.lit(marks)), mixed).otherwise(plain)

    pieces = phrase_pieces(text, markup, numeric, tags)
    tokens = F.flatten(F.transform(pieces, of_piece))
    if not final:
        return tokens
    end = F.struct(
        F.lit("").alias("token"),
        F.lit("NULL").alias("type"),
        F.lit(0).alias("phrase_id"),
        F.lit(True).alias("is_final"),
    )
    return F.concat(tokens, F.array(end))
