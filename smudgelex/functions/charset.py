"""Character classes and markup tables behind the token rules.

Everything here is a plain string that is spliced into a Java regular
expression, so that the whole tokenizer stays inside Spark's own functions.
"""

from __future__ import annotations

# Characters with the Unicode Dash or Hyphen property. Java has no
# regex property for either, so they are listed.
DASHES = (
    "-\u00ad\u058a\u05be\u1400\u1806\u2010\u2011"
    "\u2012\u2013\u2014\u2015\u2053\u207b\u208b\u2212"
    "\u2e17\u2e1a\u2e3a\u2e3b\u2e40\u301c\u3030\u30a0"
    "\u30fb\ufe31\ufe32\ufe58\ufe63\uff0d\uff65"
)

SOFT_HYPHEN = "\u00ad"

# Entities that stand for a character of the text.
KEPT_ENTITIES = {
    "hyph": "-",
    "lt": "<",
    "gt": ">",
    "eacute": "é",
    "uuml": "ü",
    "ntilde": "ñ",
    "aacute": "á",
    "iacute": "í",
    "oacute": "ó",
    "rsquo": "'",
    "lsquo": "'",
}

# Entities that are known and dropped. Any other name is dropped
# too, but counts as unknown.
DROPPED_ENTITIES = (
    "blank",
    "mu",
    "para",
    "reg",
    "sect",
    "cir",
    "bull",
    "racute",
    "lacute",
    "tilde",
    "amp",
)

# Private-use marks that live only between two steps of one expression. Such
# characters are blanked out of the input first, so they cannot collide.
BREAK = "\ue000"  # a phrase ends here
HARD = "\ue001"  # the word before ends without a numeric check
START_TAG = "\ue002"
END_TAG = "\ue003"
SYMBOL = "\ue004"
FINAL = "\ue005"  # stands for the end sentinel
ENTITY_MARKS = {name: chr(0xE010 + i) for i, name in enumerate(KEPT_ENTITIES)}
MARKS = "\ue000-\ue01f"

ENTITY_FROM = "".join(ENTITY_MARKS.values())
ENTITY_TO = "".join(KEPT_ENTITIES.values())
HYPHEN_MARK = ENTITY_MARKS["hyph"]

# Java's \s is ASCII only.
SPACE = r"\s\x0B\x85\p{Z}"

# Java checks a flat class of n parts through n nested calls. The classes below are
# nested so that a letter, by far the most common character, is settled by the first
# test, and an ASCII symbol never walks the long lists.
def _beyond_ascii(chars: str) -> str:
    return rf"[[^\x00-\x7F]&&[{chars}]]"


_MORE_DASHES = DASHES.replace("-", "")
_MORE_ENTITIES = ENTITY_FROM.replace(HYPHEN_MARK, "")
WORD = rf"\p{{L}}[\p{{Nd}}\-{_beyond_ascii(_MORE_DASHES + ENTITY_FROM)}]"

# Characters a number is made of, and the word characters that are none of them.
NUMBER = rf"0-9\-{HYPHEN_MARK}"
SOLID = rf"\p{{L}}{_beyond_ascii(rf'\p{{Nd}}{_MORE_DASHES}{_MORE_ENTITIES}')}"
SOLID_CURRENCY = r"[\p{Sc}&&[^$]]"

# ASCII symbols that end a phrase behind a word.
CLOSING = r"""[!"#%&()*+,.:;<=>?@\[\\\]^_`{|}~]"""


def _without(closed: str) -> str:
    return f"&&[^{closed}]" if closed else ""


def run_head(closed: str) -> str:
    """First character of a run; ``closed`` symbols are left to other lexemes."""
    return rf"[\p{{L}}[\p{{Nd}}[\p{{S}}&&[^`{closed}]]]]"


def run_body(closed: str) -> str:
    """Any later character. All dashes but U+00AD are punctuation or symbols."""
    keep = _without(closed)
    return (
        rf"[\p{{L}}[[\p{{P}}{keep}][\p{{Nd}}[\p{{S}}{keep}]"
        rf"[{SOFT_HYPHEN}{ENTITY_FROM}]]]]"
    )
