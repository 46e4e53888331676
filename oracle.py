"""DuckDB SQL for the registered queries.

The tokenizer is written a second time here, on purpose in another way: words are
folded from the right, symbol by symbol, and phrases are numbered by a window.
"""

from __future__ import annotations

from smudgelex.functions import charset as c

_DASH = c.DASHES.replace("-", "")
_ENT = c.ENTITY_FROM
_WORD = rf"\p{{L}}\p{{Nd}}\-{_DASH}{_ENT}"
_SPACE = r"\s\x0B\x{85}\p{Z}"
_BROKEN = rf"<(?:[^!{_SPACE}>][^{_SPACE}>]*[{_SPACE}]|[{_SPACE}])?"
_TAG_OPEN, _TAG_END, _TAG_STOP = "\ue005", "\ue006", "\ue007"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sub(text: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({text}, {_q(pattern)}, {_q(replacement)}, 'g')"


def _marked(text: str, markup: str, tags: bool) -> str:
    end = c.HARD + c.BREAK
    out = _sub(f"coalesce({text}, '')", r"[\x{E000}-\x{E01F}]", " ")
    if markup != "none":
        for name, mark in c.ENTITY_MARKS.items():
            out = f"replace({out}, {_q(f'&{name};')}, {_q(mark)})"
        out = _sub(out, rf"&[^{_SPACE};&<>{_ENT}]*;", c.HARD)
    if markup == "html":
        out = _sub(out, r"<[^>]*>|<", end)
    elif markup == "trec":
        if tags:
            out = _sub(out, r"<![^>]*>", end)
            name = rf"([^{_SPACE}>]*)>"
            out = _sub(out, f"</{name}", rf"{c.HARD}{_TAG_END}\1{_TAG_STOP}")
            out = _sub(out, f"<{name}", rf"{c.HARD}{_TAG_OPEN}\1{_TAG_STOP}")
            out = _sub(out, _BROKEN, end)
        else:
            complete = rf"<![^>]*>|<[^!{_SPACE}>][^{_SPACE}>]*[{_SPACE}>]|<[{_SPACE}>]|<"
            out = _sub(out, complete, end)
    return f"replace({out}, '/', {_q(end)})"


def tokens(
    name: str,
    source: str,
    ids: str = "doc_id",
    markup: str = "none",
    numeric: str = "drop",
    tags: bool = False,
) -> str:
    """CTEs that end in ``name`` with ids, position, token, type, phrase_id.

    ``source`` selects the ids and a column ``text``.
    """
    lexeme = (
        rf"{_TAG_OPEN}[^{_TAG_STOP}]*|{_TAG_END}[^{_TAG_STOP}]*"
        rf"|[\p{{P}}`{c.BREAK}]|[{_ENT}]"
        rf"|[\p{{L}}\p{{Nd}}\p{{S}}][\p{{L}}\p{{Nd}}\p{{S}}\p{{P}}\x{{AD}}{_ENT}]*{c.HARD}?"
    )
    segment = rf"[{_WORD}]+|[\p{{S}}\p{{P}}][{_WORD}]*"
    number = rf"^[\-$.,0-9{c.HYPHEN_MARK}]+$"
    keep = "true" if numeric == "keep" else "hard"
    symbol = rf"regexp_extract(g, {_q(rf'^[^{_WORD}]')})"
    rest = f"g[length({symbol}) + 1:]"
    part = f"({rest} || coalesce(a.part, ''))"
    ok = f"({part} <> '' AND ({keep} OR NOT regexp_matches({part}, {_q(number)})))"
    glue = f"CASE {symbol} WHEN '''' THEN '' WHEN '(' THEN '-' WHEN ')' THEN '' ELSE {symbol} END"
    fold = f"""
      list_reduce(segs, lambda a, g: CASE
        WHEN {symbol} = '' THEN {{'part': {part}, 'breaks': a.breaks}}
        WHEN {ok} THEN {{'part': {glue} || {part}, 'breaks': a.breaks}}
        WHEN regexp_matches({symbol}, '\\p{{Sc}}') THEN {{'part': {symbol}, 'breaks': a.breaks}}
        WHEN {symbol} = '''' THEN {{'part': NULL, 'breaks': a.breaks}}
        ELSE {{'part': NULL, 'breaks': a.breaks + 1}} END,
        {{'part': NULL::VARCHAR, 'breaks': 0}})"""
    fails = f"part IS NULL OR part = '' OR NOT ({keep} OR NOT regexp_matches(part, {_q(number)}))"
    return f"""
{name}_text AS (
  SELECT {ids}, regexp_extract_all({_marked('text', markup, tags)}, {_q(lexeme)}) AS lexemes
  FROM ({source})),
{name}_lex AS (
  SELECT {ids}, unnest(lexemes) AS lex, generate_subscripts(lexemes, 1) AS ord
  FROM {name}_text),
{name}_kind AS (
  SELECT {ids}, ord, lex, ends_with(lex, {_q(c.HARD)}) AS hard, CASE
    WHEN starts_with(lex, {_q(_TAG_OPEN)}) THEN 'XMLSTART'
    WHEN starts_with(lex, {_q(_TAG_END)}) THEN 'XMLEND'
    WHEN regexp_full_match(lex, {_q(f'[{_ENT}]')}) THEN 'SYMBOL'
    WHEN regexp_full_match(lex, {_q(rf'[`{c.BREAK}]|[\p{{P}}]')}) THEN 'BREAK'
    ELSE 'TEXT' END AS type
  FROM {name}_lex),
{name}_segs AS (
  SELECT *, CASE WHEN type = 'TEXT' THEN list_reverse(regexp_extract_all(
    rtrim(lex, {_q(c.HARD)}), {_q(segment)})) ELSE [] END AS segs
  FROM {name}_kind),
{name}_fold AS (
  SELECT {ids}, ord, lex, type, hard, {fold} AS f FROM {name}_segs),
{name}_parts AS (
  SELECT {ids}, ord, lex, type, hard, f.part AS part, f.breaks AS breaks FROM {name}_fold),
{name}_words AS (
  SELECT {ids}, ord, type,
    CASE WHEN type = 'TEXT' THEN breaks ELSE 1 END AS breaks,
    CASE WHEN type = 'TEXT' THEN CASE WHEN {fails} THEN NULL ELSE part END
         WHEN type = 'SYMBOL' THEN lex
         WHEN type IN ('XMLSTART', 'XMLEND') THEN lex[2:] END AS word
  FROM {name}_parts),
{name}_phrases AS (
  SELECT *, coalesce(sum(breaks) OVER (PARTITION BY {ids} ORDER BY ord
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS phrase
  FROM {name}_words),
{name} AS (
  SELECT {ids},
    CAST(row_number() OVER (PARTITION BY {ids} ORDER BY ord) AS INTEGER) AS position,
    translate(word, {_q(_ENT)}, {_q(c.ENTITY_TO)}) AS token, type,
    CAST(CASE WHEN type = 'TEXT' THEN phrase ELSE 0 END AS INTEGER) AS phrase_id
  FROM {name}_phrases WHERE word IS NOT NULL)"""


_DOCS = "SELECT doc_id, text FROM documents"
_PAGES = "SELECT page_id, html AS text FROM pages"
_TOKEN_COLUMNS = "position, token, type, phrase_id"
_LEXICON = """
lexicon AS (SELECT token, count(*) AS n FROM doc_tokens GROUP BY token)"""


def _doc_tokens(**options) -> str:
    return tokens("doc_tokens", _DOCS, **options)


def _key(token: str, collation: str) -> str:
    plain = f"lower(rtrim({token}))"
    if collation == "ignore_accents":
        return f"replace(strip_accents({plain}), 'ß', 'ss')"
    return token if collation == "exact" else plain


def _keys(collation: str = "ignore_case") -> str:
    key = _key("token", collation)
    titles = (
        "SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS text FROM pages"
    )
    return (
        tokens("bench_tokens", "SELECT item_id, text FROM benchmark", "item_id")
        + ","
        + tokens(
            "user_tokens",
            "SELECT conv_id, turn, text FROM conversations WHERE role = 'user'",
            "conv_id, turn",
        )
        + ","
        + tokens("title_tokens", titles, "page_id", "html")
        + ","
        + tokens("region_tokens", "SELECT r_regionkey, r_name AS text FROM region", "r_regionkey")
        + f""",
ref AS (
  SELECT {key} AS key, 0 AS rank FROM user_tokens WHERE regexp_matches(token, '^\\p{{Lu}}')
  UNION ALL SELECT {key}, 1 FROM bench_tokens
  UNION ALL SELECT {key}, 2 FROM region_tokens
  UNION ALL SELECT {key}, 2 FROM title_tokens),
keys AS (
  SELECT key, CASE min(rank) WHEN 0 THEN 'names' WHEN 1 THEN 'dict' ELSE 'geo' END AS kind
  FROM ref GROUP BY key)"""
    )


def _tagged(collation: str = "ignore_case") -> str:
    key = _key("l.token", collation)
    return (
        _doc_tokens()
        + ","
        + _LEXICON
        + ","
        + _keys(collation)
        + f""",
tagged AS (
  SELECT l.token, l.n, coalesce(k.kind, 'missing') AS kind
  FROM lexicon l LEFT JOIN keys k ON k.key = {key})"""
    )


def _reconcile(left: str, right: str, id: str = "doc_id") -> str:
    return f"""
SELECT coalesce(a.{id}, b.{id}) AS {id}, coalesce(a.position, b.position) AS position,
  a.token AS left_token, a.type AS left_type, b.token AS right_token, b.type AS right_type
FROM {left} a FULL OUTER JOIN {right} b ON a.{id} = b.{id} AND a.position = b.position
WHERE a.type IS DISTINCT FROM b.type OR a.token IS DISTINCT FROM b.token"""


def _page_tags() -> str:
    lexeme = (
        rf"<![^>]*>|<[^!{_SPACE}>][^{_SPACE}>]*[{_SPACE}>]|<[{_SPACE}>]|<"
    )
    return f"""
lexemes AS (
  SELECT page_id, unnest(regexp_extract_all(html, {_q(lexeme)})) AS lex FROM pages),
tags AS (
  SELECT page_id, CASE WHEN starts_with(lex, '</') THEN 'XMLEND' ELSE 'XMLSTART' END AS type,
    regexp_extract(lex, '^</?(.*)>$', 1) AS tag
  FROM lexemes
  WHERE regexp_full_match(lex, {_q(rf'<[^{_SPACE}>]*>')}) AND NOT starts_with(lex, '<!'))"""


def _entities() -> str:
    """Letters and signs spelled as entities, whose table is spelled here once more."""
    text = "text"
    for letter, name in (
        ("é", "eacute"), ("ü", "uuml"), ("ñ", "ntilde"), ("á", "aacute"),
        ("í", "iacute"), ("ó", "oacute"), ("-", "hyph"), ("'", "rsquo"),
    ):
        text = f"replace({text}, {_q(letter)}, '&{name};')"
    return text


def _trec_text(closing: str = "\n") -> str:
    return f"SELECT doc_id, chr(10) || text || {_q(closing)} || '</TEXT>' AS text FROM documents"


def build() -> dict[str, str]:
    w = "WITH "
    all_tokens = f"SELECT doc_id, {_TOKEN_COLUMNS} FROM doc_tokens"
    page_tokens = f"SELECT page_id, {_TOKEN_COLUMNS} FROM page_tokens"
    round_trip = w + tokens("doc_tokens", _trec_text(), markup="trec") + all_tokens
    lexicon = "SELECT token, n FROM lexicon"
    tag_tokens = f"""
SELECT t.doc_id, t.position, t.token, t.type, t.phrase_id, g.kind
FROM doc_tokens t JOIN tagged g ON g.token = t.token"""
    kinds = "(VALUES ('names'), ('dict'), ('geo'), ('missing')) k(kind)"
    entity = "SELECT unnest(regexp_extract_all(regexp_replace(html, '<[^>]*>|<', ' ', 'g'), "
    names = entity + _q(rf"&([^{_SPACE};&<>]*);") + ", 1)) AS entity FROM pages"
    treated = (
        "SELECT entity, CASE WHEN entity IN ("
        + ", ".join(map(_q, c.KEPT_ENTITIES))
        + ") THEN 'kept' WHEN entity IN ("
        + ", ".join(map(_q, c.DROPPED_ENTITIES))
        + f") THEN 'dropped' ELSE 'unknown' END AS treatment FROM ({names})"
    )
    return {
        "tokenize_documents": w + _doc_tokens() + all_tokens,
        "tokenize_keep_numeric": w + _doc_tokens(numeric="keep") + all_tokens,
        "tokenize_conversations": w
        + tokens("t", "SELECT conv_id, turn, text FROM conversations", "conv_id, turn")
        + f"SELECT conv_id, turn, {_TOKEN_COLUMNS} FROM t",
        "tokenize_pages_trec": w
        + tokens("page_tokens", _PAGES, "page_id", "trec")
        + page_tokens,
        "tokenize_pages_html": w
        + tokens("page_tokens", _PAGES, "page_id", "html")
        + page_tokens,
        "page_tags": w
        + _page_tags()
        + "SELECT tag, type, count(*) AS n, count(DISTINCT page_id) AS n_pages "
        "FROM tags GROUP BY tag, type",
        "token_types": w
        + tokens("page_tokens", _PAGES, "page_id", "trec", tags=True)
        + "SELECT page_id, position, type, format('{} [{}@{}:{}]', token, type, position, "
        "phrase_id) AS rendered FROM page_tokens",
        "entity_counts": f"SELECT entity, treatment, count(*) AS n FROM ({treated}) GROUP BY ALL",
        "doc_length": w
        + _doc_tokens()
        + "SELECT d.doc_id, count(t.token) AS n_tokens, count(DISTINCT t.phrase_id) AS n_phrases "
        "FROM documents d LEFT JOIN doc_tokens t ON t.doc_id = d.doc_id GROUP BY d.doc_id",
        "doc_length_stored": w
        + _doc_tokens()
        + "SELECT d.doc_id, count(t.token) AS n_tokens "
        "FROM documents d LEFT JOIN doc_tokens t ON t.doc_id = d.doc_id GROUP BY d.doc_id",
        "docs_per_source": "SELECT source, count(*) AS n_docs FROM documents GROUP BY source",
        "first_per_source": "SELECT source, doc_id, text FROM documents "
        "QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3",
        "document_strings": w
        + _doc_tokens()
        + ", lengths AS (SELECT d.doc_id, d.source, count(t.token) AS n FROM documents d "
        "LEFT JOIN doc_tokens t ON t.doc_id = d.doc_id GROUP BY d.doc_id, d.source) "
        "SELECT doc_id, '{Doc: ' || doc_id || ', Tokens: ' || n || '}' AS rendered, "
        """'{"doc_id":' || doc_id || ',"source":"' || source || '"}' AS json FROM lengths""",
        "final_tokens": w
        + _doc_tokens()
        + "SELECT d.doc_id, CAST(count(t.token) + 1 AS INTEGER) AS position, '' AS token, "
        "'NULL' AS type, 0 AS phrase_id, true AS is_final FROM documents d "
        "LEFT JOIN doc_tokens t ON t.doc_id = d.doc_id GROUP BY d.doc_id",
        "last_tokens": w
        + _doc_tokens()
        + all_tokens
        + " QUALIFY position = max(position) OVER (PARTITION BY doc_id)",
        "last_tokens_stored": w
        + _doc_tokens()
        + all_tokens
        + " QUALIFY position = max(position) OVER (PARTITION BY doc_id)",
        "lexicon": w + _doc_tokens() + "," + _LEXICON + lexicon,
        "lexicon_pages": w
        + tokens("doc_tokens", _PAGES, "page_id", "html")
        + ","
        + _LEXICON
        + lexicon,
        "phrases": w
        + _doc_tokens()
        + "SELECT doc_id, phrase_id, CAST(count(*) AS INTEGER) AS n_tokens, "
        "string_agg(token, ' ' ORDER BY position) AS phrase FROM doc_tokens "
        "WHERE type = 'TEXT' GROUP BY doc_id, phrase_id",
        "numeric_dropped": w
        + tokens("kept", _DOCS, numeric="keep")
        + ","
        + tokens("dropped", _DOCS)
        + _reconcile("kept", "dropped"),
        "reconcile_tokens": w
        + tokens("marked", _PAGES, "page_id", "trec")
        + ","
        + tokens("stripped", _PAGES, "page_id", "html")
        + _reconcile("marked", "stripped", "page_id"),
        "tag_lexicon": w + _tagged() + "SELECT token, n, kind FROM tagged",
        "tag_exact_case": w + _tagged("exact") + "SELECT token, n, kind FROM tagged",
        "tag_ignore_accents": w + _tagged("ignore_accents") + "SELECT token, n, kind FROM tagged",
        "missing_tokens": w + _tagged() + "SELECT token, n FROM tagged WHERE kind = 'missing'",
        "known_tokens": w + _tagged() + "SELECT token, n FROM tagged WHERE kind <> 'missing'",
        "names_tokens": w + _tagged() + "SELECT token, n, kind FROM tagged WHERE kind = 'names'",
        "kind_counts": w
        + _tagged()
        + "SELECT k.kind, count(t.token) AS n_words, CAST(coalesce(sum(t.n), 0) AS BIGINT) "
        f"AS n_tokens FROM {kinds} LEFT JOIN tagged t ON t.kind = k.kind GROUP BY k.kind",
        "tokens_processed": w
        + _tagged()
        + "SELECT CAST(sum(n) AS BIGINT) AS n_processed FROM tagged",
        "tag_tokens": w + _tagged() + tag_tokens,
        "tag_tokens_shuffled": w + _tagged() + tag_tokens,
        "trec_round_trip": round_trip,
        "read_documents": round_trip,
        "stream_tokenize": round_trip,
        "stream_documents": round_trip,
        "stream_tag_tokens": w
        + tokens("doc_tokens", _trec_text(), markup="trec")
        + ","
        + _LEXICON
        + ","
        + _keys()
        + "SELECT t.doc_id, t.position, t.token, coalesce(k.kind, 'missing') AS kind "
        "FROM doc_tokens t LEFT JOIN keys k ON k.key = lower(rtrim(t.token))",
        "stream_lexicon": w
        + tokens("doc_tokens", _trec_text(), markup="trec")
        + ","
        + _LEXICON
        + lexicon,
        "running_lexicon": w
        + tokens("doc_tokens", _trec_text(), markup="trec")
        + ","
        + _LEXICON
        + lexicon,
        "page_metrics": w
        + tokens("page_tokens", _PAGES, "page_id", "html")
        + f", entities AS ({treated}) SELECT (SELECT count(*) FROM pages) AS n_documents, "
        + ", ".join(
            f"(SELECT count(*) FROM entities WHERE treatment = '{k}') AS n_{k}"
            for k in ("kept", "dropped", "unknown")
        )
        + ", (SELECT count(*) FROM page_tokens WHERE token <> '') AS n_processed",
        "token_file": w
        + tokens("doc_tokens", _trec_text(), markup="trec")
        + ","
        + _LEXICON
        + lexicon,
        "missing_file": w + _tagged() + "SELECT token FROM tagged WHERE kind = 'missing'",
        "malformed_documents": """
SELECT CASE lang WHEN 'de' THEN 'no document number' WHEN 'es' THEN 'text before document number'
  WHEN 'fr' THEN 'not closed' ELSE 'none' END AS malformed, count(*) AS n,
  count(DISTINCT CASE WHEN lang NOT IN ('de', 'es', 'fr') THEN doc_id END) AS n_ids
FROM documents GROUP BY 1""",
        "reconcile_stored": w
        + tokens("marked", _PAGES, "page_id", "trec")
        + ","
        + tokens("stripped", _PAGES, "page_id", "html")
        + _reconcile("marked", "stripped", "page_id"),
        "moved_tokens": w
        + tokens("kept", _DOCS, numeric="keep")
        + ","
        + tokens("dropped", _DOCS)
        + "SELECT doc_id, position, token, type FROM kept "
        "EXCEPT SELECT doc_id, position, token, type FROM dropped",
        "corpus_ids": "SELECT lang, count(*) AS n, count(*) AS n_ids, "
        "count(DISTINCT doc_id % 7) AS n_numbers FROM documents GROUP BY lang",
        "first_per_file": "SELECT source, doc_id FROM documents "
        "QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3",
        "docs_per_file": "SELECT source, count(*) AS n_docs FROM documents GROUP BY source",
        "first_documents": "SELECT least(count(*), 100) AS n FROM documents",
        "file_pattern": "SELECT doc_id FROM documents WHERE lang = 'en'",
        "tokenize_entities": w
        + tokens("doc_tokens", f"SELECT doc_id, {_entities()} AS text FROM documents", markup="trec")
        + all_tokens,
        "tag_read_reference": w + _tagged() + "SELECT token, n, kind FROM tagged",
    }
