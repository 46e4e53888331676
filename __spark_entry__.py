"""Registered queries, each over its whole tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

import oracle
from smudgelex.functions import render
from smudgelex.operators import align, compare, lexicon, tag, tokenize
from smudgelex.plans import jobs, metrics
from smudgelex.plans.storage import fresh_path
from smudgelex.sources import corpus, sinks, tables
from smudgelex.streaming import jobs as streams
from smudgelex.streaming import lexicon_store

try:
    import corpus_pipeline
    from smudgelex.llm import registry
except ModuleNotFoundError as error:
    if not (error.name or "").startswith(("corpus_pipeline", "smudgelex.llm")):
        raise
    corpus_pipeline = registry = None

SMALL = "/root/testdata/sf0.001"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents")


def _doc_tokens(spark: SparkSession, sf: str, **options) -> DataFrame:
    return tokenize.tokenize(_documents(spark, sf), **options)


def _page_tokens(spark: SparkSession, sf: str, markup: str, **options) -> DataFrame:
    pages = _table(spark, sf, "pages")
    return tokenize.tokenize(pages, "page_id", "html", markup=markup, **options)


def _reference_tables(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Reference tables taken from the test tables: capitalized words of user turns
    as names, words of the benchmark as dictionary, regions and page titles as
    places."""
    users = _table(spark, sf, "conversations").where("role = 'user'")
    names = lexicon.words_of(users).where(F.rlike("token", F.lit(r"^\p{Lu}")))
    words = lexicon.words_of(_table(spark, sf, "benchmark"))
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("text")
    titles = lexicon.words_of(_table(spark, sf, "pages").select(title), markup="html")
    regions = lexicon.words_of(_table(spark, sf, "region"), "r_name")
    return [names, words, titles.union(regions)]


def _reference_keys(
    spark: SparkSession, sf: str, collation: str = "ignore_case"
) -> DataFrame:
    return tag.reference_keys(*_reference_tables(spark, sf), collation)


def _lexicon(spark: SparkSession, sf: str) -> DataFrame:
    return lexicon.lexicon_of(_documents(spark, sf))


def _tagged(spark: SparkSession, sf: str, collation: str = "ignore_case") -> DataFrame:
    keys = _reference_keys(spark, sf, collation)
    return tag.tag_lexicon(_lexicon(spark, sf), keys, collation)


def tokenize_documents(spark, sf):
    return _doc_tokens(spark, sf)


def tokenize_keep_numeric(spark, sf):
    return _doc_tokens(spark, sf, numeric="keep")


def tokenize_conversations(spark, sf):
    return tokenize.tokenize(_table(spark, sf, "conversations"), ["conv_id", "turn"])


def tokenize_pages_trec(spark, sf):
    return _page_tokens(spark, sf, "trec")


def tokenize_pages_html(spark, sf):
    return _page_tokens(spark, sf, "html")


def page_tags(spark, sf):
    events = tokenize.tag_events(_table(spark, sf, "pages"), "page_id", "html")
    # Counted per page first, so that the distinct count needs no wider shuffle.
    per_page = events.groupBy("tag", "type", "page_id").agg(F.count("*").alias("k"))
    return per_page.groupBy("tag", "type").agg(
        F.sum("k").alias("n"), F.count("*").alias("n_pages")
    )


def token_types(spark, sf):
    tokens = _page_tokens(spark, sf, "trec", with_tags=True)
    rendered = render.token_string().alias("rendered")
    return tokens.select("page_id", "position", "type", rendered)


def entity_counts(spark, sf):
    return tokenize.entity_counts(_table(spark, sf, "pages"), "html", "html")


def doc_length(spark, sf):
    return tokenize.doc_stats(_documents(spark, sf))


def doc_length_stored(spark, sf):
    stored = _stored(_doc_tokens(spark, sf, with_final=True))
    return tokenize.doc_lengths(stored, _documents(spark, sf))


def docs_per_source(spark, sf):
    return lexicon.documents_per_source(_documents(spark, sf))


def first_per_source(spark, sf):
    docs = _documents(spark, sf).select("source", "doc_id", "text")
    return corpus.first_per_group(docs, 3)


def document_strings(spark, sf):
    docs = _documents(spark, sf)
    stats = tokenize.doc_stats(docs, ["doc_id", "source"])
    return stats.select(
        "doc_id",
        render.document_string().alias("rendered"),
        render.document_json("doc_id", "source").alias("json"),
    )


def final_tokens(spark, sf):
    return _doc_tokens(spark, sf, with_final=True).where("is_final")


def last_tokens(spark, sf):
    return tokenize.last_tokens(_documents(spark, sf))


def last_tokens_stored(spark, sf):
    flagged = tokenize.with_last_flag(_stored(_doc_tokens(spark, sf)))
    return flagged.where("is_last").drop("is_last")


def lexicon_query(spark, sf):
    return _lexicon(spark, sf)


def lexicon_pages(spark, sf):
    return lexicon.lexicon_of(_table(spark, sf, "pages"), "html", markup="html")


def phrases(spark, sf):
    return tokenize.phrases(_documents(spark, sf))


def numeric_dropped(spark, sf):
    kept, dropped = {"numeric": "keep"}, {"numeric": "drop"}
    return compare.reconcile_readings(_documents(spark, sf), kept, dropped)


def reconcile_tokens(spark, sf):
    pages = _table(spark, sf, "pages")
    trec, html = {"markup": "trec"}, {"markup": "html"}
    return compare.reconcile_readings(pages, trec, html, "page_id", "html")


def align_tokens(spark, sf):
    """The least differences between two readings of the pages."""
    pages = _table(spark, sf, "pages")
    trec, html = {"markup": "trec"}, {"markup": "html"}
    return align.align_readings(pages, trec, html, "page_id", "html")


def _stored(tokens: DataFrame) -> DataFrame:
    path = fresh_path(tokens.sparkSession, "token-table")
    sinks.write_token_table(tokens, path)
    return tokens.sparkSession.read.schema(tokens.schema).parquet(path)


def reconcile_stored(spark, sf):
    """The join, for two token tables that are stored."""
    pages = [_stored(_page_tokens(spark, sf, m)) for m in ("trec", "html")]
    return compare.reconcile(*pages, "page_id")


def moved_tokens(spark, sf):
    """Tokens with bare numbers kept that are not at the same place without."""
    kept = _stored(_doc_tokens(spark, sf, numeric="keep"))
    return compare.different_places(kept, _stored(_doc_tokens(spark, sf)))


def tag_lexicon(spark, sf):
    return _tagged(spark, sf)


def tag_exact_case(spark, sf):
    return _tagged(spark, sf, "exact")


def tag_ignore_accents(spark, sf):
    return _tagged(spark, sf, "ignore_accents")


def missing_tokens(spark, sf):
    return tag.missing_tokens(_lexicon(spark, sf), _reference_keys(spark, sf))


def known_tokens(spark, sf):
    return tag.known_tokens(_lexicon(spark, sf), _reference_keys(spark, sf))


def names_tokens(spark, sf):
    return tag.of_kind(_tagged(spark, sf), "names")


def kind_counts(spark, sf):
    return jobs.corpus_report(_documents(spark, sf), _reference_keys(spark, sf))


def tokens_processed(spark, sf):
    return tag.tokens_processed(_tagged(spark, sf))


def tag_tokens(spark, sf):
    return tag.tag_tokens(_doc_tokens(spark, sf), _reference_keys(spark, sf))


def tag_tokens_shuffled(spark, sf):
    """The way taken when the reference tables are too large to broadcast."""
    keys = _reference_keys(spark, sf)
    return tag.tag_tokens(_doc_tokens(spark, sf), keys, broadcast_bytes=0)


def _trec_files(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """A folder of files, and the documents that the format cannot hold."""
    path = fresh_path(spark, "trec")
    return path, sinks.write_trec(_documents(spark, sf), path)


def _numbered(documents: DataFrame) -> DataFrame:
    """Use the number in the file as id, to compare with the table."""
    return documents.withColumn("doc_id", F.col("orig_id").cast("bigint"))


def _read_tokens(documents: DataFrame) -> DataFrame:
    return tokenize.tokenize(_numbered(corpus.well_formed(documents)), markup="trec")


def trec_round_trip(spark, sf):
    path, rest = _trec_files(spark, sf)
    return _read_tokens(corpus.read_corpus(spark, path)).union(tokenize.tokenize(rest, markup="trec"))


def read_documents(spark, sf):
    """The same by the data source, in ranges that cut most documents."""
    path, rest = _trec_files(spark, sf)
    read = corpus.read_documents(spark, path, split=1 << 20)
    return _read_tokens(read).union(tokenize.tokenize(rest, markup="trec"))


def _token_stream(spark: SparkSession, path: str) -> DataFrame:
    return _read_tokens(corpus.stream_corpus(spark, path, max_files=2))


def _run_stream(spark: SparkSession, rows: DataFrame) -> DataFrame:
    path, state = fresh_path(spark, "stream"), fresh_path(spark, "stream-state")
    streams.write_token_stream(rows, path, state).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


def stream_tokenize(spark, sf):
    path, rest = _trec_files(spark, sf)
    streamed = _run_stream(spark, _token_stream(spark, path))
    return streamed.union(tokenize.tokenize(rest, markup="trec"))


def stream_documents(spark, sf):
    """The same by the data source, which keeps documents whole."""
    path, rest = _trec_files(spark, sf)
    arriving = corpus.stream_documents(spark, path, fresh_path(spark, "stream-log"), split=1 << 20)
    streamed = _run_stream(spark, _read_tokens(arriving))
    return streamed.union(tokenize.tokenize(rest, markup="trec"))


def stream_tag_tokens(spark, sf):
    path, rest = _trec_files(spark, sf)
    keys = _reference_keys(spark, sf)
    columns = ["doc_id", "position", "token", "kind"]
    tagged = tag.tag_tokens(_token_stream(spark, path), keys).select(*columns)
    others = tag.tag_tokens(tokenize.tokenize(rest, markup="trec"), keys)
    return _run_stream(spark, tagged).union(others.select(*columns))


def stream_lexicon(spark, sf):
    files, rest = _trec_files(spark, sf)
    path, state = fresh_path(spark, "counts"), fresh_path(spark, "counts-state")
    streams.write_counts(_token_stream(spark, files), path, state).awaitTermination()
    others = lexicon.lexicon_of(rest, markup="trec")
    counts = streams.read_counts(spark, path).union(others)
    return counts.groupBy("token").agg(F.sum("n").alias("n"))


def running_lexicon(spark, sf):
    """The last version of a lexicon that grew with every micro-batch of a stream."""
    files, rest = _trec_files(spark, sf)
    store = lexicon_store.LexiconStore(fresh_path(spark, "lexicon"))
    state = fresh_path(spark, "lexicon-state")
    lexicon_store.write_lexicon(_token_stream(spark, files), store, state).awaitTermination()
    counts = store.read(spark).union(lexicon.lexicon_of(rest, markup="trec"))
    return counts.groupBy("token").agg(F.sum("n").alias("n"))


def page_metrics(spark, sf):
    """What reading the pages counts by the way."""
    documents, tokens = Observation("documents"), Observation("tokens")
    pages = metrics.observe_documents(_table(spark, sf, "pages"), documents, "html", "html")
    read = tokenize.tokenize(pages, "page_id", "html", markup="html")
    _stored(metrics.observe_tokens(read, tokens))
    found = documents.get | tokens.get
    names = ("n_documents", "n_kept", "n_dropped", "n_unknown", "n_processed")
    return spark.range(1).select(*[F.lit(found[n]).cast("bigint").alias(n) for n in names])


def token_file(spark, sf):
    """Directory of files to token file, read back as a lexicon."""
    files, rest = _trec_files(spark, sf)
    path = fresh_path(spark, "tokens")
    jobs.print_tokens(spark, files, path, with_final=True)
    others = tokenize.tokenize(rest, markup="trec", with_final=True)
    return lexicon.build_lexicon(tables.read_lexicon(spark, path).union(others.select("token")))


def missing_file(spark, sf):
    path, out = fresh_path(spark, "tokens"), fresh_path(spark, "missing")
    sinks.write_tokens(_doc_tokens(spark, sf), path)
    jobs.tag_words(spark, path, _reference_keys(spark, sf), out)
    return tables.read_lexicon(spark, out)


def malformed_documents(spark, sf):
    """Files that hold sound documents, documents without a number (German), with
    the text before the number (Spanish), and documents cut off (French)."""
    number = F.format_string("<DOCNO>%d</DOCNO>", F.col("doc_id"))
    text = F.concat(F.lit("<TEXT>"), F.col("text"), F.lit("</TEXT>"))
    end = F.lit("</DOC>")
    body = (
        F.when(F.col("lang") == "de", F.concat(text, end))
        .when(F.col("lang") == "es", F.concat(text, number, end))
        .when(F.col("lang") == "fr", F.concat(number, text))
        .otherwise(F.concat(number, text, end))
    )
    path = fresh_path(spark, "malformed")
    rows = _documents(spark, sf)
    rows = rows.select("lang", F.concat(F.lit("<DOC>"), body).alias("value"))
    rows.write.partitionBy("lang").text(path)
    read = corpus.read_corpus(spark, path)
    reason = F.coalesce("malformed", F.lit("none")).alias("malformed")
    whole = F.when(F.col("malformed").isNull(), F.col("orig_id"))
    return read.groupBy(reason).agg(
        F.count("*").alias("n"), F.count_distinct(whole).alias("n_ids")
    )


def _value_of(folder: str) -> Column:
    """The value of the column that the folders of files are named for."""
    value = F.url_decode(F.regexp_extract("source", f"/{folder}=([^/]*)/[^/]*$", 1))
    return F.when(value != "__HIVE_DEFAULT_PARTITION__", value).alias(folder)


def corpus_ids(spark, sf):
    """Files by language in which every number is given many times."""
    path = fresh_path(spark, "ids")
    number = F.pmod("doc_id", F.lit(7)).alias("doc_id")
    docs = _documents(spark, sf).select("lang", number, "text")
    sinks.write_trec(docs, path, by="lang", escape=True)
    read = corpus.well_formed(corpus.read_corpus(spark, path))
    return read.groupBy(_value_of("lang")).agg(
        F.count("*").alias("n"),
        F.count_distinct("doc_id").alias("n_ids"),
        F.count_distinct("orig_id").alias("n_numbers"),
    )


def _by_source(spark: SparkSession, sf: str) -> str:
    """A folder of files for each source, in the order of the table; a large source is
    several files, whose names are in that order too."""
    path = fresh_path(spark, "by-source")
    docs = _documents(spark, sf).select("source", "doc_id", "text")
    rows = docs.repartitionByRange("source", "doc_id").sortWithinPartitions("source", "doc_id")
    sinks.write_trec(rows, path, by="source", escape=True)
    return path


def first_per_file(spark, sf):
    """The first three documents of each file, and of these the first of each source."""
    read = corpus.read_documents(spark, _by_source(spark, sf), per_file=3)
    number = F.col("orig_id").cast("bigint").alias("doc_id")
    rows = read.select(_value_of("source"), number, F.col("source").alias("file"), "begin")
    return corpus.first_rows(rows, 3, "source", ["file", "begin"]).select("source", "doc_id")


def docs_per_file(spark, sf):
    read = corpus.read_corpus(spark, _by_source(spark, sf))
    return lexicon.documents_per_source(read.withColumn("source", _value_of("source")))


def first_documents(spark, sf):
    """Any hundred documents, and how many of them are whole rows of the table."""
    docs = _documents(spark, sf)
    few = corpus.first_documents(docs, 100)
    same = docs.select("doc_id", F.md5("text").alias("digest")).distinct()
    found = few.select("doc_id", F.md5("text").alias("digest")).join(same, ["doc_id", "digest"], "left_semi")
    return found.agg(F.count("*").alias("n"))


def file_pattern(spark, sf):
    """Files told apart by the ends of their names; only those of one kind are read."""
    path = fresh_path(spark, "pattern")
    docs = _documents(spark, sf)
    english = F.col("lang").eqNullSafe("en")
    for which, compression in ((english, "none"), (~english, "gzip")):
        sinks.write_trec(docs.where(which), f"{path}/{compression}", escape=True, compression=compression)
    read = corpus.read_corpus(spark, path, pattern=r"\.txt$")
    return read.select(F.col("orig_id").cast("bigint").alias("doc_id"))


# Letters and signs, and the entities that are kept for them.
ENTITIES = {
    "é": "eacute", "ü": "uuml", "ñ": "ntilde", "á": "aacute", "í": "iacute", "ó": "oacute",
    "-": "hyph", "'": "rsquo",
}


def tokenize_entities(spark, sf):
    """Texts whose accents and hyphens are spelled as entities."""
    text = F.col("text")
    for letter, name in ENTITIES.items():
        text = F.replace(text, F.lit(letter), F.lit(f"&{name};"))
    docs = _documents(spark, sf).withColumn("text", text)
    return tokenize.tokenize(docs, markup="trec")


def tag_read_reference(spark, sf):
    """Reference tables that are read from where they are stored."""
    read = []
    for words in _reference_tables(spark, sf):
        path = fresh_path(spark, "reference")
        words.write.parquet(path)
        read.append(tables.read_reference(spark, words.columns[0], path=path))
    return tag.tag_lexicon(_lexicon(spark, sf), tag.reference_keys(*read))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: documents to word and token counts per kind."""
    return kind_counts(spark, SMALL)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [
        tokenize_documents,
        tokenize_keep_numeric,
        tokenize_conversations,
        tokenize_pages_trec,
        tokenize_pages_html,
        page_tags,
        token_types,
        entity_counts,
        doc_length,
        doc_length_stored,
        docs_per_source,
        first_per_source,
        document_strings,
        final_tokens,
        last_tokens,
        last_tokens_stored,
        lexicon_pages,
        phrases,
        numeric_dropped,
        reconcile_tokens,
        align_tokens,
        tag_lexicon,
        tag_exact_case,
        tag_ignore_accents,
        missing_tokens,
        known_tokens,
        names_tokens,
        kind_counts,
        tokens_processed,
        tag_tokens,
        tag_tokens_shuffled,
        trec_round_trip,
        read_documents,
        stream_tokenize,
        stream_documents,
        stream_tag_tokens,
        stream_lexicon,
        running_lexicon,
        page_metrics,
        token_file,
        missing_file,
        malformed_documents,
        reconcile_stored,
        moved_tokens,
        corpus_ids,
        first_per_file,
        docs_per_file,
        first_documents,
        file_pattern,
        tokenize_entities,
        tag_read_reference,
    ]
    found = {"lexicon": lexicon_query, **{q.__name__: q for q in listed}}
    if registry is not None:
        found |= registry.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle.build()
    if registry is not None:
        found |= registry.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
