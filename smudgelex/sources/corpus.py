"""Directories of SGML files to one row per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smudgelex.functions.tokens import token_array, up_to_last_tag_end
from smudgelex.sources import reader as source

DEFAULT_PATTERN = source.DEFAULT_PATTERN

_START = "<DOC>"
_END = "</DOC>"
_PLACE = ("_block", "_row", "_piece")


def check_pattern(spark: SparkSession, pattern: str) -> None:
    """Raise on a pattern Spark cannot compile, before any file is listed."""
    spark.sql("SELECT '' RLIKE :p", args={"p": pattern}).collect()


def _file_name() -> Column:
    # The hidden column is URL-encoded, but a plus sign in it is a plus sign.
    return F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))


def _scan(reader, root: str, pattern: str) -> DataFrame:
    """``(value, source, _block, _row)``, one row per start tag.

    Such a source is still splittable, so a large file is read by many tasks and never
    becomes one row. Row numbers rise within a split, and splits are ordered by their
    offset, so block and row are a document's place in its file.
    """
    rows = reader.option("recursiveFileLookup", True).option("lineSep", _START)
    rows = rows.text(root).where(F.rlike(_file_name(), F.lit(pattern)))
    # A stream has no row numbers; there the text itself tells the rows of a split apart.
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    row = F.md5("value") if rows.isStreaming else row
    return rows.select(
        "value",
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("_block"),
        row.alias("_row"),
    )


def _between(text: Column, start: str, end: str) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?s){start}(.*?)(?:{end}|\z)"), F.lit(1))


def _plain_markup(value: Column | str) -> Column:
    """Without what comments and tags hold, so that the tags of the format stand out.

    A comment ends at the first ``>``, whatever tags it holds, and a tag that was opened
    before another one swallows it. Both end in ``>``, so only the text up to the last
    one is searched, where every comment finds its end; tag names have a bound.
    """

    def cut(x: Column) -> Column:
        tagged = F.regexp_replace(up_to_last_tag_end(x), "<![^>]*>", "<!>")
        tagged = F.regexp_replace(tagged, r"<[^\s<>!][^\s<>]{0,255}<[^\s>]{0,255}>", "<!>")
        return F.concat(tagged, F.substring_index(x, ">", -1))

    def guarded(x: Column) -> Column:
        # Most texts hold neither, which one search tells.
        return F.when(F.rlike(x, F.lit(r"<(?:!|[^\s<>!][^\s<>]{0,255}<)")), cut(x)).otherwise(x)

    value = F.col(value) if isinstance(value, str) else value
    return F.get(F.transform(F.array(value), guarded), F.lit(0))


def _rejoined(rows: DataFrame) -> DataFrame:
    """Put documents together again that a start tag in their text cut apart.

    A row that begins with no document number goes on with the row before it, if that
    one left a document open. Only rows that are odd in this way are moved; they are
    put in order by file.
    """
    # As one value, since a filter computes what it tests anew wherever it is named.
    def state(plain: Column) -> Column:
        ended = F.contains(plain, F.lit(_END))
        tail = F.substring_index(plain, _END, -1)
        opened = F.contains(tail, F.lit("<DOCNO>")) | F.contains(tail, F.lit("<TEXT>"))
        goes_on = ~F.contains(F.substring_index(plain, _END, 1), F.lit("</DOCNO>"))
        return F.when(goes_on, F.when(opened | ~ended, "both").otherwise("goes on")).when(opened, "open").otherwise("sound")

    state_of = F.get(F.transform(F.array(_plain_markup("value")), state), F.lit(0))
    rows = rows.select("*", state_of.alias("_state"))
    odd = F.col("_state") != "sound"
    rows = rows.select(
        "*",
        F.col("_state").isin("open", "both").alias("_open"),
        F.col("_state").isin("goes on", "both").alias("_goes_on"),
    )
    place = Window.partitionBy("source").orderBy("_block", "_row")
    before = lambda c: F.lag(c).over(place)
    follows = F.when(
        F.col("_block") == before("_block"), F.col("_row") == before("_row") + 1
    ).otherwise(F.col("_row") == 0)
    linked = F.coalesce(F.col("_goes_on") & before("_open") & follows, F.lit(False))
    chains = rows.where(odd).select("*", F.sum((~linked).cast("int")).over(place).alias("_chain"))
    parts = F.array_sort(F.collect_list(F.struct("_block", "_row", "value")))
    whole = chains.groupBy("source", "_chain").agg(parts.alias("p")).select(
        F.array_join(F.transform("p", lambda p: p["value"]), _START).alias("value"),
        "source",
        F.get("p", F.lit(0))["_block"].alias("_block"),
        F.get("p", F.lit(0))["_row"].alias("_row"),
    )
    sound = rows.where(~odd).select("value", "source", "_block", "_row")
    return sound.unionByName(whole)


def extract_documents(rows: DataFrame) -> DataFrame:
    """Columns ``value`` and ``source`` to documents; other columns stay.

    ``malformed`` says why a document cannot be read; its text is then null. What
    follows the last end tag in a row and holds a tag of the format is a document that
    is ``not closed``. A number found later replaces the document begun before. The
    ``doc_id`` is a digest of the file, the place in it as far as other columns tell,
    and the number.
    """
    kept = [c for c in rows.columns if c not in ("value", "source")]
    rows = rows.select("source", *kept, F.split(_plain_markup("value"), _END).alias("_pieces"))
    last = F.size("_pieces") - 1
    # An inner generator of a column would be filtered by its size, which cuts the text twice.
    pieces = F.posexplode_outer("_pieces").alias("_piece", "body")
    docs = rows.select("source", *kept, pieces, last.alias("_last"))
    unclosed = F.col("_piece") == F.col("_last")
    begun = F.contains("body", F.lit("<DOCNO>")) | F.contains("body", F.lit("<TEXT>"))
    docs = docs.where(~unclosed | begun)

    numbered = F.contains("body", F.lit("</DOCNO>"))
    head = F.substring_index("body", "</DOCNO>", 1)
    after = F.substring_index("body", "</DOCNO>", -1)
    before = F.left("body", F.length("body") - F.length(after))
    malformed = (
        F.when(unclosed, "not closed")
        .when(~numbered, "no document number")
        .when(F.contains(head, F.lit("<TEXT>")), "text before document number")
    )
    # A text section that was open when the number was read stays open.
    opened = F.contains(before, F.lit("<TEXT>")) & ~F.contains(
        F.substring_index(before, "<TEXT>", -1), F.lit("</TEXT>")
    )
    after = F.concat(F.when(opened, "<TEXT>").otherwise(""), after)
    # A number that is opened and never closed takes the rest of the document.
    after = F.substring_index(after, "<DOCNO>", 1)
    sections = _between(after, "<TEXT>", "</TEXT>")
    number = F.regexp_extract(before, r"(?s)^.*<DOCNO>(.*?</DOCNO>)", 1)
    docs = docs.select(
        F.when(numbered, number).alias("number"),
        "source",
        F.when(malformed.isNull(), sections).alias("sections"),
        malformed.alias("malformed"),
        *kept,
        "_piece",
    )
    # The tags between sections stay, since they end words and phrases.
    joined = F.concat(F.array_join("sections", "</TEXT><TEXT>"), F.lit("</TEXT>"))
    text = F.when(F.size("sections") == 0, "").otherwise(joined)
    words = F.filter(
        token_array("number", "trec", "keep"), lambda t: t["type"] == "TEXT"
    )
    orig_id = F.when(F.col("number").isNotNull(), F.array_join(words["token"], ""))
    docs = docs.select(
        orig_id.alias("orig_id"),
        "source",
        text.alias("text"),
        "malformed",
        *kept,
        "_piece",
    )
    place = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", *kept, "_piece")]
    number = F.coalesce("orig_id", F.lit(""))
    return docs.select(F.md5(F.concat_ws("\n", *place, number)).alias("doc_id"), "*")


def _documents(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "orig_id", "source", "text", "malformed")


def read_corpus(
    spark: SparkSession,
    root: str,
    pattern: str = DEFAULT_PATTERN,
    per_file: int | None = None,
) -> DataFrame:
    """``(doc_id, orig_id, source, text, malformed)`` of all files below ``root``.

    ``pattern`` is searched in the file name. ``per_file`` keeps the first n closed
    documents of each file. Names that begin with ``_`` or ``.`` are hidden from
    Spark's file sources. No document is left out: one that is not closed is a row with
    that reason. A ``doc_id`` is unique, and stays the same as long as the files, their
    order and the size of splits do.
    """
    check_pattern(spark, pattern)
    docs = extract_documents(_rejoined(_scan(spark.read, root, pattern)))
    if per_file is not None:
        closed = docs.where(~F.col("malformed").eqNullSafe("not closed"))
        docs = first_rows(closed, per_file, "source", _PLACE)
    return _documents(docs)


def stream_corpus(
    spark: SparkSession,
    root: str,
    pattern: str = DEFAULT_PATTERN,
    max_files: int | None = None,
) -> DataFrame:
    """The same documents as a stream of the files that arrive below ``root``.

    A document that a start tag in its own text cuts apart is not put together again
    here, since a stream has no order to go by: its parts are malformed rows, ``not
    closed`` and ``no document number``. Documents of one split share an id only if they
    are equal to the byte.
    """
    check_pattern(spark, pattern)
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _documents(extract_documents(_scan(reader, root, pattern)))


def _from_source(rows: DataFrame) -> DataFrame:
    """Parts of a document longer than the bound have no text, but are not left out."""
    cut = F.col("state") != "whole"
    value = F.when(cut, _END).otherwise(F.col("value"))
    docs = extract_documents(rows.withColumn("value", value))
    reason = F.when(cut, "too long").otherwise(F.col("malformed"))
    return docs.withColumn("malformed", reason)


def read_documents(
    spark: SparkSession,
    root: str,
    pattern: str = DEFAULT_PATTERN,
    per_file: int | None = None,
    split: int = source.SPLIT,
    longest: int = source.LONGEST,
) -> DataFrame:
    """``(doc_id, orig_id, source, begin, text, malformed)`` of all files below ``root``.

    The same documents as ``read_corpus``, by the data source ``sgml_documents``: files
    are cut at the places where documents begin, so nothing is put together again, and
    ``doc_id`` depends on the file and the offset ``begin`` only, not on the size of
    splits. Names that begin with ``_`` are read. A file without tags is read in parts
    of at most ``longest`` bytes, each a row that is ``too long``. With ``per_file`` the
    rest of a file is not read once n closed documents were found.

    It reads where Arrow does (local, HDFS, S3, GCS, Azure), in Python workers; for
    other stores there is ``read_corpus``.
    """
    source.register(spark)
    rows = spark.read.format(source.NAME).option("pattern", pattern)
    rows = rows.option("split", split).option("longest", longest)
    if per_file is not None:
        rows = rows.option("perFile", per_file)
    docs = _from_source(rows.load(root))
    if per_file is not None:
        docs = docs.where(~F.col("malformed").eqNullSafe("not closed"))
    return _placed(docs)


def stream_documents(
    spark: SparkSession,
    root: str,
    log: str,
    pattern: str = DEFAULT_PATTERN,
    split: int = source.SPLIT,
    longest: int = source.LONGEST,
) -> DataFrame:
    """The rows of ``read_documents`` as a stream of the files that arrive, each whole.

    ``log`` is a folder for the lists of files, in a store that the driver can write;
    a micro-batch reads what is new since the last one.
    """
    source.register(spark)
    rows = spark.readStream.format(source.NAME).option("pattern", pattern).option("log", log)
    rows = rows.option("split", split).option("longest", longest)
    return _placed(_from_source(rows.load(root)))


def _placed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "orig_id", "source", "begin", "text", "malformed")


def well_formed(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("malformed").isNull())


def quarantined(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("malformed").isNotNull())


def first_documents(documents: DataFrame, n: int) -> DataFrame:
    """Any ``n`` documents, as they arrive."""
    return documents.limit(n)


def first_rows(
    df: DataFrame, n: int, group: str, order: Sequence[str], parts: int = 64
) -> DataFrame:
    """The first ``n`` rows of each group.

    Ranked within parts of a group before they are ranked within the group, so the
    rows of a group that holds much of the data are sorted by many tasks and at most
    ``parts * n`` of them meet in one.
    """
    part = F.pmod(F.xxhash64(*order), F.lit(parts)).alias("_part")
    ranked = df.select("*", part)
    for keys in ([group, "_part"], [group]):
        window = Window.partitionBy(*keys).orderBy(*order)
        ranked = ranked.withColumn("_n", F.row_number().over(window))
        ranked = ranked.where(F.col("_n") <= n).drop("_n")
    return ranked.drop("_part")


def first_per_group(
    documents: DataFrame, n: int, group: str = "source", order: str = "doc_id"
) -> DataFrame:
    """The first ``n`` documents of each source of a table."""
    return first_rows(documents, n, group, [order])
