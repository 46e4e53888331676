"""Reading files: splitting, numbers, sections, malformed documents, limits."""

import time

import pytest
from pyspark.sql import functions as F

from smudgelex import print_tokens, read_corpus, read_lexicon, tokenize
from smudgelex.sources.corpus import (
    first_documents,
    first_per_group,
    quarantined,
    well_formed,
)
from smudgelex.sources.sinks import (
    write_missing,
    write_token_table,
    write_tokens,
    write_trec,
)
from smudgelex.sources.tables import read_reference

SAMPLE = """<DOC>
<DOCNO> A-1 </DOCNO>
<TEXT>one <P>two</P></TEXT>
<TEXT>three</TEXT>
</DOC>
<DOC>
<DOCNO>A-2</DOCNO>
<TEXT>four
</TEXT></DOC>
<DOC><TEXT>bad</TEXT></DOC>
<DOC><DOCNO>A-3</DOCNO><TEXT>cut
"""


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return path


def texts(docs):
    rows = tokenize(
        well_formed(docs), ["orig_id"], markup="trec", numeric="keep"
    ).collect()
    out = {r.orig_id: [] for r in well_formed(docs).select("orig_id").collect()}
    for r in sorted(rows, key=lambda r: r.position):
        out[r.orig_id].append(r.token)
    return out


def test_sample(spark, tmp_path):
    write(tmp_path, "sample.sgml", SAMPLE)
    docs = read_corpus(spark, str(tmp_path))
    assert docs.columns == ["doc_id", "orig_id", "source", "text", "malformed"]
    assert texts(docs) == {"A-1": ["one", "two", "three"], "A-2": ["four"]}
    bad = sorted((r.malformed, r.orig_id, r.text) for r in quarantined(docs).collect())
    assert bad == [("no document number", None, None), ("not closed", "A-3", None)]
    positions = tokenize(well_formed(docs), "orig_id", markup="trec")
    got = positions.where("orig_id = 'A-1'").orderBy("position").collect()
    assert [(r.token, r.position) for r in got] == [("one", 1), ("two", 2), ("three", 3)]
    assert docs.select("doc_id").distinct().count() == docs.count() == 4


def test_one_number_two_documents(spark, tmp_path):
    doc = "<DOC><DOCNO>X</DOCNO><TEXT>{}</TEXT></DOC>"
    write(tmp_path, "two.txt", doc.format("a b") + doc.format("a b c") + doc.format("a b"))
    write(tmp_path, "deep/two.txt", doc.format("a b"))
    docs = read_corpus(spark, str(tmp_path))
    lengths = tokenize(docs, markup="trec").groupBy("doc_id").count().collect()
    assert sorted(r["count"] for r in lengths) == [2, 2, 2, 3]


def test_start_tags_inside_a_document(spark, tmp_path):
    doc = "<DOC><DOCNO>{0}</DOCNO><TEXT>{1}</TEXT></DOC>\n"
    cut = [("c", "aa <!-- <DOC> --> bb"), ("t", "dd <DOC> ee"), ("m", "x <DOC> y <DOC> z")]
    sound = [(f"s{i}", f"w{i}") for i in range(4)]
    order = [sound[0], cut[0], sound[1], cut[1], cut[2], sound[2], sound[3]]
    write(tmp_path, "in.txt", "".join(doc.format(*d) for d in order) + "<DOC><TEXT>no number</TEXT></DOC>")
    docs = read_corpus(spark, str(tmp_path))
    assert texts(docs) == {
        "s0": ["w0"], "s1": ["w1"], "s2": ["w2"], "s3": ["w3"],
        "c": ["aa", "bb"], "t": ["dd", "ee"], "m": ["x", "y", "z"],
    }
    assert [r.malformed for r in quarantined(docs).collect()] == ["no document number"]


def test_rejoined_across_splits(spark, tmp_path):
    docs = [f"<DOC><DOCNO>d{i}</DOCNO><TEXT>a{i} <DOC> b{i}</TEXT></DOC>\n" for i in range(3000)]
    write(tmp_path, "large.txt", "".join(docs))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        got = texts(read_corpus(spark, str(tmp_path)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"d{i}": [f"a{i}", f"b{i}"] for i in range(3000)}


def test_section_opened_inside_another_tag(spark, tmp_path):
    write(tmp_path, "in.txt", "<DOC><DOCNO>4</DOCNO>zz <a<TEXT>x</DOC><DOC><DOCNO>5</DOCNO><b <TEXT>y</DOC>")
    assert texts(read_corpus(spark, str(tmp_path))) == {"4": [], "5": ["y"]}


def test_unclosed_markup_is_read_in_linear_time(spark, tmp_path):
    def seconds(n):
        folder = tmp_path / str(n)
        write(folder, "in.txt", "<DOC><DOCNO>1</DOCNO><TEXT>x</TEXT></DOC>" + "<!" * n + "\n" + "<a" * n)
        start = time.perf_counter()
        assert read_corpus(spark, str(folder)).count() == 1
        return time.perf_counter() - start

    seconds(10)
    assert seconds(400_000) < 20 * max(seconds(40_000), 1)


STATES = {
    # A second number starts the document anew; the section stays open.
    "second": (
        "<DOC><DOCNO>1</DOCNO><TEXT>lost <DOCNO>second</DOCNO> kept</TEXT></DOC>",
        ["kept"],
    ),
    # Tags are matched exactly and with case.
    "case": ("<DOC><DOCNO>case</DOCNO><text>no</text><TEXT a=1>no</TEXT></DOC>", []),
    # A number joined from its parts, symbols and blanks left out.
    "ab12": ("<DOC><DOCNO> ab (12) </DOCNO><TEXT>x</TEXT></DOC>", ["x"]),
    # The end of a document ends an open section.
    "open": ("<DOC><DOCNO>open</DOCNO><TEXT>x 12</DOC>", ["x", "12"]),
    # Text outside sections is dropped, and so are tags in comments.
    "out": (
        "<DOC><DOCNO>out</DOCNO>no <!-- <TEXT> --> no<TEXT>yes</TEXT>no</DOC>",
        ["yes"],
    ),
    # Inner tags are ignored, a number before an end tag is kept.
    "inner": ("<DOC><DOCNO>inner</DOCNO><TEXT><A>a</A>28</TEXT></DOC>", ["a", "28"]),
    # Without the start tag.
    "bare": ("<DOCNO>bare</DOCNO><TEXT>x</TEXT></DOC>", ["x"]),
}


def test_reader_states(spark, tmp_path):
    for name, (text, _) in STATES.items():
        write(tmp_path, f"{name}.txt", text)
    got = texts(read_corpus(spark, str(tmp_path)))
    assert got == {name: want for name, (_, want) in STATES.items()}


def test_malformed_reasons(spark, tmp_path):
    write(tmp_path, "aa", "<DOC><TEXT>x</TEXT><DOCNO>1</DOCNO></DOC><DOC>y</DOC>")
    got = read_corpus(spark, str(tmp_path)).collect()
    assert sorted(r.malformed for r in got) == [
        "no document number",
        "text before document number",
    ]


def test_bad_bytes_do_not_stop_the_run(spark, tmp_path):
    raw = b"<DOC><DOCNO>1</DOCNO><TEXT>a\xff b\x00c \xc3\xa9</TEXT></DOC>"
    (tmp_path / "bad.txt").write_bytes(raw)
    assert texts(read_corpus(spark, str(tmp_path))) == {"1": ["a", "b", "c", "é"]}


def test_no_files_no_documents(spark, tmp_path):
    assert read_corpus(spark, str(tmp_path)).count() == 0


def test_scan_and_file_pattern(spark, tmp_path):
    doc = "<DOC><DOCNO>{}</DOCNO></DOC>"
    for name in ("aa.txt", "deep/er/bb.txt", "with blank+plus.txt", ".hidden", "c"):
        write(tmp_path, name, doc.format("n" + name[0].replace(".", "h")))
    root = str(tmp_path)

    def ids(**options):
        rows = read_corpus(spark, root, **options).select("orig_id").collect()
        return sorted(r.orig_id for r in rows)

    # Names of one character and hidden names do not match the default.
    assert ids() == ["na", "nd", "nw"]
    assert ids(pattern=r"blank\+plus") == ["nw"]
    assert ids(pattern="^c$") == ["nc"]
    assert ids(pattern="nothing") == []
    with pytest.raises(Exception, match="(?i)pattern|regex"):
        read_corpus(spark, root, pattern="(")


def test_large_file_is_split(spark, tmp_path):
    docs = [f"<DOC><DOCNO>d{i}</DOCNO><TEXT>w{i} é</TEXT></DOC>\n" for i in range(5000)]
    write(tmp_path, "large.txt", "".join(docs))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        read = read_corpus(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 4
        rows = read.select("orig_id", "text").collect()
        first = read_corpus(spark, str(tmp_path), per_file=7).select("orig_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = sorted((f"d{i}", f"w{i} é</TEXT>") for i in range(5000))
    assert sorted((r.orig_id, r.text) for r in rows) == want
    assert sorted(r.orig_id for r in first) == [f"d{i}" for i in range(7)]


def test_limits(spark, tmp_path):
    df = spark.createDataFrame(
        [(s, i) for s in "ab" for i in range(5)], "source string, doc_id int"
    )
    assert first_documents(df, 3).count() == 3
    hot = spark.range(50_000).select(
        F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("source"),
        (-F.col("id")).alias("doc_id"),
    )
    got = first_per_group(hot, 1500).groupBy("source").agg(F.count("*"), F.max("doc_id"))
    want = hot.orderBy("doc_id").where("source = 'a'").limit(1500).agg(F.max("doc_id"))
    rows = {r[0]: (r[1], r[2]) for r in got.collect()}
    assert rows["a"] == (1500, want.first()[0]) and rows["b"][0] == 1500
    got = first_per_group(df, 2).collect()
    assert sorted((r.source, r.doc_id) for r in got) == [
        ("a", 0), ("a", 1), ("b", 0), ("b", 1)
    ]


def test_token_file(spark, tmp_path):
    write(tmp_path, "in/sample.sgml", SAMPLE)
    out = str(tmp_path / "out")
    for final, want in ((False, []), (True, ["", ""])):
        print_tokens(spark, str(tmp_path / "in"), out, with_final=final)
        got = [r.token for r in read_lexicon(spark, out).collect()]
        assert sorted(got) == sorted(["one", "two", "three", "four", *want])


def test_sinks(spark, tmp_path):
    words = spark.createDataFrame([("word1",), ("word2",), ("word3",)], "token string")
    words = words.coalesce(1)
    path = str(tmp_path / "words")
    for _ in range(2):  # written twice, replaced not appended
        write_tokens(words, path)
    got = [r.token for r in read_lexicon(spark, path).collect()]
    assert got == ["word1", "word2", "word3"]
    table = str(tmp_path / "table")
    write_token_table(words, table)
    assert spark.read.parquet(table).count() == 3
    assert read_reference(spark, "token", path=table).columns == ["token"]
    with pytest.raises(ValueError):
        read_reference(spark, "token")
    tagged = words.withColumn(
        "kind", F.when(F.col("token") == "word2", "missing").otherwise("dict")
    )
    write_missing(tagged, str(tmp_path / "missing"))
    rows = read_lexicon(spark, str(tmp_path / "missing")).collect()
    assert [r.token for r in rows] == ["word2"]


def test_trec_files_lose_nothing(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "a b"), (4, "x </TEXT> y"), (5, "p <DOC> q"), (6, "c <! d"), (7, "e < f")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    rejected = write_trec(df, str(tmp_path / "out"))
    assert sorted(r.doc_id for r in rejected.collect()) == [4, 5, 6]
    assert texts(read_corpus(spark, str(tmp_path / "out"))) == {"1": [], "2": [], "3": ["a", "b"], "7": ["e", "f"]}


def test_trec_files_with_entities_and_folders(spark, tmp_path):
    rows = [(1, "a </TEXT> b", "x y"), (2, "c <! d", None), (None, "e < f", "z")]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    assert write_trec(df, str(tmp_path / "out"), by="lang", escape=True).count() == 0
    docs = read_corpus(spark, str(tmp_path / "out")).collect()
    assert sorted(d.orig_id for d in docs) == ["", "1", "2"] and not any(d.malformed for d in docs)
    assert len({d.source.split("lang=")[1].split("/")[0] for d in docs}) == 3
    assert any("a &lt;/TEXT> b" in d.text for d in docs) and any("e < f" in d.text for d in docs)
