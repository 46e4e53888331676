"""The data source: cuts, splits, bounds, streams."""

import gzip
import io
import os
import random

import pytest
from smudgelex.sources import boundaries as b
from smudgelex.sources import reader as r
from smudgelex.sources.corpus import quarantined, read_corpus, read_documents, stream_documents, well_formed

from tests.test_corpus import SAMPLE, STATES, texts, write

MARKS = [
    "<DOC>", "</DOC>", "<DOCNO>1</DOCNO>", "<DOCNO>", "</DOCNO>", "<TEXT>", "</TEXT>",
    "x y ", "<!", "<!-- ", "-->", ">", "<a", "<b ", "\n", "word" * 5,
]


def cut(data, begin, end, block, longest):
    f = io.BytesIO(data)

    def read_at(a, n):
        f.seek(a)
        return f.read(n)

    at = b.look_back(read_at, begin, 7) if begin else 0
    f.seek(at)
    return list(b.pieces(f.read, at, begin, end, block, longest))


def test_splits_and_blocks_do_not_matter():
    rng = random.Random(1)
    for _ in range(1500):
        data = "".join(rng.choices(MARKS, k=rng.randint(0, 60))).encode()
        longest = rng.choice([50, 1000])
        whole = cut(data, 0, None, 1 << 20, longest)
        assert b"".join(p.data for p in whole) == data
        assert all(len(p.data) <= longest for p in whole)
        cuts = sorted({0, *(rng.randint(1, max(1, len(data))) for _ in range(rng.randint(0, 5)))})
        parts = zip(cuts, [*cuts[1:], None], strict=True)
        assert [p for s, e in parts for p in cut(data, s, e, rng.choice([1, 3, 17, 1 << 20]), longest)] == whole


def test_same_documents_as_the_text_reader(spark, tmp_path):
    write(tmp_path, "sample.sgml", SAMPLE)
    for name, (text, _) in STATES.items():
        write(tmp_path, f"deep/{name}.txt", text)
    doc = "<DOC><DOCNO>{0}</DOCNO><TEXT>{1}</TEXT></DOC>\n"
    odd = [("c", "aa <!-- <DOC> --> bb"), ("t", "dd <DOC> ee"), ("m", "x <DOC> y <DOC> z")]
    write(tmp_path, "in.txt", "".join(doc.format(*d) for d in odd) + "<DOC><TEXT>no number</TEXT></DOC>")
    key = lambda x: tuple(v or "" for v in x)
    first = None
    for split in (1 << 20, 40, 7):
        docs = read_documents(spark, str(tmp_path), split=split)
        got = docs.collect()
        ids = {x.doc_id: (x.orig_id, x.text, x.malformed, x.begin) for x in got}
        assert len(ids) == len(got)
        first = first or ids
        assert ids == first
    plain = read_corpus(spark, str(tmp_path)).select("orig_id", "text", "malformed").collect()
    got = [(x.orig_id, x.text, x.malformed) for x in got]
    assert sorted(got, key=key) == sorted(map(tuple, plain), key=key)
    assert texts(docs)["m"] == ["x", "y", "z"]


def test_names_bad_bytes_compressed_and_empty(spark, tmp_path):
    doc = "<DOC><DOCNO>{}</DOCNO><TEXT>a</TEXT></DOC>"
    for name in ("aa.txt", "_under/_b.txt", "with blank+plus.txt", ".hidden", "c"):
        write(tmp_path, name, doc.format("n" + name.translate({46: "h", 95: "u"})[0]))
    write(tmp_path, "empty.txt", "")
    (tmp_path / "z.gz").write_bytes(gzip.compress(doc.format("nz").encode() * 2))
    (tmp_path / "bad.txt").write_bytes(b"<DOC><DOCNO>bad</DOCNO><TEXT>a\xff b\x00c \xc3\xa9</TEXT></DOC>")
    ids = lambda **o: sorted(x.orig_id for x in read_documents(spark, str(tmp_path), **o).collect())
    assert ids(split=9) == ["bad", "na", "nu", "nw", "nz", "nz"]
    assert ids(pattern=r"blank\+plus") == ["nw"] and ids(pattern="nothing") == []
    assert texts(read_documents(spark, f"file://{tmp_path}", pattern="bad")) == {"bad": ["a", "b", "c", "é"]}
    assert read_documents(spark, str(tmp_path / "nowhere")).count() == 0
    with pytest.raises(Exception, match="(?i)pattern|unterminated|missing"):
        read_documents(spark, str(tmp_path), pattern="(").collect()


def test_file_without_tags_is_read_in_parts(spark, tmp_path):
    write(tmp_path, "plain.txt", "word " * 2000 + "<!" + "x" * 3000)
    docs = read_documents(spark, str(tmp_path), split=500, longest=1024)
    got = quarantined(docs).collect()
    assert len(got) == -(-13002 // 1024) and {x.malformed for x in got} == {"too long"}
    assert well_formed(docs).count() == 0


class Counted(io.BytesIO):
    read_bytes = 0

    def read(self, n=-1):
        out = super().read(n)
        Counted.read_bytes += len(out)
        return out


def test_few_documents_of_a_file_read_its_head(spark, tmp_path):
    doc = "<DOC><DOCNO>{}</DOCNO><TEXT>{}</TEXT></DOC>\n"
    path = write(tmp_path, "large.txt", "".join(doc.format(i, "word " * 20) for i in range(100_000)))
    got = read_documents(spark, str(tmp_path), per_file=3).collect()
    assert sorted(x.orig_id for x in got) == ["0", "1", "2"]
    assert read_documents(spark, str(tmp_path), per_file=0).count() == 0
    # The same task by hand, with a count of what it reads.
    found = r.CorpusReader({"path": str(tmp_path), "perFile": "3"})
    (task,) = found.partitions()
    fs = type("Fs", (), {"open_input_file": lambda self, p: Counted(path.read_bytes())})()
    assert len(list(found._documents(fs, *task.ranges[0]))) == 3
    assert Counted.read_bytes <= 1 << 16 < path.stat().st_size // 100


def test_stream_reads_what_the_batch_reads(spark, tmp_path):
    root, log = tmp_path / "in", str(tmp_path / "log")
    doc = "<DOC><DOCNO>{0}</DOCNO><TEXT>a{0} <DOC> b <!-- </DOC> --> c</TEXT></DOC>\n"
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream = stream_documents(spark, str(root), log, split=100)
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        query.trigger(availableNow=True).start().awaitTermination()
        return sorted(map(tuple, spark.read.parquet(out).select("doc_id", "orig_id", "text", "malformed").collect()))

    def batch():
        docs = read_documents(spark, str(root)).select("doc_id", "orig_id", "text", "malformed")
        return sorted(map(tuple, docs.collect()))

    write(root, "one.txt", "".join(doc.format(i) for i in range(50)))
    first = run()
    assert first == batch() and len(first) == 50 and all(x[3] is None for x in first)
    assert run() == first
    # A file that arrives late with an old date is read, and nothing is read twice.
    os.utime(write(root, "deep/two.txt", "".join(doc.format(i) for i in range(50, 70))), (1, 1))
    assert run() == batch() and len(batch()) == 70
