"""A stream of files gives what a batch over the same files gives."""

from smudgelex import (
    read_corpus,
    reference_keys,
    stream_corpus,
    tag_tokens,
    tokenize,
    write_token_stream,
)
from smudgelex.operators.lexicon import build_lexicon
from smudgelex.sources.corpus import well_formed
from smudgelex.streaming.jobs import compact_counts, read_counts, write_counts

DOC = "<DOC><DOCNO>{0}</DOCNO><TEXT>word{0} same, &eacute; 12 {0}</TEXT></DOC>\n"


def write(folder, name, ids):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(DOC.format(i) for i in ids))


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    root, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    write(root, "one.txt", range(20))

    def run():
        docs = well_formed(stream_corpus(spark, str(root), max_files=1))
        tokens = tokenize(docs, ["orig_id", "source"], markup="trec")
        write_token_stream(tokens, out, state).awaitTermination()

    def batch():
        docs = well_formed(read_corpus(spark, str(root)))
        return tokenize(docs, ["orig_id", "source"], markup="trec")

    run()
    write(root, "two.txt", range(20, 50))
    run()
    run()  # nothing new arrives, nothing is written again
    got, want = spark.read.parquet(out), batch()
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert got.count() > 100


def test_tagging_a_stream(spark, tmp_path):
    root, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    write(root, "one.txt", range(20))
    one = spark.createDataFrame([("same",)], "w string")
    keys = reference_keys(one, one, one)
    tokens = tokenize(stream_corpus(spark, str(root)), markup="trec")
    write_token_stream(tag_tokens(tokens, keys), out, state).awaitTermination()
    got = spark.read.parquet(out)
    assert got.where("kind = 'names'").count() == 20
    assert got.where("token = 'same' and kind <> 'names'").count() == 0


def test_running_lexicon(spark, tmp_path):
    root, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    write(root, "one.txt", range(10))
    write(root, "two.txt", range(10, 15))
    tokens = tokenize(stream_corpus(spark, str(root), max_files=1), markup="trec")
    write_counts(tokens, out, state).awaitTermination()
    want = build_lexicon(tokenize(read_corpus(spark, str(root)), markup="trec"))

    def same(path):
        got = read_counts(spark, path)
        return got.exceptAll(want).count() == want.exceptAll(got).count() == 0

    assert same(out)
    write_counts(tokens, out, state).awaitTermination()  # nothing new
    assert same(out)
    # A batch that is run again replaces its own counts.
    commits = tmp_path / "state" / "commits"
    last = max(int(p.name) for p in commits.glob("[0-9]*"))
    for name in (f"{last}", f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)
    write_counts(tokens, out, state).awaitTermination()
    assert same(out)
    compact_counts(spark, out, out + "-sum")
    assert same(out + "-sum")
