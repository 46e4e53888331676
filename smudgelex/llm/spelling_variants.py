"""Spelling variants by partition-and-enumerate signatures of letter multisets.

Words that differ by one inserted, deleted or replaced letter have letter multisets that
differ in at most two places, if a multiset is read as a binary vector with a place for
every letter and number of its occurrence. The places are dealt to ``PARTS`` parts. Two
vectors at a distance of two or less agree in at least ``PARTS - 2`` of them, so a
signature for every choice of that many parts, with the size of the smaller multiset,
finds all of them by an equi-join. A pair that agrees in more parts meets more than
once; it counts only for the first choice in which it can meet, so nothing needs to be
made distinct. Signatures are taken of the distinct multisets, not of the words.

Multisets that passed are then exactly one letter apart, and which letters are missing
on either side is known: replacing (or dropping) them one by one in the words of one
side and looking the results up among the words of the other side verifies all pairs
without comparing each with each. Words of one multiset travel in blocks of ``BLOCK``,
so that no row grows with the corpus.

Words are counted per task before they are shuffled. A word's form is its near word of
largest count, if that is at least twice its own; ``root`` follows forms to the last.
Counts double at every step, so a few rounds of pointer jumping reach all roots, each
written out.

Null and empty texts have no words; a null id is the empty string in the hash that plants
misspellings; repeated rows count again; ties go to the smaller word in code-point
order; an empty table gives no rows; very long texts and words are read whole; other
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smudgelex.llm.common import materialized, slices, table

LEAST_LETTERS = 5
LEAST_COUNT = 3
EVERY = 97
RATIO = 2
DISTANCE = 2
PARTS = 6
# Bits of the digest of a part; all parts fit in one long.
BITS = 10
BLOCK = 64
# Words that a task counts before it hands them on.
HELD_WORDS = 300_000

CHOICES = list(combinations(range(PARTS), PARTS - DISTANCE))
_FIELD = (1 << BITS) - 1


def _first_choice(differing: int) -> int:
    """The first choice without a part that differs; -1 if there is none."""
    for q, parts in enumerate(CHOICES):
        if not any(differing >> p & 1 for p in parts):
            return q
    return -1


# By the bits of the parts that differ.
FIRST_CHOICE = [_first_choice(d) for d in range(1 << PARTS)]
_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LETTERS)


def planted(run: str, start: int) -> str:
    """The run less one letter, if the hash of the id (``start``) and the run says so."""
    h = zlib.crc32(run.encode(), start)
    if h % EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)`` of all words long and frequent enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            for part in slices(batch, 1):
                for key, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    start = zlib.crc32(f"{key}:".encode())
                    # Bytes lower-case A to Z only.
                    for run, n in Counter(_RUN.findall((body or b"").lower().decode())).items():
                        word = planted(run, start)
                        if len(word) >= LEAST_LETTERS:
                            held[word] += n
                if len(held) > HELD_WORDS:
                    yield out()
        yield out()

    rows = df.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"), F.col(text).cast("binary").alias("text"))
    counts = rows.mapInArrow(count, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def vector(letters: str) -> int:
    """Digests of the parts of a sorted multiset, packed into one number."""
    parts = [""] * PARTS
    seen = 0
    for i, letter in enumerate(letters):
        seen = seen + 1 if i and letters[i - 1] == letter else 0
        # A letter and the number of its occurrence are one place of the vector.
        parts[(ord(letter) + 2 * seen) % PARTS] += f"{letter}{seen}"
    return sum((xxhash.xxh3_64_intdigest(p) & _FIELD) << (BITS * k) for k, p in enumerate(parts))


def _vectors(classes: DataFrame) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = pa.array(map(vector, batch.column(0).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["letters", "packed"])

    return classes.mapInArrow(pack, "letters string, packed bigint")


def signatures(vectors: DataFrame) -> DataFrame:
    """``(size, choice, kept, larger, letters, packed)``: a signature is the size of the
    smaller multiset, the choice and the digests of its parts."""
    masks = [sum(_FIELD << (BITS * p) for p in parts) for parts in CHOICES]
    choices = F.array(*[F.struct(F.lit(q).alias("choice"), F.lit(m).cast("bigint").alias("mask")) for q, m in enumerate(masks)])
    size = F.length("letters")
    sides = F.array(*[F.struct((size - k).alias("size"), F.lit(bool(k)).alias("larger")) for k in (0, 1)])
    rows = vectors.select("letters", "packed", F.explode(sides).alias("side"))
    rows = rows.select("letters", "packed", "side.*", F.explode(choices).alias("c"))
    kept = F.col("packed").bitwiseAND(F.col("c.mask"))
    return rows.select("size", "c.choice", kept.alias("kept"), "larger", "letters", "packed")


def _differing(a: Column, b: Column) -> Column:
    """The bits of the parts whose digests are not equal."""
    x = a.bitwiseXOR(b)
    bits = F.lit(0)
    for p in range(PARTS):
        field = x.bitwiseAND(F.lit(_FIELD << (BITS * p)).cast("bigint"))
        bits = bits + F.when(field != 0, 1 << p).otherwise(0)
    return bits


def near_multisets(letters: DataFrame) -> DataFrame:
    """``(a, b)``, each pair once: multisets one letter replaced apart, or ``b`` with one
    letter more. A few others pass; the words decide."""
    signed = signatures(_vectors(letters))
    on = ["size", "choice", "kept"]
    a = signed.where(~F.col("larger")).drop("larger").withColumnsRenamed({"letters": "a", "packed": "pa"})
    b = signed.withColumnsRenamed({"letters": "b", "packed": "pb"})
    pairs = a.join(b, on).where(F.col("larger") | (F.col("a") < F.col("b")))
    first = F.get(F.array(*map(F.lit, FIRST_CHOICE)), _differing(F.col("pa"), F.col("pb")))
    pairs = pairs.where(first == F.col("choice"))
    # In sorted order a replaced letter is one deleted and one inserted at most.
    return pairs.where(F.levenshtein("a", "b", DISTANCE) >= 0).select("a", "b")


def _without(long: str, short: str) -> tuple[str, str] | None:
    """The first letter at which sorted multisets part, and ``long`` less that letter."""
    for i, letter in enumerate(long):
        if i == len(short) or letter != short[i]:
            return letter, long[:i] + long[i + 1 :]
    return None


def changes(a: str, b: str) -> tuple[str, str] | None:
    """The letter that only ``a`` holds and the one that only ``b`` holds (or empty),
    if sorted multisets are one change apart."""
    if a == b:
        return None
    if len(b) == len(a) + 1:
        into, rest = _without(b, a)
        return ("", into) if rest == a else None
    swapped = a > b
    if swapped:
        a, b = b, a
    # The smaller one has a letter first that the other one lacks.
    out, rest = _without(a, b)
    into, other = _without(b, rest)
    if rest != other:
        return None
    return (into, out) if swapped else (out, into)


def near_words(a: str, b: str, mine: list[str], others: list[str]) -> Iterator[tuple[int, int]]:
    """Places of the words with the letters ``a`` and ``b`` that are one change apart."""
    if (change := changes(a, b)) is None:
        return
    out, into = change
    place = {word: i for i, word in enumerate(mine)}
    for j, word in enumerate(others):
        at = word.find(into)
        found = set()
        while at >= 0:
            # In a run of the same letter every place gives the same word.
            found.add(word[:at] + out + word[at + 1 :])
            at = word.find(into, at + 1)
        for other in found:
            if other in place:
                yield place[other], j


def _blocks(words: DataFrame) -> DataFrame:
    """``(letters, words, counts)``, lists of at most some ``BLOCK`` words as strings."""
    size = words.groupBy("letters").agg(F.count(F.lit(1)).alias("size"))
    # Sizes are known before anything is gathered, so a large class is dealt out.
    parts = F.ceil(F.col("size") / BLOCK)
    dealt = words.join(size, "letters").withColumn("block", F.pmod(F.xxhash64("word"), parts))
    rows = dealt.groupBy("letters", "block").agg(F.collect_list(F.struct("word", "n")).alias("rows"))
    lists = [F.array_join(F.col(f"rows.{c}").cast("array<string>"), " ") for c in ("word", "n")]
    return rows.select("letters", lists[0].alias("words"), lists[1].alias("counts"))


def near_pairs(words: DataFrame) -> DataFrame:
    """``(word, n, near, near_n)`` in both directions, each pair once."""
    letters = F.array_join(F.array_sort(F.split("word", "")), "").alias("letters")
    words = words.select("word", "n", letters)
    blocks = materialized(_blocks(words))
    pairs = materialized(near_multisets(blocks.select("letters").distinct()))
    left = blocks.select(F.col("letters").alias("a"), F.col("words").alias("mine"), F.col("counts").alias("ns"))
    right = blocks.select(F.col("letters").alias("b"), F.col("words").alias("others"), F.col("counts").alias("other_ns"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "mine", "ns", "others", "other_ns")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = ([], [], [], [])
            for a, b, mine, ns, others, other_ns in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine, others = mine.split(), others.split()
                for i, j in near_words(a, b, mine, others):
                    one, other = (mine[i], int(ns.split()[i])), (others[j], int(other_ns.split()[j]))
                    for column, value in zip(out, one + other, strict=True):
                        column.append(value)
                    for column, value in zip(out, other + one, strict=True):
                        column.append(value)
            columns = [pa.array(c, t) for c, t in zip(out, [pa.string(), pa.int64()] * 2, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "near", "near_n"])

    return both.mapInArrow(verify, "word string, n bigint, near string, near_n bigint")


def _rooted(words: DataFrame) -> DataFrame:
    """Adds ``root`` to ``(word, form)`` rows whose forms lead nowhere in a circle."""
    now = materialized(words.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        jump = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = materialized(now.join(jump, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")))
        now = new.select("word", "root")
        if new.where("moved").isEmpty():
            return words.join(now, "word")


def group_variants(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of every word."""
    words = materialized(count_words(df, id, text))
    near = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        # The largest count, then the smallest word.
        F.min(F.struct((-F.col("near_n")).alias("back"), "near")).alias("best"),
    )
    rows = words.join(near, "word", "left")
    strong = -F.col("best.back") >= RATIO * F.col("n")
    rows = rows.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, -F.col("best.back")).alias("form_n"),
    )
    return _rooted(materialized(rows))


def op11_spelling_variants(spark, sf):
    found = group_variants(table(spark, sf, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op11_sql() -> str:
    """The same in DuckDB SQL: CRC by half bytes, near words by patterns with a gap."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE halves AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), [CAST(k AS BIGINT) FOR k IN range(4)]),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(16) AS r(i))),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= {LEAST_LETTERS} GROUP BY ALL),
hexed AS (SELECT run, k, hex(encode(id || ':' || run)) AS h FROM runs),
hashed AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT,
      [CAST('0x' || substr(h, CAST(i + 2 - 2 * (i % 2) AS BIGINT), 1) AS BIGINT) FOR i IN range(length(h))]),
      lambda c, x: xor(c >> 4, t[(xor(c, x) & 15) + 1])), 4294967295) AS crc
  FROM hexed CROSS JOIN halves),
cut AS (
  SELECT k, CASE WHEN crc % {EVERY} = 0
    THEN substr(run, 1, CAST(crc % length(run) AS BIGINT)) || substr(run, CAST(crc % length(run) AS BIGINT) + 2)
    ELSE run END AS word FROM hashed),
words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE length(word) >= {LEAST_LETTERS}
  GROUP BY word HAVING sum(k) >= {LEAST_COUNT}),
gaps AS (
  SELECT word, n, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT x.word, y.word AS near, y.n AS near_n FROM gaps AS x JOIN gaps AS y USING (a, z) WHERE x.word <> y.word
  UNION SELECT g.word, w.word, w.n FROM gaps AS g JOIN words AS w ON g.a || g.z = w.word
  UNION SELECT w.word, g.word, g.n FROM gaps AS g JOIN words AS w ON g.a || g.z = w.word),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS most, min(struct_pack(back := -near_n, near := near)) AS b
  FROM pairs GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN most >= {RATIO} * n THEN b.near END AS form, CASE WHEN most >= {RATIO} * n THEN most END AS form_n
  FROM words AS w LEFT JOIN best USING (word)),
led AS (
  SELECT word, coalesce(form, word) AS top FROM formed
  UNION SELECT led.word, f.form FROM led JOIN formed AS f ON led.top = f.word WHERE f.form IS NOT NULL)
SELECT f.word, form, top AS root, f.n, n_near, form_n
FROM formed AS f JOIN led ON led.word = f.word
WHERE NOT EXISTS (SELECT 1 FROM formed AS g WHERE g.word = top AND g.form IS NOT NULL)
"""
