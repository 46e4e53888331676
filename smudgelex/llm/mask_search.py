"""Ranked lexical search that groups documents by the mask of terms they match.

Every item is a set of terms. Documents are read once: each becomes its length and its
frequencies of the terms that any item asks for, stored in the shared folder. Counts
over that table give the weights of the terms. Then every task goes over its documents
in chunks. For each item it sets a bit for every term in the words of a bitmap, one for
each document, and groups the documents by that mask. A mask has a maximum score: the
weights of its terms times the most that any document of the chunk gets for each.
Masks are evaluated by descending maximum until it falls below the score of the last
place, which is kept from chunk to chunk, so that no document that could enter is left
out. The best of every task are merged, first in parts, so that no task gets more rows
than parts times places.

Terms are the maximal runs of ASCII letters, digits and characters beyond ASCII; only A
to Z are lower-cased. The weight of a term is ``floor(1000 ln((2N+2)/(2df+1)))``, with
``N`` the documents that hold any term; scores are 64-bit integers (``contributions``).

Null and empty texts have no terms: as documents they are not counted and never found,
as items they find nothing. Documents with equal scores are in the order of their ids,
null ids last; a repeated row is found as often as it is there. Rows of items that share
an id (or have none) are one item with the terms of all. Empty tables give no rows.
Very long texts are read whole; a chunk is bounded by bytes, not by rows. Other columns
are not read. Items beyond ``BLOCK_BYTES`` of text are searched in blocks, each with a
pass of its own, so what is broadcast stays below that (or one item).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smudgelex.llm.common import materialized, slices, table

PLACES = 10
BLOCK_BYTES = 4 * 1024 * 1024
# Documents whose masks are grouped at once.
CHUNK = 16_384
# Parts in which the results of all tasks are merged first.
PARTS = 128

# Bytes beyond ASCII stay, capitals become small, and what is neither letter nor digit
# becomes a space.
_FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: bytes) -> list[bytes]:
    """All terms of a UTF-8 text in their order, with repeats."""
    return text.translate(_FOLD).split()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def contributions(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What a term adds to a score, before its weight; it rises with ``tf`` and falls
    with the document's ``norm``."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * norm)


def _frequencies(docs: DataFrame, vocabulary) -> DataFrame:
    """``(id, n, terms, tfs)``: the places in the vocabulary and frequencies of the
    terms of a document that are in it, and the number of all its terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: i for i, w in enumerate(vocabulary.value)}
        for batch in batches:
            for part in slices(batch, 1):
                sizes, terms, tfs, ends = [], [], [], [0]
                for text in part.column(1).to_pylist():
                    found = Counter(terms_of(text or b""))
                    sizes.append(found.total())
                    for word in found.keys() & place.keys():
                        terms.append(place[word])
                        tfs.append(found[word])
                    ends.append(len(terms))
                offsets = pa.array(ends, pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (terms, tfs)]
                columns = [part.column(0), pa.array(sizes, pa.int64()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "terms", "tfs"])

    rows = docs.select("id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(count, "id bigint, n bigint, terms array<bigint>, tfs array<bigint>")


class Best:
    """The best places found so far for one item."""

    def __init__(self, places: int):
        self.places = places
        self.scores = np.zeros(0, dtype=np.int64)
        self.ids: list[int | None] = []

    def floor(self) -> int:
        """A score below this cannot enter."""
        return max(1, int(self.scores[-1])) if len(self.ids) == self.places else 1

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        rows = [*zip(self.scores.tolist(), self.ids), *zip(scores.tolist(), ids)]
        rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        del rows[self.places :]
        self.scores = np.array([s for s, _ in rows], dtype=np.int64)
        self.ids = [i for _, i in rows]


class Postings:
    """The documents of a chunk by term, with what the term adds for each."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, adds: np.ndarray, size: int):
        order = np.argsort(terms, kind="stable")
        self.terms, first = np.unique(terms[order], return_index=True)
        self.ends = np.append(first, len(terms))
        self.docs, self.adds, self.size = docs[order], adds[order], size
        self.most = np.maximum.reduceat(self.adds, first) if len(first) else self.adds

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray, int] | None:
        at = np.searchsorted(self.terms, term)
        if at == len(self.terms) or self.terms[at] != term:
            return None
        rows = slice(self.ends[at], self.ends[at + 1])
        return self.docs[rows], self.adds[rows], int(self.most[at])


def _masks(lists: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct masks as rows of 64-bit words, and by document the mask it has."""
    words = np.zeros((size, (len(lists) + 63) // 64), dtype=np.uint64)
    for t, docs in enumerate(lists):
        words[docs, t // 64] |= np.uint64(1 << (t % 64))
    if words.shape[1] == 1:
        masks, which = np.unique(words[:, 0], return_inverse=True)
        return masks[:, None], which
    masks, which = np.unique(words, axis=0, return_inverse=True)
    return masks, which.ravel()


def search(postings: Postings, ids: list[int | None], terms: list[int], weights: np.ndarray, best: Best) -> int:
    """Enter the documents of a chunk that belong among the best of an item; returns how
    many were evaluated."""
    held = [(t, p) for t in terms if weights[t] > 0 and (p := postings.of(t)) is not None]
    if not held:
        return 0
    masks, which = _masks([p[0] for _, p in held], postings.size)
    bits = np.unpackbits(np.ascontiguousarray(masks).view(np.uint8).reshape(len(masks), -1), axis=1, bitorder="little")
    highest = np.array([int(weights[t]) * p[2] for t, p in held], dtype=np.int64)
    bound = bits[:, : len(held)].astype(np.int64) @ highest
    order = np.argsort(-bound, kind="stable")
    members = np.argsort(which, kind="stable")
    ends = np.append(0, np.cumsum(np.bincount(which, minlength=len(masks))))
    evaluated = start = 0
    want = 4 * best.places
    while start < len(order) and bound[order[start]] >= best.floor():
        # Whole masks, until there are enough documents for a step.
        chosen, docs = start, []
        while chosen < len(order) and want > 0 and bound[order[chosen]] >= best.floor():
            docs.append(members[ends[order[chosen]] : ends[order[chosen] + 1]])
            want -= len(docs[-1])
            chosen += 1
        docs = np.concatenate(docs)
        taken = np.zeros(postings.size, dtype=bool)
        taken[docs] = True
        score = np.zeros(postings.size, dtype=np.int64)
        for t, (rows, adds, _) in held:
            hit = taken[rows]
            score[rows[hit]] += int(weights[t]) * adds[hit]
        docs = docs[score[docs] >= best.floor()]
        # Ties at the last place are settled by id, so all of them are handed over.
        if len(docs) > best.places:
            docs = docs[score[docs] >= np.partition(score[docs], -best.places)[-best.places]]
        best.add(score[docs], [ids[d] for d in docs])
        evaluated += int(taken.sum())
        start, want = chosen, 2 * evaluated
    return evaluated


def _ranked(found: DataFrame, keys: list[str], places: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return found.withColumn("rank", rank).where(F.col("rank") <= places)


def _search_block(docs: DataFrame, items: pd.DataFrame, places: int) -> DataFrame:
    """``(item, rank, id, score)`` for items that are few enough to be in every task."""
    spark = docs.sparkSession
    sets = [set(terms_of(t)) for t in items["text"]]
    vocabulary = sorted(set().union(*sets))
    where = {w: i for i, w in enumerate(vocabulary)}
    asked = [sorted(where[w] for w in s) for s in sets]
    names = [None if pd.isna(i) else int(i) for i in items["item"]]
    rows = materialized(_frequencies(docs, spark.sparkContext.broadcast(vocabulary)))
    total = rows.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    documents, length = total["N"], total["L"]
    # One row for each term of the block.
    held = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = np.zeros(len(vocabulary), dtype=np.int64)
    counted = held.toPandas()
    weights[counted["term"]] = [weight(documents, df) for df in counted["df"].tolist()]
    shared = spark.sparkContext.broadcast((asked, weights, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights, names = shared.value
        best = [Best(places) for _ in asked]
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                lists = part.column(2)
                sizes = np.diff(lists.offsets.to_numpy())
                of = np.repeat(np.arange(part.num_rows), sizes)
                norm = 10 + (90 * part.column(1).to_numpy() * documents) // max(1, length)
                adds = contributions(part.column(3).flatten().to_numpy(), norm[of])
                postings = Postings(lists.flatten().to_numpy(), of, adds, part.num_rows)
                ids = part.column(0).to_pylist()
                for terms, own in zip(asked, best, strict=True):
                    search(postings, ids, terms, weights, own)
        out = [(names[k], i, int(s)) for k, own in enumerate(best) for i, s in zip(own.ids, own.scores)]
        columns = list(zip(*out)) or [(), (), ()]
        arrays = [pa.array(c, pa.int64()) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, names=["item", "id", "score"])

    found = rows.where("n > 0").mapInArrow(run, "item bigint, id bigint, score bigint")
    part = F.pmod(F.xxhash64("id"), F.lit(PARTS))
    found = _ranked(found.withColumn("part", part), ["item", "part"], places).drop("rank", "part")
    return _ranked(found, ["item"], places)


def search_items(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    query: str = "text",
    places: int = PLACES,
) -> DataFrame:
    """``(item, rank, id, score)``: the documents with the highest scores above 0."""
    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    asked = items.select(F.col(item).cast("bigint").alias("item"), F.col(query).alias("text"))
    asked = asked.where("text is not null").groupBy("item").agg(F.array_join(F.collect_set("text"), "\n").alias("text"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).first()["size"]
    blocks = 2 * size // BLOCK_BYTES + 1
    out = None
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        part = mine.select("item", F.col("text").cast("binary").alias("text")).toPandas()
        found = _search_block(rows, part, places)
        out = found if out is None else out.unionByName(found)
    return out.select(F.col("item").alias(item), "rank", F.col("id").alias(id), "score")


def op12_mask_search(spark, sf):
    return search_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op12_sql() -> str:
    """The same in DuckDB SQL: every document with a term of an item is scored."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = f"unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '{runs}'))"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
held AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, {terms} AS term FROM docs) GROUP BY r, term),
sizes AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM held GROUP BY r),
total AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM sizes),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {terms} AS term FROM benchmark)),
weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM held SEMI JOIN asked USING (term) CROSS JOIN total GROUP BY term, nd),
normed AS (SELECT r, 10 + (90 * n * nd) // l AS m FROM sizes CROSS JOIN total),
scored AS (
  SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weighed USING (term) JOIN held USING (term) JOIN normed USING (r) GROUP BY item_id, r),
placed AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored JOIN docs USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= {PLACES}
"""
