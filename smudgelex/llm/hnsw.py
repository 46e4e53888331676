"""Approximate nearest neighbours: a navigable small-world graph for every shard.

Vectors are dealt over shards of bounded size by a hash of their id. A task builds one
shard's hierarchy of graphs and stores it as flat arrays of neighbours, one row of a
table for each shard. Queries are sent to all shards in blocks, walk the graphs many at
a time with array operations, and the shards' results are merged.

Nearness is the largest inner product, in the graphs as in the answers: a node is linked
to those with which its product is largest, so long vectors, which answer most queries,
are met from everywhere. Scores are computed anew in double precision from the original
vectors. Equal vectors of a shard are one node that keeps its smallest ids, so copies
neither crowd the graph nor push each other out.

Vectors that are null, empty, zero, or hold a null or a non-finite number take no part,
nor do rows without an id. Vectors meet only vectors of their own length. Rows that
share the query's id are its own. Repeated rows are found once. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smudgelex.llm.common import materialized, table

SHARD_ROWS = 16_384
# Links of a node: chosen when it is added, and at most kept on the lowest level.
LINKS = 16
MOST_LINKS = 32
# More links for nodes that few others lead to: fewer than WEAK, at most RESERVE a node.
WEAK = 6
RESERVE = 16
EF_BUILD = 64
EF_SEARCH = 256
# Ids that a node keeps; a search may ask for fewer than these.
NODE_IDS = 64
# Queries that meet a shard together: a block outweighs the shard that is sent to it.
BLOCK_BYTES = 32 * 1024 * 1024
BATCH = 512
EXPAND = 4

INDEX_SCHEMA = (
    "dim int, shard int, vectors binary, id_ends binary, ids binary,"
    " level_sizes array<int>, level_nodes array<binary>, level_links array<binary>"
)


def _walk(points, links, q, entry, ef):
    """Beam search of all rows of ``q`` together: ids and inner products, best first.

    ``links`` holds -1 behind the last link. ``entry`` has one or more nodes a row.
    """
    rows, n = len(q), len(links)
    seen = np.zeros((rows, n + 1), dtype=bool)
    beam = np.full((rows, ef), -1, dtype=np.int64)
    near = np.full((rows, ef), -np.inf, dtype=np.float32)
    opened = np.ones((rows, ef), dtype=bool)
    k = min(ef, entry.shape[1])
    entry = np.sort(entry[:, :k], axis=1)
    once = np.hstack([np.ones((rows, 1), dtype=bool), entry[:, 1:] != entry[:, :-1]])
    beam[:, :k] = np.where(once, entry, -1)
    near[:, :k] = np.where(once, np.einsum("rkd,rd->rk", points[entry], q), -np.inf)
    opened[:, :k] = ~once
    np.put_along_axis(seen, entry, True, axis=1)
    active = np.arange(rows)
    while len(active):
        value = np.where(opened[active], -np.inf, near[active])
        best = np.argsort(-value, axis=1)[:, :EXPAND]
        usable = np.take_along_axis(value, best, axis=1) > -np.inf
        go = usable[:, 0]
        active, best, usable = active[go], best[go], usable[go]
        if not len(active):
            break
        at = np.take_along_axis(beam[active], best, axis=1)
        opened[active[:, None], best] = True
        new = links[np.where(usable, at, 0)]
        new = np.where(usable[:, :, None], new, -1).reshape(len(active), -1)
        new = np.sort(new, axis=1)
        fresh = (new >= 0) & ~seen[active[:, None], new]
        fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
        seen[active[:, None], np.where(fresh, new, n)] = True
        close = np.full(new.shape, -np.inf, dtype=np.float32)
        r, c = np.nonzero(fresh)
        close[r, c] = np.einsum("id,id->i", points[new[r, c]], q[active[r]])
        all_near = np.concatenate([near[active], close], axis=1)
        all_ids = np.concatenate([beam[active], new], axis=1)
        all_open = np.concatenate([opened[active], ~fresh], axis=1)
        order = np.argsort(-all_near, axis=1, kind="stable")[:, :ef]
        near[active] = np.take_along_axis(all_near, order, axis=1)
        beam[active] = np.take_along_axis(all_ids, order, axis=1)
        opened[active] = np.take_along_axis(all_open, order, axis=1)
    return beam, near


def _diverse(x, q, ids, near, most):
    """Of candidates sorted by nearness, those nearer to ``q`` than to any chosen one."""
    rows, width = ids.shape
    points = x[np.maximum(ids, 0)]
    among = np.matmul(points, points.transpose(0, 2, 1))
    shadow = np.full((rows, width), -np.inf, dtype=np.float32)
    out = np.full((rows, most), -1, dtype=np.int64)
    count = np.zeros(rows, dtype=np.int64)
    for i in range(width):
        take = (ids[:, i] >= 0) & (near[:, i] > -np.inf) & (near[:, i] > shadow[:, i]) & (count < most)
        r = np.flatnonzero(take)
        out[r, count[r]] = ids[r, i]
        count[r] += 1
        shadow[r] = np.maximum(shadow[r], among[r, i])
    # Room that is left goes to the nearest of the rest.
    for i in range(width):
        spare = np.flatnonzero((count < most) & (ids[:, i] >= 0) & (near[:, i] > -np.inf))
        spare = spare[~(out[spare] == ids[spare, i][:, None]).any(axis=1)]
        out[spare, count[spare]] = ids[spare, i]
        count[spare] += 1
    return out


def _link_back(x, links, nodes, chosen):
    """Enter new nodes' links at the other end, thinning lists that grow too long."""
    most = links.shape[1]
    r, c = np.nonzero(chosen >= 0)
    target, source = chosen[r, c], nodes[r]
    near = np.einsum("id,id->i", x[target], x[source])
    order = np.lexsort((-near, target))
    target, source = target[order], source[order]
    unique, first, size = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(first, size)
    keep = place < most
    extra = np.full((len(unique), min(most, int(size.max(initial=0)))), -1, dtype=np.int64)
    extra[np.repeat(np.arange(len(unique)), size)[keep], place[keep]] = source[keep]
    ids = np.concatenate([links[unique], extra], axis=1)
    close = np.einsum("rkd,rd->rk", x[np.maximum(ids, 0)], x[unique])
    close = np.where(ids >= 0, close, -np.inf).astype(np.float32)
    order = np.argsort(-close, axis=1, kind="stable")
    ids, close = np.take_along_axis(ids, order, axis=1), np.take_along_axis(close, order, axis=1)
    short = (ids >= 0).sum(axis=1) <= most
    links[unique[short]] = ids[short, :most]
    for start in range(0, len(unique), BATCH):
        part = np.flatnonzero(~short)[start : start + BATCH]
        if len(part):
            links[unique[part]] = _diverse(x, x[unique[part]], ids[part], close[part], most)


def _exact(x, q, n, most):
    """The ``most`` nearest of the first ``n`` points by brute force."""
    near = q @ x[:n].T
    k = min(most, n)
    ids = np.argpartition(-near, k - 1, axis=1)[:, :k]
    near = np.take_along_axis(near, ids, axis=1)
    order = np.argsort(-near, axis=1, kind="stable")
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)


def _level(x, above, first):
    """Links among ``x``: each batch is added to the graph of those before it.

    ``above`` gives nodes to start from, which are among the ``first``; batches double,
    so a batch is never larger than the graph it searches.
    """
    n = len(x)
    links = np.full((n, MOST_LINKS), -1, dtype=np.int64)
    done = min(n, max(2 * EF_BUILD, first))
    ids, near = _exact(x, x[:done], done, EF_BUILD + 1)
    own = ids == np.arange(done)[:, None]
    chosen = _diverse(x, x[:done], ids, np.where(own, -np.inf, near), LINKS)
    links[:done, :LINKS] = chosen
    _link_back(x, links, np.arange(done), chosen)
    while done < n:
        size = min(done, BATCH, n - done)
        nodes = np.arange(done, done + size)
        ids, near = _walk(x, links[:done], x[nodes], above(nodes), EF_BUILD)
        # Nodes of one batch may be each other's nearest.
        mates, mate_near = _exact(x[nodes], x[nodes], size, 17)
        mate_near = np.where(mates == np.arange(size)[:, None], -np.inf, mate_near)
        ids = np.concatenate([ids, nodes[mates]], axis=1)
        near = np.concatenate([near, mate_near], axis=1)
        order = np.argsort(-near, axis=1, kind="stable")[:, :EF_BUILD]
        ids, near = np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)
        chosen = _diverse(x, x[nodes], ids, near, LINKS)
        links[nodes, :LINKS] = chosen
        _link_back(x, links, nodes, chosen)
        done += size
    return np.hstack([links, _rescued(x, links)])


def _rescued(x, links):
    """Links to nodes that hardly any node leads to, from the nodes they lead to.

    In many dimensions thinning leaves some nodes without a way in.
    """
    n = len(links)
    leads = np.bincount(links[links >= 0], minlength=n)
    weak = np.flatnonzero(leads < WEAK)
    r, c = np.nonzero(links[weak] >= 0)
    target, source = links[weak][r, c], weak[r]
    near = np.einsum("id,id->i", x[target], x[source])
    order = np.lexsort((-near, leads[source], target))
    target, source = target[order], source[order]
    _, first, size = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(first, size)
    keep = place < RESERVE
    out = np.full((n, RESERVE), -1, dtype=np.int64)
    out[target[keep], place[keep]] = source[keep]
    return out


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors in single precision with the largest number at 1."""
    return (vectors / (np.abs(vectors).max(initial=0) or 1.0)).astype(np.float32)


def build_graph(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the lowest up: the nodes of a level, and their links as positions."""
    n = len(vectors)
    x = _scaled(vectors)
    random = np.random.default_rng(n)
    height = np.floor(-np.log(1 - random.random(n)) / np.log(LINKS)).astype(int)
    order = np.argsort(-height, kind="stable")  # a level's nodes are a prefix of it
    sizes = [int((height >= k).sum()) for k in range(height.max(initial=0) + 1)]
    levels: list = [None] * len(sizes)
    for k in range(len(sizes) - 1, -1, -1):
        points = x[order[: sizes[k]]]

        def above(nodes, points=points, k=k):
            return descend(points, [lv for lv in levels[k + 1 :]], points[nodes])

        levels[k] = (order[: sizes[k]], _level(points, above, sizes[k + 1] if k + 1 < len(sizes) else 0))
    return levels


def descend(points, uppers, q, width: int = 4):
    """Nodes to start from on a level, from the levels above it.

    Every level's nodes are a prefix of the level below, so positions stay valid.
    """
    entry = np.zeros((len(q), 1), dtype=np.int64)
    for nodes, links in reversed(uppers):
        entry, _ = _walk(points[: len(nodes)], links, q, entry[:, :1], min(width * 4, len(nodes)))
        entry = np.maximum(entry[:, :width], entry[:, :1])
    return entry


def _rows_of(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.concatenate(vectors.to_numpy()).astype(np.float64).reshape(-1, dim)


def _build(key, rows: pd.DataFrame) -> pd.DataFrame:
    dim, shard = key
    vectors = _rows_of(rows["vector"], dim) + 0.0  # no negative zeros
    ids = rows["id"].to_numpy(dtype=np.int64)
    unique, back = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((ids, back))
    back, ids = back[order], ids[order]
    first = np.r_[True, (back[1:] != back[:-1]) | (ids[1:] != ids[:-1])]
    back, ids = back[first], ids[first]
    start = np.searchsorted(back, np.arange(len(unique)))
    keep = np.arange(len(back)) - start[back] < NODE_IDS
    back, ids = back[keep], ids[keep]
    ends = np.searchsorted(back, np.arange(len(unique)), side="right")
    levels = build_graph(unique)
    return pd.DataFrame(
        {
            "dim": [dim],
            "shard": [shard],
            "vectors": [unique.tobytes()],
            "id_ends": [ends.astype("<i8").tobytes()],
            "ids": [ids.astype("<i8").tobytes()],
            "level_sizes": [[len(nodes) for nodes, _ in levels]],
            "level_nodes": [[nodes.astype("<i4").tobytes() for nodes, _ in levels]],
            "level_links": [[links.astype("<i4").tobytes() for _, links in levels]],
        }
    )


def usable_vectors(df: DataFrame, id: str, vector: str) -> DataFrame:
    rows = df.select(F.col(id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists("vector", lambda v: v != 0)
    return rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & some)


def build_index(
    df: DataFrame, id: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """One row for each shard, written to the shared folder."""
    rows = usable_vectors(df, id, vector)
    shards = rows.count() // shard_rows + 1
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard")
    rows = rows.select(F.size("vector").alias("dim"), shard, "id", "vector")
    return materialized(rows.groupBy("dim", "shard").applyInPandas(_build, INDEX_SCHEMA))


class Graph:
    """A shard read back from its row."""

    def __init__(self, row: pd.Series):
        dim = int(row["of_dim"])
        self.vectors = np.frombuffer(row["vectors"], dtype="<f8").reshape(-1, dim)
        self.ends = np.frombuffer(row["id_ends"], dtype="<i8")
        self.ids = np.frombuffer(row["ids"], dtype="<i8")
        self.x = _scaled(self.vectors)
        self.levels = [
            (
                np.frombuffer(nodes, dtype="<i4").astype(np.int64),
                np.frombuffer(links, dtype="<i4").reshape(-1, MOST_LINKS + RESERVE).astype(np.int64),
            )
            for nodes, links in zip(row["level_nodes"], row["level_links"], strict=True)
        ]

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, ef: int) -> Iterator[pd.DataFrame]:
        order, links = self.levels[0]
        points = self.x[order]
        starts = np.r_[0, self.ends[:-1]]
        for at in range(0, len(queries), BATCH):
            own, block = ids[at : at + BATCH], queries[at : at + BATCH]
            norm = np.maximum(np.linalg.norm(block, axis=1, keepdims=True), 1e-300)
            q = (block / norm).astype(np.float32)
            found, _ = _walk(points, links, q, descend(points, self.levels[1:], q), min(ef, len(points)))
            r, c = np.nonzero(found >= 0)
            node = order[found[r, c]]
            scores = np.einsum("id,id->i", self.vectors[node], block[r])
            size = self.ends[node] - starts[node]
            row = np.repeat(np.arange(len(node)), size)
            place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            out = pd.DataFrame(
                {"query_id": own[r[row]], "vec_id": self.ids[starts[node][row] + place], "score": scores[row]}
            )
            out = out[out["query_id"] != out["vec_id"]]
            out = out.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
            yield out.groupby("query_id", sort=False).head(k)


def search_index(
    index: DataFrame, queries: DataFrame, k: int, id: str = "vec_id", vector: str = "embedding", ef: int = EF_SEARCH
) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the ``k`` nearest found by all shards."""
    if k >= NODE_IDS:
        raise ValueError(f"k must be below {NODE_IDS}")
    rows = usable_vectors(queries, id, vector).select(F.size("vector").alias("dim"), "id", "vector").distinct()
    n, longest = rows.agg(F.count(F.lit(1)), F.coalesce(F.max("dim"), F.lit(1))).first()
    blocks = n * longest * 8 // BLOCK_BYTES + 1
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    # The stated queries meet every shard, a block of them at a time.
    homes = index.select("dim", "shard")
    sent = rows.select("*", block).join(homes, "dim")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("of_block")
    graphs = index.withColumnsRenamed({"dim": "of_dim", "shard": "of_shard"}).select("*", every)
    graphs = graphs.groupBy("of_dim", "of_shard", "of_block")

    def search(key, found: pd.DataFrame, graph: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": int, "vec_id": int})
        if not len(found) or not len(graph):
            return empty
        vectors = _rows_of(found["vector"], int(key[0]))
        parts = Graph(graph.iloc[0]).search(found["id"].to_numpy(np.int64), vectors, k, ef)
        return pd.concat([empty, *parts])

    sent = sent.groupBy("dim", "shard", "block")
    hits = sent.cogroup(graphs).applyInPandas(search, "query_id bigint, vec_id bigint, score double")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.distinct().select("query_id", F.row_number().over(nearest).alias("rank"), "vec_id", "score")
    return ranked.where(F.col("rank") <= k)


def op4_hnsw(spark, sf):
    vectors = table(spark, sf, "embeddings")
    index = build_index(vectors)
    queries = vectors.where(F.col("vec_id") % 20 == 0)
    return search_index(index, queries, 20)
