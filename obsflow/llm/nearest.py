"""Nearest vectors by inner product with an inverted multi-index.

Vectors are scaled to length one for the index (all scaled vectors keep their
original for the scores) and cut into two halves. Each half is quantised by its own
centroids, learned by k-means on a bounded sample, so ``k`` centroids a half address
``k * k`` cells. Every vector is indexed under its cell. A query orders the centroids
of each half by distance and walks pairs of them by the sum of both distances with a
heap until the cells seen hold ``target`` vectors; those are reranked by the exact
inner product in double precision.

How many vectors that must be is measured: ``CALIBRATION`` queries are also answered
by brute force, and ``target`` is the count at which ``recall`` of their true
neighbours would have been seen. No walk ends with fewer than ``k`` candidates besides
the query's own rows while there are cells left.

Cells are dealt over shards of bounded size; a cell with very many vectors is first
cut into blocks, so a vector repeated a million times is spread too. Each query goes
once to every shard with a cell on its walk, and a shard returns at most ``k`` rows per
query.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsflow.llm.common import mixed, partitions
from obsflow.scratch import materialise

SAMPLE = 20_000
CALIBRATION = 128
CELL = 512
BLOCK = 4_096
SHARD = 32_768
QUERIES = 16_384
#: Centroids a half, at most: 262,144 cells, whose sizes the driver holds.
MOST = 512
#: More than a matrix product of some thousand components can be off, by the vectors' lengths.
_ROUNDING = 1e-12


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): vectors that are not NULL, not zero and hold only finite components."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col(id_col).alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    )


def centroids(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means with a fixed start; empty clusters keep their centre."""
    distinct = np.unique(rows, axis=0)
    centre = distinct[np.random.default_rng(7).permutation(len(distinct))[:k]]
    for _ in range(rounds):
        near = nearest_centroid(rows, centre)
        sums = np.zeros_like(centre)
        np.add.at(sums, near, rows)
        counts = np.bincount(near, minlength=len(centre))
        centre = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centre)
    return centre


def distances(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return (rows**2).sum(1)[:, None] - 2 * rows @ centre.T + (centre**2).sum(1)


def nearest_centroid(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(rows[i : i + 4096], centre).argmin(1) for i in range(0, len(rows), 4096)])


def walk(near_a: np.ndarray, near_b: np.ndarray, held: np.ndarray, target: float) -> list[int]:
    """Cells by ascending sum of the two distances until they hold ``target`` vectors."""
    order_a, order_b = np.argsort(near_a, kind="stable"), np.argsort(near_b, kind="stable")
    k = len(order_b)
    heap, cells, total = [(near_a[order_a[0]] + near_b[order_b[0]], 0, 0)], [], 0
    while heap and total < target:
        _, i, j = heapq.heappop(heap)
        cell = int(order_a[i]) * k + int(order_b[j])
        if held[cell]:
            cells.append(cell)
            total += held[cell]
        if j + 1 < k:
            heapq.heappush(heap, (near_a[order_a[i]] + near_b[order_b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(order_a):
            heapq.heappush(heap, (near_a[order_a[i + 1]] + near_b[order_b[0]], i + 1, 0))
    return cells


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` largest scores of each query, ties to the smaller id."""
    order = np.lexsort((ids, -score, query))
    sorted_query = query[order]
    first = np.searchsorted(sorted_query, sorted_query, side="left")
    return order[np.arange(len(order)) - first < k]


def top_of(scores: np.ndarray, k: int, slack: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a matrix that are among the ``k`` largest of their row, with all that are ``slack`` below."""
    if scores.shape[1] <= k:
        return np.nonzero(scores > -np.inf)
    least = np.partition(scores, -k, axis=1)[:, -k] - slack
    return np.nonzero((scores >= least[:, None]) & (scores > -np.inf))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from the first component to the last: equal rows have equal products.

    A matrix product sums in an order that depends on its shape and on a row's place in it.
    """
    out = np.zeros(len(a))
    for x, y in zip(a.T, b.T, strict=True):
        out += x * y
    return out


def answer(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best of one shard: queries (query_id, cells, v), candidates (vec_id, cell, v)."""
    asked, own = _matrix(queries["v"]), queries["query_id"].to_numpy()
    rows = np.repeat(np.arange(len(queries)), [len(c) for c in queries["cells"]])
    visited = np.concatenate(list(queries["cells"]))
    found = []
    for cell, part in candidates.groupby("cell"):
        ids, vectors = part["vec_id"].to_numpy(), _matrix(part["v"]).T
        longest = np.linalg.norm(vectors, axis=0).max()
        for q in np.array_split(rows[visited == cell], max(1, int((visited == cell).sum()) // 512)):
            scores = asked[q] @ vectors
            scores[own[q][:, None] == ids] = -np.inf
            r, c = top_of(scores, k, _ROUNDING * np.linalg.norm(asked[q], axis=1) * longest)
            found.append((own[q][r], ids[c], products(asked[q][r], vectors.T[c])))
    query, ids, score = (np.concatenate(x) for x in zip(*found, strict=True))
    kept = best(query, ids, score, k)
    return pd.DataFrame({"query_id": query[kept], "vec_id": ids[kept], "score": score[kept]})


def nearest_vectors(
    vectors: DataFrame, every: int = 20, k: int = 20, recall: float = 0.95, per_half: int | None = None,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row whose id is divisible by ``every``.

    Candidates are all rows but the query's own; the largest inner product is nearest,
    ties go to the smaller id. ``recall``: share of the true neighbours to be found,
    as measured on the calibration queries. ``per_half``: centroids a half, else the root
    of the number of vectors over ``CELL``, from 4 to ``MOST``. A query with
    fewer than ``k`` candidates gets all of them.

    Vectors that are NULL, zero, or hold a NULL or non-finite component take no part,
    nor do rows without an id, nor vectors of another length than most have (of equally
    frequent lengths the smallest counts). Rows repeated under one id are candidates of their own for other
    queries; as queries they count once. Other columns are ignored; no vectors: no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    key = vectors.schema[id_col].dataType.simpleString()
    out = f"query_id {key}, vec_id {key}, score double"
    usual = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    n = usual["count"] if usual else 0
    if n == 0:
        return spark.createDataFrame([], f"query_id {key}, rank int, vec_id {key}, score double")

    rows = rows.where(F.size("v") == usual["size"])
    sample = _matrix(
        r.v for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id", F.xxhash64("v")).limit(SAMPLE).collect()
    )
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    half = max(1, sample.shape[1] // 2)
    count = per_half or int(min(MOST, max(4, round((n / CELL) ** 0.5))))
    a, b = centroids(sample[:, :half], count), centroids(sample[:, half:], count)
    book = spark.sparkContext.broadcast((a, b))  # 2 * per_half centroids

    def to_cells(frames):
        for frame in frames:
            if len(frame) == 0:
                continue
            unit = _matrix(frame["v"])
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            near_a, near_b = nearest_centroid(unit[:, :half], book.value[0]), nearest_centroid(unit[:, half:], book.value[1])
            yield frame.assign(cell=near_a * len(book.value[1]) + near_b)

    index = materialise(rows.mapInPandas(to_cells, f"vec_id {key}, v array<double>, cell long"), "multi-index")
    held = np.zeros(len(a) * len(b), np.int64)
    for r in index.groupBy("cell").count().collect():  # per_half ** 2 cells at most
        held[r["cell"]] = r["count"]
    sizes = spark.sparkContext.broadcast(held)

    asked = materialise(
        index.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"), F.count("*").alias("own")),
        "multi-index-queries",
    )
    n_queries = asked.count()
    if n_queries == 0:
        return spark.createDataFrame([], f"query_id {key}, rank int, vec_id {key}, score double")
    target = _target(index, asked, (a, b), held, k, recall)
    shards = max(partitions(spark), -(-n // SHARD))
    query_blocks = -(-n_queries // QUERIES)

    def shard_of(cell: np.ndarray, block: np.ndarray) -> np.ndarray:
        return (mixed(cell.astype(np.uint64) * np.uint64(1 << 20) + block.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)

    def to_walks(frames):
        blocks = -(-sizes.value // BLOCK)
        for frame in frames:
            if len(frame) == 0:
                continue
            unit = _matrix(frame["v"])
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            near_a, near_b = distances(unit[:, :half], book.value[0]), distances(unit[:, half:], book.value[1])
            for query_id, v, own, x, y in zip(frame["vec_id"], frame["v"], frame["own"], near_a, near_b, strict=True):
                cells = np.array(walk(x, y, sizes.value, max(target, k + own)))  # its own rows are no candidates
                cut = np.repeat(cells, blocks[cells])
                block = np.arange(len(cut)) - np.repeat(np.cumsum(blocks[cells]) - blocks[cells], blocks[cells])
                shard = shard_of(cut, block)
                kinds = np.unique(shard)
                yield pd.DataFrame({
                    "shard": kinds, "query_id": query_id, "v": [v] * len(kinds),
                    "cells": [np.unique(cut[shard == s]) for s in kinds],
                })

    def to_shards(frames):
        blocks = -(-sizes.value // BLOCK)
        for frame in frames:
            cell = frame["cell"].to_numpy()
            block = mixed(frame["h"].to_numpy()) % blocks[cell].astype(np.uint64)
            yield frame.drop(columns="h").assign(shard=shard_of(cell, block))

    walks = asked.mapInPandas(to_walks, f"shard long, query_id {key}, v array<double>, cells array<long>")
    walks = walks.withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int"))
    placed = index.withColumn("h", F.xxhash64("vec_id", "v")).mapInPandas(
        to_shards, f"vec_id {key}, v array<double>, cell long, shard long"
    ).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def score(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if len(queries) == 0 or len(candidates) == 0:
            return pd.DataFrame({"query_id": queries["query_id"][:0], "vec_id": candidates["vec_id"][:0], "score": np.zeros(0)})
        return answer(queries, candidates, k)

    by = ("shard", "query_block")
    found = walks.groupBy(*by).cogroup(placed.groupBy(*by)).applyInPandas(score, out)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _target(index: DataFrame, asked: DataFrame, book: tuple, held: np.ndarray, k: int, recall: float) -> int:
    """Vectors a walk has to reach so that ``recall`` of the calibration queries' neighbours are seen."""
    spark = index.sparkSession
    tried = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).toPandas()
    vectors, own = _matrix(tried["v"]), tried["vec_id"].to_numpy()
    sent = spark.sparkContext.broadcast((vectors, own))

    def brute(frames):
        queries, asking = sent.value
        kept = None
        for frame in frames:
            for at in range(0, len(frame), 4096):
                part = frame.iloc[at : at + 4096]
                ids, cell = part["vec_id"].to_numpy(), part["cell"].to_numpy()
                scores = queries @ _matrix(part["v"]).T
                scores[asking[:, None] == ids] = -np.inf
                r, c = top_of(scores, k)
                new = (r, ids[c], scores[r, c], cell[c])
                kept = new if kept is None else tuple(np.concatenate(x) for x in zip(kept, new, strict=True))
                chosen = best(*kept[:3], k)
                kept = tuple(x[chosen] for x in kept)
        if kept is not None:
            yield pd.DataFrame(dict(zip(("q", "vec_id", "score", "cell"), kept, strict=True)))

    key = index.schema["vec_id"].dataType.simpleString()
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    true = (
        index.mapInPandas(brute, f"q int, vec_id {key}, score double, cell long")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).toPandas()
    )  # CALIBRATION * k rows
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    half = book[0].shape[1]
    needed = []
    for q, cells in true.groupby("q")["cell"]:
        route = walk(distances(unit[q : q + 1, :half], book[0])[0], distances(unit[q : q + 1, half:], book[1])[0], held, np.inf)
        before = dict(zip(route, np.cumsum(held[route]) - held[route] + 1, strict=True))
        needed += [int(before[c]) for c in cells]
    return int(np.quantile(needed, recall, method="higher")) if needed else 1
