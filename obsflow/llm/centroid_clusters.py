"""k-means over integer vectors with Shallot search.

Each vector keeps its centroid, its second-nearest one, an upper bound of the distance to
the first and a lower bound of the distance to all others. When the centroids have moved,
the bounds move with them; only where they no longer decide is a vector looked at:

1. The upper bound is made exact. If it is then below the lower bound, or below half the
   distance to the nearest other centroid, the vector stays where it is.
2. Else the distance to the remembered second centroid is computed too, and the search
   starts from the closer one of the two. A centroid that can be nearest or second nearest
   lies, seen from there, in a ball whose radius is the distance to the start plus the
   distance to the second nearest so far. The start's neighbours are scanned in order of
   distance; each better find shrinks the ball, and the scan ends at its border.

Bounds are floats that are rounded to the safe side and only leave work out. All that is
compared in the end are squared distances in 64-bit integers, so ties are exact.

Vectors travel in blocks of rows: a block holds its vectors, their state and the sums of
each cluster. A round reads the blocks, writes them with the new state, and adds up the
blocks' sums; only the centroids reach the driver. The table of the round before is then
removed, so scratch holds two copies at most.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.scratch import remove, scratch_path

BLOCK = 4_096
#: Components up to this size have squared distances that fit in 64 bits for up to 64 components.
LARGEST = 1 << 27
_UP, _DOWN = 1 + 1e-9, 1 - 1e-9


def integer_vectors(
    vectors: DataFrame, size: int, scale: int, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, v): floor(scale * x) of the vectors with ``size`` components, all finite and in range."""
    v = F.col(vector_col).cast("array<double>")
    fits = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(LARGEST / scale)))
    return (
        vectors.select(F.col(id_col).alias("vec_id"), v.alias("v"))
        .where(F.col("v").isNotNull() & (F.size("v") == size) & fits)
        .select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("v"))
    )


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows, exact in integers."""
    difference = a - b
    return np.einsum("ij,ij->i", difference, difference)


class Search:
    """Nearest and second-nearest centroids of vectors; ``moved``: how far each centroid has come since the last search."""

    def __init__(self, centre: np.ndarray, moved: np.ndarray):
        self.centre, self.moved = centre, moved * _UP
        k = len(centre)
        apart = np.sqrt(np.stack([squared(centre, c) for c in centre]).astype(np.float64))
        order = np.argsort(apart, axis=1, kind="stable")
        self.neighbours = order[order != np.arange(k)[:, None]].reshape(k, k - 1)
        self.apart = np.take_along_axis(apart, self.neighbours, axis=1) * _DOWN
        self.half = self.apart[:, 0] / 2 if k > 1 else np.full(k, np.inf)
        others = np.sort(self.moved)[-2:]  # how far any centroid but the own one has come
        self.others = np.where(self.moved == others[-1], others[0], others[-1]) if (self.moved == others[-1]).sum() == 1 else np.full(k, others[-1])

    def start(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """State that leaves everything open."""
        return np.zeros(n, np.int64), np.full(n, min(1, len(self.centre) - 1)), np.full(n, np.inf), np.zeros(n)

    def update(self, v: np.ndarray, near, second, upper, lower) -> None:
        """Bring the state of the vectors to these centroids, in place."""
        centre = self.centre
        if len(centre) == 1:
            return
        upper += self.moved[near]
        lower -= self.others[near]
        bar = np.maximum(lower, self.half[near])
        open_ = np.flatnonzero(upper >= bar)
        own = squared(v[open_], centre[near[open_]])
        upper[open_] = np.sqrt(own.astype(np.float64)) * _UP
        still = upper[open_] >= bar[open_]
        open_, own = open_[still], own[still]
        if len(open_) == 0:
            return
        x, a, b = v[open_], near[open_], second[open_]
        other = squared(x, centre[b])
        swap = (other < own) | (other == own) & (b < a)
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        d1, d2 = np.where(swap, other, own), np.where(swap, own, other)
        origin, known, reach = a.copy(), b.copy(), np.sqrt(d1.astype(np.float64))
        alive = np.arange(len(open_))
        for t in range(len(centre) - 1):
            radius = (reach[alive] + np.sqrt(d2[alive].astype(np.float64))) * _UP
            alive = alive[self.apart[origin[alive], t] <= radius]
            if len(alive) == 0:
                break
            j = self.neighbours[origin[alive], t]
            at, j = alive[j != known[alive]], j[j != known[alive]]
            d = squared(x[at], centre[j])
            first = (d < d1[at]) | (d == d1[at]) & (j < a[at])
            nearer = ~first & ((d < d2[at]) | (d == d2[at]) & (j < b[at]))
            won, closer = at[first], at[nearer]
            b[won], d2[won] = a[won], d1[won]
            a[won], d1[won] = j[first], d[first]
            b[closer], d2[closer] = j[nearer], d[nearer]
        near[open_], second[open_] = a, b
        upper[open_], lower[open_] = np.sqrt(d1.astype(np.float64)) * _UP, np.sqrt(d2.astype(np.float64)) * _DOWN


def _sums(v: np.ndarray, near: np.ndarray, k: int) -> np.ndarray:
    """Sum of the vectors of each cluster, and their number behind it."""
    out = np.zeros((k, v.shape[1] + 1), np.int64)
    order = np.argsort(near, kind="stable")
    kinds, starts = np.unique(near[order], return_index=True)
    out[kinds, :-1] = np.add.reduceat(v[order], starts, axis=0)
    out[kinds, -1] = np.diff(np.append(starts, len(order)))
    return out


def _write(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def centroid_clusters(
    vectors: DataFrame, k: int = 8, rounds: int = 10, *, size: int = 64, scale: int = 1024, seed: str = "3:",
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256): one row per vector kept.

    Kept are vectors of ``size`` components, none NULL or non-finite; a component becomes
    floor(scale * x). Centroids start as the ``k`` vectors whose ids have the smallest
    sha256 of ``seed`` and the id (repeated ids: by their components), in that order; a
    NULL id counts as empty text there. Each round assigns every vector to the nearest
    centroid, ties to the smaller number, and replaces every centroid that has vectors by
    floor(sum / count) of their components; after the last one vectors are assigned again.
    Rounds that would change nothing are left out.

    Repeated rows are vectors of their own. Fewer than ``k`` vectors make as many
    centroids. Vectors of another length or with a component beyond ``LARGEST`` (an x of
    131,072 for a scale of 1,024), whose squared distances would not fit in a long, take no
    part. An inertia that does not fit in a long is NULL. Other columns are ignored; no
    vectors: no rows.
    """
    spark = vectors.sparkSession
    key = vectors.schema[id_col].dataType.simpleString()
    kept = integer_vectors(vectors, size, scale, id_col, vector_col)
    hashed = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.orderBy(hashed, "v").limit(k).select("v").collect()  # k rows
    if not first:
        return spark.createDataFrame(
            [], f"vec_id {key}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    centre = np.array([r.v for r in first], np.int64)
    k = len(centre)
    state = "near binary, second binary, upper binary, lower binary"
    block = f"ids array<{key}>, v binary, {state}, sums array<long>"

    def to_blocks(frames):
        search = Search(centre, np.zeros(k))
        for frame in frames:
            for at in range(0, len(frame), BLOCK):
                part = frame.iloc[at : at + BLOCK]
                ids = part["vec_id"].astype(object).where(part["vec_id"].notna(), None)
                yield advanced([ids.tolist()], [np.stack(part["v"].to_list()).astype(np.int64)], [search.start(len(part))], search)

    def advanced(ids, vs, states, search) -> pd.DataFrame:
        sums = []
        for v, now in zip(vs, states, strict=True):
            search.update(v, *now)
            sums.append(_sums(v, now[0], k).reshape(-1))
        columns = dict(zip(("near", "second", "upper", "lower"), ([x.tobytes() for x in column] for column in zip(*states, strict=True)), strict=True))
        return pd.DataFrame({"ids": ids, "v": [v.astype("<i4").tobytes() for v in vs], **columns, "sums": sums})

    def opened(frame):
        vs = [np.frombuffer(raw, "<i4").reshape(-1, size).astype(np.int64) for raw in frame["v"]]
        kinds = (("near", np.int64), ("second", np.int64), ("upper", np.float64), ("lower", np.float64))
        return vs, list(zip(*([np.frombuffer(raw, kind).copy() for raw in frame[name]] for name, kind in kinds), strict=True))

    def next_round(search):
        def run(frames):
            for frame in frames:
                for at in range(len(frame)):
                    row = frame.iloc[at : at + 1]
                    vs, states = opened(row)
                    yield advanced(row["ids"].tolist(), vs, states, search)
        return run

    now, path = _write(kept.mapInPandas(to_blocks, block), "clusters")
    moved = np.zeros(k)
    for done in range(rounds):
        if done:
            after, new_path = _write(now.mapInPandas(next_round(Search(centre, moved)), block), "clusters")
            remove(spark, path)
            now, path = after, new_path
        totals = np.zeros(k * (size + 1), object)
        for r in now.select(F.posexplode("sums")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect():
            totals[r.pos] = int(r.s)  # k * (size + 1) sums
        totals = totals.reshape(k, size + 1)
        new = np.array([[s // row[-1] for s in row[:-1]] if row[-1] else c.tolist() for row, c in zip(totals, centre, strict=True)], np.int64)
        moved = np.sqrt(squared(new, centre).astype(np.float64))
        if not moved.any():
            break
        centre = new

    def finish(frames):
        search = Search(centre, moved)
        for frame in frames:
            for at in range(len(frame)):
                row = frame.iloc[at : at + 1]
                (v,), (found,) = opened(row)
                search.update(v, *found)
                yield pd.DataFrame({
                    "vec_id": pd.Series(list(row["ids"].iloc[0]), dtype=object), "cluster": found[0].astype(np.int32),
                    "distance": squared(v, centre[found[0]]),
                })

    assigned, _ = _write(now.mapInPandas(finish, f"vec_id {key}, cluster int, distance long"), "clusters-assigned")
    remove(spark, path)
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(whole.alias("s")).collect()}  # k rows
    fits = lambda n: n if n < 1 << 63 else None
    about = [
        (c, fits(inertia.get(c, 0)), fits(sum(inertia.values())), hashlib.sha256(",".join(map(str, centre[c].tolist())).encode()).hexdigest())
        for c in range(k)
    ]
    about = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
