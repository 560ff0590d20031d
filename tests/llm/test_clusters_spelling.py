"""Centroid clustering and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from obsflow.llm import centroid_clusters, spelling
from obsflow.llm.queries import QUERIES


def brute_clusters(rows, k=8, rounds=10, size=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, np.floor(1024 * np.asarray(v, np.float64)).astype(np.int64)))
    if not kept:
        return []
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1].tolist()))
    centre = np.array([v for _, v in start[:k]])
    every = np.array([v for _, v in kept])

    def assign():
        d = np.stack([((every - c) ** 2).sum(1) for c in centre], axis=1)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        near, _ = assign()
        centre = np.array([every[near == c].sum(0) // (near == c).sum() if (near == c).any() else centre[c] for c in range(len(centre))])
    near, d = assign()
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centre]
    return [(i, int(c), int(x), int(d[near == c].sum()), int(d.sum()), digest[c]) for (i, _), c, x in zip(kept, near, d)]


def same(frame, expected):
    assert sorted((tuple(r) for r in frame.collect()), key=repr) == sorted(expected, key=repr)


def test_clusters(spark):
    rng = np.random.default_rng(4)
    grid = rng.integers(-2, 3, (900, 64)) / 1024  # many ties
    rows = [(i, v.tolist()) for i, v in enumerate(grid)]
    rows += [(2000 + i, (rng.standard_normal(64) * 10).tolist()) for i in range(300)]
    rows += [(5, grid[7].tolist())] * 3 + [(None, grid[1].tolist()), (None, None), (3000, []), (3001, [1.0] * 63), (3002, [1.0] * 65)]
    rows += [(3003, [float("nan")] + [0.0] * 63), (3004, [None] * 64), (3005, [float("-inf")] * 64), (3006, [0.0] * 64)]
    frame = spark.createDataFrame([(i, v, "c", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, distance int").repartition(5)
    same(centroid_clusters.centroid_clusters(frame), brute_clusters(rows))
    same(centroid_clusters.centroid_clusters(frame, k=40, rounds=4), brute_clusters(rows, 40, 4))
    same(centroid_clusters.centroid_clusters(frame, k=1), brute_clusters(rows, 1))
    few = frame.where("vec_id IN (1, 2, 3)")
    same(centroid_clusters.centroid_clusters(few), brute_clusters([r for r in rows if r[0] in (1, 2, 3)]))
    assert centroid_clusters.centroid_clusters(frame.limit(0)).count() == 0
    equal = [(i, [0.5] * 64) for i in range(30)]  # all centroids alike
    same(centroid_clusters.centroid_clusters(spark.createDataFrame(equal, "vec_id long, embedding array<double>")), brute_clusters(equal))
    huge = spark.createDataFrame([(1, [1e300] * 64), (2, [1.0] * 64)], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in centroid_clusters.centroid_clusters(huge).collect()] == [2]


def test_query_clusters(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    same(QUERIES["op12_centroid_clusters"](spark, sf_dir), brute_clusters(rows))


def test_search_remembers_the_two_nearest():
    rng = np.random.default_rng(6)
    v, centre = rng.integers(-50, 50, (500, 6)), rng.integers(-50, 50, (30, 6))
    search = centroid_clusters.Search(centre, np.zeros(30))
    state = search.start(500)
    for _ in range(4):
        search.update(v, *state)
        d = np.stack([((v - c) ** 2).sum(1) for c in centre], axis=1)
        assert (state[0] == d.argmin(1)).all()
        assert (state[3] <= np.sqrt(np.sort(d, axis=1)[:, 1])).all()
        moved = centre + rng.integers(-3, 4, centre.shape)
        search = centroid_clusters.Search(moved, np.sqrt(((moved - centre) ** 2).sum(1)))
        centre = moved


def edits(word):
    """Every word one deletion or one replaced or inserted place away, as patterns."""
    return {(i, word[:i] + word[i + 1 :]) for i in range(len(word))}


def brute_spelling(rows, damage=31, shortest=7, least=2, factor=10):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= least}
    near = {w: set() for w in words}
    gaps = {}
    for w in words:
        for i, shorter in edits(w):
            gaps.setdefault((i, shorter), []).append(w)  # replaced at i
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in gaps.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= factor * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("letters", ["ab", "abcÿ", "abcdefghijklmé"])
def test_bound_and_keys(letters):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(7, 13)))
    some = [word() for _ in range(300)]
    counted = Counter(g for w in some for g in {w[i : i + q] for q in (2, 3) for i in range(len(w) - q + 1)})
    for share in (0.0, 0.02, 0.3, 2):
        common = frozenset(g for g, c in counted.items() if len(g) < 3 and c > share * len(some))
        ends = spelling.endings(common)
        for w in some:
            grams = spelling.spans(w, common)
            least = spelling.bound(w, grams, common, ends)
            assert least >= 1
            mine = Counter(w[a:b] for a, b in grams)
            for i in range(len(w) + 1):
                c = rng.choice(letters)
                for other in (w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :]):
                    if other == w or len(other) < 7:
                        continue
                    theirs = Counter(other[a:b] for a, b in spelling.spans(other, common))
                    assert (mine & theirs).total() >= least
                    assert set(spelling.keys(w, counted, common, ends)) & set(spelling.keys(other, counted, common, ends))


def test_spelling(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdeÀÿ") for _ in range(rng.randrange(7, 11))) for _ in range(25)]
    rows = []
    for i in range(250):
        text = []
        for _ in range(40):
            w = rng.choice(base[: rng.randrange(1, 26)])
            if rng.random() < 0.2:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + "b" + w[k:], w[:k] + "É" + w[k + 1 :], w.upper()])
            text.append(w)
        rows.append((i, rng.choice([" ", "\n", "1", "Ā", "-"]).join(text)))
    long_word = "xyz" * 4000
    rows += [(900, None), (901, ""), (902, "short words"), (None, " ".join(base)), (903, long_word), (904, long_word + "a"), (903, long_word), (905, long_word + "a")]
    rows.append((906, (base[0] + " ") * 30_000))
    frame = spark.createDataFrame([(i, t, "en", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(4)
    for damage in (31, 3, None):
        same(spelling.spelling_variants(frame, damage=damage), brute_spelling(rows, damage))
    assert spelling.spelling_variants(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(frame, shortest=5)


def test_query_spelling(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    same(QUERIES["op13_spelling_variants"](spark, sf_dir), brute_spelling(rows))
