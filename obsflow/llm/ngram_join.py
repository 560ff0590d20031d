"""Jaccard join of n-gram sets with prefix trees.

1. Every text gives its set of distinct 5-word shingles. A packed exchange tells which
   of them occur in several documents, and in how many. A document with over a quarter
   of its shingles to itself links with nothing and is done.
2. The sets of the others are ordered by document frequency and hash, one order for
   all. Equal sets are joined at once and one of each goes on.
3. Sets that link share one of their first ``n - ceil(0.75 n) + 1`` shingles (their
   prefix). Each is tried first against three of those found with it in the postings of
   its prefix, where documents with few shingles of their own come first: that joins
   large groups of near copies with a few trials per copy.
4. What is not yet joined is tried in full: all pairs of different components that
   share a shingle early enough in both for the overlap that their sizes ask for.
5. Trials run on prefix trees: the partners of a document are stored in a trie in the
   global order, and one traversal counts the overlap with all of them, shared along
   common beginnings; a subtree is left as soon as its remaining length cannot reach
   the overlap that is needed.

Words are not compared: a shingle is its hash. A token holds 56 bits of it and its
frequency, and sets count as equal only if a hash over all 64 bits of all their shingles
agrees as well. So two short texts are taken for one with a chance of 2^-64 a pair, and a
link between longer ones is wrong only where a token of 56 bits makes up the one shingle
that they lack.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsflow.llm.common import give_back, mixed, partitions, plainly_named
from obsflow.llm.components import components
from obsflow.llm.exchange import (
    flat, pieces, rows_by_bucket, slices, window_values, windows_within, word_values,
)
from obsflow.scratch import materialise

SHINGLE = 5
#: Bytes of a shingle's hash in the exchange; the eighth byte of a token is its rank.
HASH = 7


def shingle_sets(texts) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle value), by document, distinct within it."""
    words = [t.encode().lower().split() if isinstance(t, str) else [] for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    values = word_values(list(chain.from_iterable(words)))
    owner = np.repeat(np.arange(len(words)), counts)
    found, at = windows_within(values, counts, SHINGLE)
    docs, hashes = [owner[at]], [found]
    for size in range(1, SHINGLE):  # short texts: the whole sequence
        short = np.flatnonzero(counts == size)
        block = values[(np.cumsum(counts) - counts)[short][:, None] + np.arange(size)]
        hashes.append(np.array([window_values(row, size)[0] for row in block], np.uint64))
        docs.append(short)
    doc, value = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    first = np.concatenate(([True], (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])))[: len(doc)]
    return doc[first], value[first]


def prefix_tree(sets: list[np.ndarray]) -> list:
    """Radix trie of sorted arrays: nodes [edge, children by first value, ends, shortest, longest rest]."""
    root = [np.zeros(0, np.int64), {}, []]
    for k, values in enumerate(sets):
        node, at = root, 0
        while True:
            edge = node[0]
            n = min(len(edge), len(values) - at)
            differ = np.flatnonzero(edge[:n] != values[at : at + n])
            same = int(differ[0]) if len(differ) else n
            if same < len(edge):  # split the edge
                node[1:] = [{int(edge[same]): [edge[same:], node[1], node[2]]}, []]
                node[0] = edge[:same]
            at += same
            if at == len(values):
                node[2].append(k)
                break
            child = node[1].get(int(values[at]))
            if child is None:
                node[1][int(values[at])] = [values[at:], {}, [k]]
                break
            node = child
    return root


def tree_overlaps(root: list, probe: np.ndarray, needed: np.ndarray) -> dict[int, int]:
    """Overlap of ``probe`` with each set of the trie that reaches its ``needed``."""
    least: dict[int, int] = {}  # of all sets at or below a node
    nodes = [root]
    for node in nodes:  # grows as it goes, parents first; tries can be deeper than Python's stack
        nodes += node[1].values()
    for node in reversed(nodes):
        least[id(node)] = min([*(least[id(c)] for c in node[1].values()), *(int(needed[k]) for k in node[2])])

    found, stack = {}, [(root, 0, 0)]
    while stack:
        node, at, have = stack.pop()
        edge = node[0]
        if len(edge):
            place = np.searchsorted(probe[at:], edge) + at
            have += int((probe[np.minimum(place, len(probe) - 1)] == edge)[place < len(probe)].sum())
            at = int(place[-1])
        if have + len(probe) - at < least[id(node)]:
            continue  # what is left of the probe cannot reach it
        for k in node[2]:
            if have >= needed[k]:
                found[k] = have
        stack += [(child, at, have) for child in node[1].values()]
    return found


def shared_sets(docs: DataFrame) -> DataFrame:
    """(node, doc_id, mark, whole, n, tokens): every document with its number of shingles.

    ``tokens`` holds the shingles that other documents have too, in the global order
    (rare ones first), where they are three quarters or more of the set; else NULL.
    ``node`` numbers the rows, ``mark`` is a hash of the text, ``whole`` one of the set.
    """
    buckets = partitions(docs.sparkSession)
    key = docs.schema["doc_id"].dataType.simpleString()

    def ask(frames):
        task = TaskContext.get().partitionId()
        for k, piece in enumerate(pieces(frames)):
            number = task << 24 | k
            doc, value = shingle_sets(piece["text"])
            sizes = np.bincount(doc, minlength=len(piece))
            rows = rows_by_bucket(value, doc, buckets, HASH)
            with np.errstate(over="ignore"):
                sums = np.concatenate(([np.uint64(0)], np.cumsum(mixed(value + np.uint64(SHINGLE)), dtype=np.uint64)))
                ends = np.cumsum(sizes)
                whole = (sums[ends] - sums[ends - sizes]).view(np.int64)
            yield pd.DataFrame({
                "bucket": [b for b, _, _ in rows] + [number % buckets], "piece": number,
                "places": [p for _, p, _ in rows] + [None], "low": [v for _, _, v in rows] + [None],
                "ids": [None] * len(rows) + [piece["doc_id"].astype(object).where(piece["doc_id"].notna(), None).tolist()],
                "marks": [None] * len(rows) + [piece["mark"].tolist()],
                "wholes": [None] * len(rows) + [whole.tolist()],
                "sizes": [None] * len(rows) + [sizes.tolist()],
            })

    def compare(frames):
        give_back()
        held = [f for f in frames if len(f)]
        if not held:
            return
        rows = pd.concat(held, ignore_index=True)
        book = rows[rows["low"].isna()]
        if len(book):
            yield book[["piece", "ids", "marks", "wholes", "sizes"]].assign(places=None, tokens=None)
        rows = rows[rows["low"].notna()]
        if len(rows) == 0:
            return
        pieces_, (values, places, bounds) = rows["piece"].to_numpy(), flat(rows, HASH)
        del rows, held
        give_back()
        for at, order, starts in slices(values):
            counts = np.diff(np.append(starts, len(order)))
            frequency = np.empty(len(order), np.int64)
            frequency[order] = np.repeat(counts, counts)
            chosen = np.flatnonzero(frequency > 1)
            rank = np.minimum(np.log2(frequency[chosen]) * 4, 127).astype(np.int64)
            at = at[chosen]
            tokens, place = rank << 56 | values[at].astype(np.int64), places[at].astype("<u2")
            cuts = np.searchsorted(at, bounds)
            some = np.flatnonzero(np.diff(cuts))
            yield pd.DataFrame({
                "piece": pieces_[some], "ids": None, "marks": None, "wholes": None, "sizes": None,
                "places": pd.Series([place[cuts[k] : cuts[k + 1]].tobytes() for k in some], dtype=object),
                "tokens": pd.Series([tokens[cuts[k] : cuts[k + 1]].astype("<i8").tobytes() for k in some], dtype=object),
            })

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        book = frame[frame["tokens"].isna()].iloc[0]
        rows = frame[frame["tokens"].notna()]
        n = np.asarray(book["sizes"], np.int64)
        place = np.frombuffer(b"".join(rows["places"]), "<u2").astype(np.int64)
        token = np.frombuffer(b"".join(rows["tokens"]), "<i8")
        order = np.lexsort((token, place))
        shared = np.bincount(place, minlength=len(n))
        cuts = np.cumsum(shared)[:-1]
        near = (4 * shared >= 3 * n) & (n > 0)
        sets = [s if ok else None for s, ok in zip(np.split(token[order], cuts), near, strict=True)]
        return pd.DataFrame({
            "node": (int(book["piece"]) << 16) + np.arange(len(n)), "doc_id": pd.Series(list(book["ids"]), dtype=object),
            "mark": list(book["marks"]), "whole": list(book["wholes"]), "n": n, "tokens": pd.Series(sets, dtype=object),
        })

    book = f"ids array<{key}>, marks array<long>, wholes array<long>, sizes array<int>"
    asked = docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInPandas(
        ask, f"bucket int, piece long, places binary, low binary, {book}"
    )
    told = asked.repartition(buckets, "bucket").mapInPandas(
        compare, f"piece long, places binary, tokens binary, {book}"
    )
    return told.groupBy("piece").applyInPandas(gather, f"node long, doc_id {key}, mark long, whole long, n long, tokens array<long>")


def _checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of nodes that link."""
    shards = 4 * partitions(pairs.sparkSession)
    pairs = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(shards)).alias("salt"))
    shard = F.pmod(F.xxhash64("a", "salt"), F.lit(shards)).alias("shard")
    probes = pairs.select("a", "salt").distinct().join(sets.select(F.col("node").alias("a"), "n", "tokens"), "a").select("a", F.lit(None).cast("long").alias("b"), "n", "tokens", shard)
    stored = pairs.join(sets.select(F.col("node").alias("b"), "n", "tokens"), "b").select("a", "b", "n", "tokens", shard)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        left, right = rows[rows["b"].isna()], rows[rows["b"].notna()].astype({"b": np.int64})
        partners = dict(list(right.groupby("a")))
        for a, n, tokens in zip(left["a"], left["n"], left["tokens"], strict=True):
            part = partners.pop(a, None)
            if part is None:
                continue
            needed = -(-3 * (n + part["n"].to_numpy()) // 7)
            tree = prefix_tree([np.asarray(t) for t in part["tokens"]])
            b = part["b"].to_numpy()
            found += [(a, b[k]) for k in tree_overlaps(tree, np.asarray(tokens), needed)]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return probes.union(stored).groupBy("shard").applyInPandas(run, "a long, b long")


def similar_documents(docs: DataFrame) -> DataFrame:
    """(node, doc_id, mark, n_shingles, component): one row per document.

    Two documents link when their sets of shingles (lower-cased for A-Z) have a Jaccard
    similarity of 0.75 or more. ``component`` is the smallest node (row number) of
    those reachable. A text of fewer than five words is one shingle; one without words
    or NULL has none and links with nothing. Repeated rows and doc_ids are documents of
    their own. Columns other than doc_id and text are ignored; no documents: no rows.
    """
    every = materialise(shared_sets(docs), "shingle-sets")
    near = every.where("tokens IS NOT NULL")
    # Equal sets: all shingles shared, and the same ones.
    same = F.when(F.size("tokens") == F.col("n"), F.md5(F.concat_ws(",", F.col("whole").cast("string"), F.col("tokens").cast("array<string>")))).otherwise(F.col("node").cast("string"))
    near = near.withColumn("same", same)
    first = near.groupBy("same").agg(F.min("node").alias("first"))
    copies = near.select("node", "same").join(first, "same").where("node <> first")
    copies = materialise(copies.select(F.col("node").alias("a"), F.col("first").alias("b")), "equal-sets")
    sets = near.join(copies.select(F.col("a").alias("node")), "node", "left_anti").select("node", "n", "tokens")
    sets = materialise(sets, "distinct-sets")

    # The first n - ceil(3 n / 4) + 1 shingles; the document's own ones are before all others.
    own = F.col("n") - F.size("tokens")
    prefix = F.col("n") - F.ceil(3 * F.col("n") / 4) + 1 - own
    postings = sets.select("node", "n", own.alias("own"), F.posexplode(F.slice("tokens", F.lit(1), prefix.cast("int"))).alias("place", "token"))
    postings = postings.withColumn("place", F.col("own") + F.col("place"))

    by_nearness = Window.partitionBy("token").orderBy("own", "n", "node")
    earlier = F.array(F.first("node").over(by_nearness), F.lag("node", 1).over(by_nearness), F.lag("node", 2).over(by_nearness))
    neighbours = postings.select("node", earlier.alias("earlier")).select("node", F.explode(F.array_distinct("earlier")).alias("a"))
    pairs = neighbours.where("a <> node").groupBy("a", F.col("node").alias("b")).count()
    likeliest = Window.partitionBy("b").orderBy(F.desc("count"), "a")
    tried = pairs.withColumn("turn", F.row_number().over(likeliest)).where("turn <= 3").select("a", "b")
    links = materialise(_checked(tried, sets), "links-1")
    joined = materialise(components(links), "components-1")

    labelled = (
        postings.join(joined, "node", "left")
        .select("token", "node", "n", "place", F.coalesce("component", "node").alias("component"))
    )
    several = labelled.groupBy("token").agg(
        F.min("component").alias("least"), F.max("component").alias("most")
    ).where("least < most").select("token")
    open_rows = materialise(labelled.join(several, "token"), "open-postings")
    left = open_rows.select("token", F.col("node").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), F.col("component").alias("ca"))
    right = open_rows.select("token", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("component").alias("cb"))
    # A pair needs an overlap of ceil(3 (na + nb) / 7), so it shares one of the first
    # n - overlap + 1 shingles of both.
    overlap = F.ceil(3 * (F.col("na") + F.col("nb")) / 7)
    fits = (F.col("ca") != F.col("cb")) & (
        (F.col("na") < F.col("nb")) | (F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))
    ) & (F.col("pa") <= F.col("na") - overlap) & (F.col("pb") <= F.col("nb") - overlap)
    open_pairs = left.join(right, "token").where(fits).select("a", "b").distinct()
    more = _checked(open_pairs, sets)
    reached = components(links.union(more).union(copies))
    return every.join(reached, "node", "left").select(
        "node", "doc_id", "mark", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component")
    )


def document_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id): component_id is the smallest doc_id reachable."""
    found = materialise(similar_documents(docs), "similar")
    least = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return found.join(least, "component").select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents less all but one of each component: the one of smallest doc_id (NULL last), then row number.

    NULL and empty texts all stay, repeated rows leave one, texts of any length are compared
    whole. Other columns come back as they are, whatever their names. No documents: no rows.
    """
    found = materialise(similar_documents(docs), "similar")
    plain, given = plainly_named(docs, "doc_id", "text")
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")).alias("f"))
    stay = found.join(first.select(F.col("f.node").alias("node")), "node", "left_semi")
    stay = stay.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(F.count("*").alias("_rows"))
    equal = Window.partitionBy("_id", "_mark").orderBy("_rows")
    return (
        plain.join(stay, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_mark")))
        .withColumn("_row", F.row_number().over(equal)).where("_row <= _rows").select(*given)
    )
