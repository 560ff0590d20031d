"""Toxicity scores by FTRL-proximal logistic regression over hashed word features.

Features are the distinct words, stems (first letters of a word, for inflected
languages), neighbouring pairs and pairs with one word left out (skip-grams) of a
lower-cased text, hashed to ``2 ** BITS`` weights. FTRL-proximal
keeps a learning rate per coordinate and drives weights of little evidence to exactly
zero, so what is broadcast is the short list of the others.

Features are made where the documents are. Learning is sequential: it runs in one
task on a bounded sample of labelled documents (``SAMPLE``, by a hash of the id). All
documents are scored, in whole.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import Bounded, mixed, text_batches

BITS = 20
#: Labelled documents used for learning at most: all up to here, else those with the smallest hashes.
SAMPLE = 20_000
#: Features in fewer labelled documents of the sample are not learned.
MIN_DOCS = 3
PASSES = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 0.1
STEM = 5
CACHED = 300_000


def _word(word: bytes) -> tuple[int, int]:
    """64-bit values of a word without the punctuation around it, and of its stem."""
    bare = word.strip(b".,;:!?\"'()[]|") or word
    stem = bare.decode()[:STEM].encode()
    return tuple(zlib.crc32(w) << 32 | zlib.adler32(w) for w in (bare, b"^" + stem))


_WORDS = Bounded(_word, CACHED)


def features(text: str) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text."""
    words = text.lower().encode().split()
    both = mixed(np.array(list(map(_WORDS.__getitem__, words)), np.uint64).reshape(-1, 2))
    value = both[:, 0]
    with np.errstate(over="ignore"):
        pair = mixed(value[:-1] * np.uint64(3) + value[1:])
        skip = mixed(value[:-2] * np.uint64(5) + value[2:] * np.uint64(7))
    every = np.concatenate((both.reshape(-1), pair, skip)) >> np.uint64(64 - BITS)
    return np.unique(every.astype(np.int32))


def learn(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Numbers and values of the weights that are not zero, and the intercept."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    seen = np.zeros(1 << BITS, np.int32)
    for row in rows:
        seen[row] += 1
    rows = [row[seen[row] >= MIN_DOCS] for row in rows]
    bias = np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)) if len(labels) else 0.0
    bias_squares = 0.0

    def weights(i):
        return np.where(np.abs(z[i]) <= L1, 0.0, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for turn in range(PASSES):
        for k in np.random.default_rng(turn).permutation(len(rows)):
            i = rows[k]
            w = weights(i)
            error = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -30, 30))) - labels[k]
            root = np.sqrt(n[i])
            n[i] += error * error
            z[i] += error - (np.sqrt(n[i]) - root) / ALPHA * w
            bias_squares += error * error
            bias -= 0.05 * error / (1 + np.sqrt(bias_squares))
    w = weights(slice(None))
    kept = np.flatnonzero(w)
    return kept.astype(np.int32), w[kept], float(bias)


def fit(labelled: DataFrame) -> DataFrame:
    """Weights (feature int, weight double) from rows (doc_id, text, toxic); the intercept is feature -1.

    All rows meet in one task, each document once: their number is to be bounded.
    """

    def to_features(frames):
        for part in text_batches(frames):
            rows = [features(t if isinstance(t, str) else "").tobytes() for t in part["text"]]
            yield part[["doc_id", "toxic"]].assign(features=pd.Series(rows, index=part.index, dtype=object))

    def to_weights(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "toxic"])
        rows = [np.frombuffer(f, np.int32) for f in frame["features"]]
        kept, weight, bias = learn(rows, frame["toxic"].to_numpy(np.float64))
        return pd.DataFrame({"feature": np.append(kept, -1), "weight": np.append(weight, bias)})

    key = labelled.schema["doc_id"].dataType.simpleString()
    sample = (
        labelled.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
        .mapInPandas(to_features, f"doc_id {key}, toxic int, features binary")
        .groupBy("doc_id", "toxic").agg(F.min("features").alias("features"))
    )
    return sample.groupBy().applyInPandas(to_weights, "feature int, weight double")


def score(docs: DataFrame, weights: list[tuple[int, float]], threshold: float = 0.3) -> DataFrame:
    """The documents with score (0 to 1) and predicted (1 when the score reaches the threshold).

    NULL and empty texts get the intercept alone. Repeated rows get equal scores;
    columns of the documents named score or predicted are replaced.
    """
    table = np.zeros(1 << BITS, np.float64)
    bias = 0.0
    for feature, weight in weights:
        if feature < 0:
            bias = weight
        else:
            table[feature] = weight
    sent = docs.sparkSession.sparkContext.broadcast((table, bias))  # 2 ** BITS numbers at any size
    kept = docs.drop("score", "predicted")
    schema = kept.select("*", F.lit(0.0).alias("score")).schema

    def run(frames):
        w, start = sent.value
        for part in text_batches(frames):
            sums = np.array([w[features(t)].sum() if isinstance(t, str) else 0.0 for t in part["text"]]) + start
            yield part.assign(score=1 / (1 + np.exp(-np.clip(sums, -30, 30))))

    return kept.mapInPandas(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(doc_id):
    """Rows from which no label is learned."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents, learned from the labels of those that are not held out.

    Labels that are NULL are ignored; a document labelled twice counts once, as its
    highest label, and one learned from is taken once even if its row is repeated.
    Without labels the score is 0.5 throughout; no documents: no rows.
    """
    label = (
        labels.where("toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    )
    labelled = docs.select("doc_id", "text").join(F.broadcast(label), "doc_id")  # at most SAMPLE labels
    weights = [(r.feature, r.weight) for r in fit(labelled).collect()]  # at most 2 ** BITS
    return score(docs, weights).withColumn("held_out", held_out(F.col("doc_id")))
