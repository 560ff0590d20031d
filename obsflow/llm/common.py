"""What several operators share: words, tables of a folder, hashing of words."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than the six ASCII white spaces.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(column, UPPER, LOWER)


def n_words(text) -> Column:
    """Number of words; NULL text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def plainly_named(docs: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """The frame with all columns but ``used`` named by their place, and the columns that give it back as it was.

    What an operator adds then clashes with no name a user may have chosen.
    """
    plain = [c if c in used else f"column_{i}" for i, c in enumerate(docs.columns)]
    quoted = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    renamed = docs.select(*(F.col(q).alias(p) for q, p in zip(quoted, plain, strict=True)))
    return renamed, [F.col(p).alias(c) for p, c in zip(plain, docs.columns, strict=True)]


def partitions(spark: SparkSession) -> int:
    """Number of shuffle partitions, a setting to be raised with the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every input bit moves every output bit."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x7FB5D329728EA185)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x81DADEF4BC2DD44D)
        x ^= x >> np.uint64(33)
    return x


def give_back() -> None:
    """Hand a worker's free memory back to the machine.

    Workers live on from stage to stage, and what one has freed counts as the executor's
    until it is handed back. Does nothing where the C library cannot.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Bounded(dict):
    """Remembers about ``size`` to twice ``size`` results of a pure function.

    When full, the younger half becomes the older one and what is used again
    moves back, so frequent keys stay and memory is bounded. Keys longer than ``longest``
    are computed each time.
    """

    def __init__(self, compute, size: int, longest: int | None = None):
        super().__init__()
        self._compute, self._size, self._longest, self._older = compute, size, longest, {}

    def empty(self) -> None:
        self.clear()
        self._older = {}

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._compute(key)
            if self._longest is not None and len(key) > self._longest:
                return value
        if len(self) >= self._size:
            self._older = dict(self)
            self.clear()
        self[key] = value
        return value


def text_batches(frames: Iterator, most: int = 4 << 20) -> Iterator:
    """Cut pandas frames so that one piece holds about ``most`` characters of text."""
    for frame in frames:
        size = frame["text"].str.len().fillna(0).to_numpy(dtype=np.int64) + 1
        part = np.cumsum(size) // most
        start = 0
        for end in [*(np.flatnonzero(np.diff(part)) + 1), len(frame)]:
            if end > start:
                yield frame.iloc[start:end]
            start = end
