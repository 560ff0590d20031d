"""Token ids in compact files: frequency ranks in whole bytes, lengths kept apart.

File format (a folder):

* ``vocabulary``: (rank, id), rank 0 for the most frequent id of the corpus.
* ``shards``: one row per document in ascending doc_id order over the files in the
  order of ``shard``: doc_id, shard, first (ids before it in its shard), n, control,
  data. Each id is written as its rank in 1 to 4 little-endian bytes of ``data``.
  ``control`` has two bits per id, four ids a byte, lowest bits first: the number
  of bytes less one. Frequent ids thereby cost 1.25 bytes.

Decoding looks up the lengths of four ids per control byte, and ids by rank, in
numpy tables.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsflow.llm.chunked import tokenizer, word_ids
from obsflow.llm.common import partitions, text_batches
from obsflow.scratch import scratch_path

PORTION = 400_000
PACKED = "n long, control binary, data binary"
_LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.int64)  # by control byte


def pack(values: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Control and data bytes of each document; ``values`` holds ``counts`` unsigned 32-bit ones of each."""
    values = np.ascontiguousarray(values, "<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]].tobytes()
    slots, owner_start = -(-counts // 4) * 4, np.cumsum(counts) - counts
    four = np.zeros(slots.sum(), np.uint8)
    four[np.arange(len(values)) + np.repeat(np.cumsum(slots) - slots - owner_start, counts)] = extra
    four = four.reshape(-1, 4)
    control = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).tobytes()
    sizes = np.concatenate(([0], np.cumsum(extra.astype(np.int64) + 1)))
    ends = np.cumsum(counts)
    return _cut(control, np.cumsum(slots) // 4), _cut(data, sizes[ends] if len(ends) else ends)


def unpack(counts: np.ndarray, control: list[bytes], data: list[bytes]) -> np.ndarray:
    """The values of all documents, one after the other."""
    slots = -(-counts // 4) * 4
    every = _LENGTHS[np.frombuffer(b"".join(control), np.uint8)].reshape(-1)
    place = np.arange(slots.sum()) - np.repeat(np.cumsum(slots) - slots, slots)
    lengths = every[place < np.repeat(counts, slots)]
    at = np.cumsum(lengths) - lengths
    raw = np.frombuffer(b"".join(data) + b"\0\0\0", np.uint8)
    values = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        values[longer] |= raw[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def _portions(frames, sizes):
    """Cut pandas frames so that a portion holds about PORTION ids; ``sizes`` gives those of each row."""
    for frame in frames:
        part = np.cumsum(sizes(frame)) // PORTION
        start = 0
        for end in [*(np.flatnonzero(np.diff(part)) + 1), len(frame)]:
            if end > start:
                yield frame.iloc[start:end]
            start = end


def _cut(raw: bytes, ends: np.ndarray) -> list[bytes]:
    out, start = [], 0
    for end in ends.tolist():
        out.append(raw[start:end])
        start = end
    return out


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1) -> None:
    """Encode every text, append ``end_id`` and write the folder ``path``.

    NULL text counts as empty: its only id is ``end_id``. Equal doc_ids follow each
    other; NULL doc_ids come first. Columns other than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    shards = partitions(spark)

    size = max(tokenizer(tokenizer_path).get_vocab_size(), end_id + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"  # of ids before they are ranked
    width = np.dtype(kind).itemsize

    def encode(frames):
        words, end = word_ids(tokenizer_path), np.uint32(end_id).tobytes()
        for part in text_batches(frames):
            ids = [(words.text(t) if isinstance(t, str) else b"") + end for t in part["text"]]
            ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) // 4 * width
            ids = _cut(np.frombuffer(b"".join(ids), "<u4").astype(kind).tobytes(), ends)
            yield part[["doc_id"]].assign(ids=pd.Series(ids, index=part.index, dtype=object))

    key = docs.schema["doc_id"].dataType.simpleString()
    once = f"{path}/unranked"
    encoded = docs.select("doc_id", "text").mapInPandas(encode, f"doc_id {key}, ids binary")
    encoded.write.option("compression", "zstd").parquet(once)
    unranked = spark.read.parquet(once)

    def count(frames):
        total = np.zeros(size, np.int64)
        for frame in _portions(frames, lambda f: f["ids"].str.len().to_numpy(np.int64) // width):
            total += np.bincount(np.frombuffer(b"".join(frame["ids"]), kind), minlength=size)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"id": seen, "seen": total[seen]})

    order = Window.orderBy(F.desc("seen"), "id")  # at most one row per id of the vocabulary
    (
        unranked.select("ids").mapInPandas(count, "id long, seen long")
        .groupBy("id").agg(F.sum("seen").alias("seen"))
        .select((F.row_number().over(order) - 1).alias("rank"), "id")
        .write.parquet(f"{path}/vocabulary")
    )
    rank_of = np.zeros(size, np.uint32)
    for row in spark.read.parquet(f"{path}/vocabulary").collect():  # bounded by the vocabulary
        rank_of[row.id] = row.rank
    ranks = spark.sparkContext.broadcast(rank_of)

    def place(frames):
        shard, first = TaskContext.get().partitionId(), 0
        for frame in _portions(frames, lambda f: f["ids"].str.len().to_numpy(np.int64) // width):
            n = frame["ids"].str.len().to_numpy(np.int64) // width
            control, data = pack(ranks.value[np.frombuffer(b"".join(frame["ids"]), kind)], n)
            before = first + np.cumsum(n) - n
            first += int(n.sum())
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "n": n, "control": control, "data": data, "shard": shard, "first": before,
            })

    # Placed before it is ranked: the sampling that finds the bounds then reads and does no more.
    (
        unranked.withColumn("tie", F.xxhash64("ids"))
        .repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
        .mapInPandas(place, f"doc_id {key}, {PACKED}, shard int, first long")
        .write.parquet(f"{path}/shards")
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (binary, little-endian unsigned 32-bit)."""
    shards = spark.read.parquet(f"{path}/shards")
    vocabulary = spark.read.parquet(f"{path}/vocabulary").collect()  # bounded by the vocabulary
    id_of = np.zeros(len(vocabulary) or 1, np.uint32)
    for row in vocabulary:
        id_of[row.rank] = row.id
    ids_by_rank = spark.sparkContext.broadcast(id_of)

    def decode(frames):
        for frame in _portions(frames, lambda f: f["n"].to_numpy(np.int64)):
            n = frame["n"].to_numpy(np.int64)
            ids = ids_by_rank.value[unpack(n, list(frame["control"]), list(frame["data"]))].astype("<u4").tobytes()
            yield frame[["doc_id", "shard", "first", "n"]].assign(
                ids=pd.Series(_cut(ids, 4 * np.cumsum(n)), index=frame.index, dtype=object)
            )

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        shards.groupBy("shard").agg(F.sum("n").alias("n"))
        .select(F.col("shard").alias("base_shard"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )  # one row per shard
    key = shards.schema["doc_id"].dataType.simpleString()
    return (
        shards.mapInPandas(decode, f"doc_id {key}, shard int, first long, n long, ids binary")
        .join(F.broadcast(bases), F.col("shard") == F.col("base_shard"))
        .select("doc_id", (F.col("base") + F.col("first")).alias("start"), F.col("n").alias("n_tokens"), "ids")
    )


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Write the documents' ids and read them back. No documents: no rows."""
    path = path or scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer_path, end_id)
    return read_token_files(docs.sparkSession, path)
