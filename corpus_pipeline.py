"""From raw documents to token ids in five stages, each by an operator of obsflow.llm.

Quality rules reject, near copies leave one of each group, repeated passages are cut
out, sources are mixed to their targets (documents may repeat), and the mix is encoded
and decoded again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.bpe import bpe_round_trip
from obsflow.llm.common import table
from obsflow.llm.mixing import mixed_documents
from obsflow.llm.ngram_join import one_of_each
from obsflow.llm.quality_rules import good_documents
from obsflow.llm.substring_dedup import dedup_documents
from obsflow.scratch import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the base and their language's cutoffs; NULL and empty texts go."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id, of repeated rows one."""
    return one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without words that repeat an earlier one's passage; ``n_chars`` follows, NULL text keeps it."""
    return dedup_documents(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it: not at all, once or twice."""
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document of the mix: doc_id, n_tokens and the digests of its ids and of the decoded text."""
    return bpe_round_trip(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", (F.octet_length("bpe_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("bpe_ids", 256).alias("ids_sha256"), F.sha2("bpe_decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources", mixing),
    ("BPE encoding", encoding),
]

#: The certified cutoffs, components and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is written and read again.

    Texts of any length pass whole. Every stage but the last returns the columns of its
    documents, whatever their names; an empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
