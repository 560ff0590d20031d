"""Stages of the pipeline against brute force on their own inputs."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from obsflow.llm import quality_rules
from obsflow.scratch import materialise


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, inputs = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs.collect())
        docs = materialise(stage(spark, docs, sf_dir), "test-stage")
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
    last = docs.collect()

    judged = quality_rules.judge_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert {r.doc_id for r in inputs[1]} == {r.doc_id for r in judged.collect() if r.kept}
    groups = brute.components([(r.doc_id, r.text) for r in inputs[1]])
    assert sorted(r.doc_id for r in inputs[2]) == sorted(d for d, _, c in groups if d == c)
    kept = {d: w for d, _, _, w in brute.substring_dedup([(r.doc_id, r.text) for r in inputs[2]])}
    assert {r.doc_id: brute.words(r.text) for r in inputs[3]} == kept
    times = {}
    for r in inputs[4]:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    size = {r.doc_id: len(brute.words(r.text)) for r in inputs[3]}
    assert max(times.values()) <= 2
    assert abs(sum(size[d] * n for d, n in times.items()) / sum(size.values()) - 1.5) < 0.05
    library, text = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), {r.doc_id: r.text for r in inputs[4]}
    assert len(last) == len(inputs[4])
    for r in last:
        ids = library.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


CLASHING = [
    "_id", "_mark", "_rows", "_row", "_spans", "_stratum", "_cut_symbols", "mix_size", "mix_copy", "mix_key", "plan_source",
    "n_words", "kept", "base_failed", "number", "spans", "of_text", "mark", "node", "tokens", "column_0", "a.b",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Documents without labels: NULL, empty, very long, repeated and copied texts; clashing columns, some NULL."""
    rng = random.Random(8)
    text = lambda n: [f"w{rng.randrange(30000)}" for _ in range(n)]
    base, passage = text(200), text(60)
    texts = [None, "", " \n", "short one", "again " * 90, " ".join(base), " ".join(base[:-1] + ["other"]), " ".join(text(180000))]
    texts += [" ".join(text(60 + k) + passage + text(k)) for k in range(6)] + [" ".join(text(80)) for _ in range(30)]
    rows = [(10**9 + k, t, [None, "en", "xx"][k % 3], [None, "a", "b", "c"][k % 4], k) for k, t in enumerate(texts)]
    rows += [rows[5], rows[9], (None, " ".join(text(70)), "en", "a", None)]
    extra = [[None if k % 5 == 0 else 2**53 + 1 + 2 * k + j for j in range(len(CLASHING))] for k in range(len(rows) - 3)]
    extra += [extra[5], extra[9], [7] * len(CLASHING)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` long" for c in CLASHING)
    return spark.createDataFrame([(*r, *e) for r, e in zip(rows, extra, strict=True)], schema).repartition(3)


def test_stages_on_odd_documents(spark, sf_dir, odd):
    docs, inputs = odd, []
    given = {r.doc_id: tuple(r)[5:] for r in odd.collect()}
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs.collect())
        docs = materialise(stage(spark, docs, sf_dir), "test-stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.schema.simpleString() == odd.schema.simpleString()
            assert all(tuple(r)[5:] == given[r.doc_id] for r in docs.collect())
    count = lambda rows: Counter((r.doc_id, r.text) for r in rows)

    passing = [r for r in inputs[0] if not base_fails(brute.words(r.text))]
    assert count(inputs[1]) == count(passing) and len(passing) > 35
    least = {d: c for d, _, c in brute.components([(r.doc_id, r.text) for r in inputs[1]])}
    one = {(r.doc_id, r.text) for r in inputs[1] if r.doc_id == least[r.doc_id]}
    assert count(inputs[2]) == Counter(one)
    kept = {d: w for d, _, _, w in brute.substring_dedup([(r.doc_id, r.text) for r in inputs[2]])}
    assert {r.doc_id: brute.words(r.text) for r in inputs[3]} == kept
    assert sum(len(brute.words(r.text)) for r in inputs[3]) < sum(len(brute.words(r.text)) for r in inputs[2])
    assert set(count(inputs[4]).values()) <= {1, 2} and set(count(inputs[4])) <= set(count(inputs[3]))
    assert max(len(r.text) for r in inputs[4]) > 1_000_000
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = Counter((r.doc_id, len(library.encode(r.text, add_special_tokens=False).ids)) for r in inputs[4])
    assert Counter((r.doc_id, r.n_tokens) for r in docs.collect()) == sizes


def base_fails(words):
    """Under 50 words, or more than half of them in a 3-word window found twice."""
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    again = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    return len(words) < 50 or 2 * len(again) > len(words)


def test_stages_on_no_documents(spark, sf_dir, odd):
    docs = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "test-stage")
        assert docs.count() == 0
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
