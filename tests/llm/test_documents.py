"""Operators on documents against brute force, with nulls, empty and long texts, ties and clashing columns."""

import random

import numpy as np
import pytest

import brute
from obsflow.llm import exchange, mixing, ngram_join, quality_rules, substring_dedup, toxicity
from obsflow.llm.queries import QUERIES


@pytest.fixture(scope="module")
def copies(spark):
    """Groups of near copies, passages across documents, short, empty and NULL texts, repeated rows."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    base, passage, rows = text(120), text(70), []
    for k in range(40):  # one large group, up to 30 words changed
        w = list(base)
        for _ in range(k % 6):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((100 + k, " ".join(w)))
    for k in range(12):  # one passage in different texts
        rows.append((300 + k, " ".join(text(30 + k) + passage[: 50 + k] + text(20)).replace(" ", "\n", k)))
    rows += [(10 + k, t) for k, t in enumerate([None, "", "  \t", "one", "ONE", "one two three", "one two THREE", "a b c d e", "A b c d e", "a b c d f"])]
    rows += [(500, " ".join(base)), (500, " ".join(base)), (50, "Word " * 3000), (51, "word " * 3001), (None, " ".join(passage)), (None, None)]
    rows.append((1, " ".join(passage + passage[:49])))
    frame = [(i, t, "en", "s", 1, "clash") for i, t in rows]
    return rows, spark.createDataFrame(frame, "doc_id long, text string, lang string, source string, n int, tokens string").repartition(5)


def test_ngram_join(copies):
    rows, frame = copies
    out = sorted((tuple(r) for r in ngram_join.document_components(frame).collect()), key=repr)
    assert out == brute.components(rows)
    assert ngram_join.document_components(frame.limit(0)).count() == 0


def test_shingles_that_share_forty_bits(spark, settings):
    settings(spark__sql__shuffle__partitions="200")
    rows = [(1, "w218 w1873 w3848 w416 w1860"), (2, "w4163 w3913 w3515 w1399 w561")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted(tuple(r) for r in ngram_join.document_components(frame).collect()) == [(1, 1, 1), (2, 1, 2)]


def test_one_of_each(copies):
    rows, frame = copies
    kept = ngram_join.one_of_each(frame)
    assert kept.columns == frame.columns
    expected = {}
    for doc_id, n, least in brute.components(rows):
        if n and least is not None:
            expected[least] = 1
    found = [r.doc_id for r in kept.collect()]
    assert sorted(d for d in found if d is not None and d not in (10, 11, 12)) == sorted(expected)
    assert found.count(None) == 1 + (None in [c for _, n, c in brute.components(rows) if n])


def test_query_ngram_join(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = sorted((tuple(r) for r in QUERIES["op4_ngram_join"](spark, sf_dir).collect()), key=repr)
    assert out == brute.components(rows)


def test_prefix_tree_counts_every_overlap():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))) for _ in range(60)]
    sets += [sets[0], sets[1][:1]]
    tree = ngram_join.prefix_tree(sets)
    for probe in sets:
        for least in (1, 8):
            found = ngram_join.tree_overlaps(tree, probe, np.full(len(sets), least))
            true = {k: len(np.intersect1d(probe, s)) for k, s in enumerate(sets)}
            assert found == {k: n for k, n in true.items() if n >= least}


def test_prefix_tree_of_thousands_of_levels():
    n = 5000
    sets = [np.arange(k) for k in range(n, 0, -1)]  # each leaves the others one level higher
    found = ngram_join.tree_overlaps(ngram_join.prefix_tree(sets), np.arange(n), np.full(n, 100))
    assert found == {k: n - k for k in range(n) if n - k >= 100}


def test_substring_dedup(copies):
    rows, frame = copies
    expected = sorted((d, n, r, brute.digest(w)) for d, n, r, w in brute.substring_dedup(rows) if d is not None)
    out = [tuple(r) for r in substring_dedup.dedup_report(frame).collect()]
    assert sorted(r for r in out if r[0] is not None) == expected
    assert sorted(r[1:3] for r in out if r[0] is None) == [(0, 0), (70, 0)]
    assert substring_dedup.dedup_report(frame.limit(0)).count() == 0
    texts = substring_dedup.dedup_documents(frame)
    assert texts.columns == frame.columns and texts.count() == len(rows)
    kept = sorted((r.doc_id, tuple(brute.words(r.text))) for r in texts.collect() if r.doc_id is not None)
    assert kept == sorted((d, tuple(w)) for d, _, _, w in brute.substring_dedup(rows) if d is not None)


def test_substring_dedup_tells_windows_of_one_short_hash_apart(spark, settings):
    settings(spark__sql__shuffle__partitions="1")  # one bucket: it tells nothing about a hash
    passages = [[f"w{i}" for i in range(start, start + 50)] for start in (205, 4223998)]
    values = [exchange.window_values(exchange.word_values([w.encode() for w in p]), 50)[0] for p in passages]
    assert values[0] != values[1] and len({int(v) % (1 << 40) for v in values}) == 1
    rows = [(1, " ".join(passages[0])), (2, " ".join(passages[1])), (3, " ".join(["a", *passages[1], "b"]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(tuple(r) for r in substring_dedup.dedup_report(frame).collect())
    assert out == sorted((d, n, r, brute.digest(w)) for d, n, r, w in brute.substring_dedup(rows))


def test_query_substring_dedup(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = sorted(tuple(r) for r in QUERIES["op8_substring_dedup"](spark, sf_dir).collect())
    assert out == sorted((d, n, r, brute.digest(w)) for d, n, r, w in brute.substring_dedup(rows))


def test_suffix_automaton_matching_statistics():
    rng = random.Random(5)
    for _ in range(60):
        parts = [[rng.randrange(3) for _ in range(rng.randrange(1, 15))] for _ in range(3)]
        probe = [rng.randrange(4) for _ in range(20)]
        automaton = substring_dedup.SuffixAutomaton()
        for p in parts:
            automaton.add(p)
        inside = {tuple(p[a:z]) for p in parts for a in range(len(p)) for z in range(a, len(p) + 1)}
        true = [max(n for n in range(i + 2) if tuple(probe[i + 1 - n : i + 1]) in inside) for i in range(len(probe))]
        assert automaton.matches(probe) == true


def test_base_counts(spark, sf_dir, copies):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = {r.doc_id: r for r in QUERIES["op6_quality_rules"](spark, sf_dir).collect()}
    assert len(out) == len(rows)
    for doc_id, text in rows:
        r = out[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.base_counts(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    for _, text in copies[0]:
        assert quality_rules.measures(text or "")[0:2] == brute.base_counts(text)[0:2]
        assert quality_rules.measures(text or "")[4] == brute.base_counts(text)[4]


def test_cutoffs_are_certified_and_reject_junk(spark):
    rng = random.Random(7)
    good = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(80))
    junk = lambda: " ".join(f"w{rng.randrange(5000)} ###%%%" for _ in range(60))
    rows, labels = [], []
    for i in range(3000):
        bad = i % 4 == 0
        rows.append((i, junk() if bad else good(), "en" if i < 2900 else None, "x"))
        labels.append((i, None if i % 50 == 1 else int(not bad)))
    rows += [(9000, None, "en", "x"), (9001, "", "en", "x"), (9002, junk(), "fr", "x"), (0, rows[0][1], "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string").repartition(4)
    marks = spark.createDataFrame(labels + [(5, 0)], "doc_id long, quality int")
    out = quality_rules.judge_documents(docs, marks).collect()
    assert len(out) == len(rows)
    kept = {(r.doc_id, r.lang): r.kept for r in out}
    assert all(kept[i, "en"] == (i % 4 != 0) for i in range(2900))
    assert kept[9002, "fr"] and kept[2904, None]  # too few labels: no cutoff
    assert not kept[9000, "en"] and not kept[9001, "en"]
    assert quality_rules.judge_documents(docs.limit(0), marks).count() == 0
    assert all(r.kept == (not r.base_failed) for r in quality_rules.judge_documents(docs, marks.limit(0)).collect())


def test_binomial_tail_is_exact():
    from math import comb, exp

    for n, k, p in [(10, 0, 0.1), (40, 3, 0.2), (7, 7, 0.5)]:
        true = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert exp(quality_rules.log_tail(k, n, p)) == pytest.approx(true, rel=1e-9)
    rejected = np.array([50, 20, 2, 0, 0])  # out of 1000, by cutoffs from strict to loose
    assert quality_rules.certified(rejected, 1000, 0.0125, 0.0025) == 2
    assert quality_rules.certified(rejected, 100, 0.0125, 0.0025) == 5


def test_toxicity_on_held_out_labels(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    label = {r.doc_id: r.toxic for r in rows}
    out = QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.1").collect()
    held = [r for r in out if r.held_out and r.doc_id in label]
    toxic = [r.score for r in held if label[r.doc_id]]
    clean = [r.score for r in held if not label[r.doc_id]]
    wins = np.searchsorted(np.sort(clean), toxic).mean() / len(clean)
    assert wins > 0.95
    assert sum(s >= 0.3 for s in toxic) / len(toxic) > 0.75
    assert sum(s >= 0.3 for s in clean) / len(clean) < 0.02
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)


def test_toxicity_edges(spark, copies):
    _, frame = copies
    docs = frame.withColumnRenamed("tokens", "score")
    labels = spark.createDataFrame([(100, 0, 1), (100, 0, 0), (101, 1, None), (None, 0, 1), (77777, 0, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == frame.count() and len({r.score for r in out if not (r.text or "").strip()}) == 1
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_mixing_targets_and_copies(spark):
    rows = [(i, "w " * (i % 7 + 1), s, "x") for s, n in (("b", 40), ("a", 4), (None, 30), ("c", 25)) for i in range(n)]
    rows += [(900, None, "a", "x"), (901, "", "d", "x"), (902, " \n", "a", "x"), (3, "w " * 4, "b", "x"), (3, "w " * 4, "b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_note string").repartition(4)
    out = mixing.mix_sources(docs).collect()
    assert len(out) == len(rows)
    total = sum(r.mix_size for r in out)
    targets = {r.source: (r.mix_target, r.mix_source_size) for r in out}
    assert sum(t for t, _ in targets.values()) == pytest.approx(1.5 * total)
    weights = dict(zip(sorted(s for s in targets if s is not None) + [None], (5, 2, 1, 5, 2)))
    free = {s: t / weights[s] for s, (t, n) in targets.items() if t < 2 * n}
    assert all(v == pytest.approx(next(iter(free.values()))) for v in free.values())
    for s, (target, size) in targets.items():
        own = [r for r in out if r.source == s]
        assert target <= 2 * size and abs(sum(r.mix_taken for r in own) - target) <= max(r.mix_size for r in own) / 2 + 1e-9
        assert all(r.mix_taken in {int(target // size) * r.mix_size, (int(target // size) + 1) * r.mix_size} for r in own if size)
    copies_ = mixing.mixed_documents(docs)
    assert copies_.columns == docs.columns and copies_.count() == sum(r.mix_copies for r in out)
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_substring_dedup_of_named_documents(spark, copies):
    rows, frame = copies
    named = [(None if d is None else f"d{d:04d}", t) for d, t in rows]
    order = frame.selectExpr("'d' || lpad(doc_id, 4, '0') AS doc_id", "text")
    found = sorted((tuple(r)[:3] for r in substring_dedup.dedup_report(order).collect()), key=repr)
    assert found == sorted(((d, n, gone) for d, n, gone, _ in brute.substring_dedup(named)), key=repr)
    kept = sorted(((r.doc_id, r.text) for r in substring_dedup.dedup_documents(order).collect()), key=repr)
    texts = zip(named, brute.substring_dedup(named), strict=True)
    assert kept == sorted(((d, " ".join(w) if gone else t) for (d, t), (_, _, gone, w) in texts), key=repr)
