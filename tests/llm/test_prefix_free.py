"""Byte dedup by prefix-free parsing against brute force."""

import hashlib
import random

import numpy as np
import pytest

from obsflow.llm import prefix_free
from obsflow.llm.queries import QUERIES


def brute(rows, length=100):
    """rows (doc_id, text) -> sorted (doc_id, n_bytes, n_removed, n_spans, sha256 of the rest)."""
    least, out = {}, []
    raws = [(i, (t or "").encode()) for i, t in rows]
    for i, raw in raws:
        if i is not None:
            for k in range(len(raw) - length + 1):
                w = raw[k : k + length]
                if w not in least or i < least[w]:
                    least[w] = i
    for i, raw in raws:
        own, gone = set(), np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1 if i is not None else 0):
            w = raw[k : k + length]
            if least[w] < i or w in own:
                gone[k : k + length] = True
            own.add(w)
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(raw) else 0
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(frame, length=100):
    out = prefix_free.dedup_bytes(frame, length).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def texts(seed):
    """Passages in other surroundings, copies, periods, few letters, many bytes a letter, short and empty texts."""
    rng = random.Random(seed)
    some = lambda n, letters="abcdefgh \n": "".join(rng.choice(letters) for _ in range(n))
    passage = some(400)
    rows = [(i, some(rng.randrange(60)) + passage[rng.randrange(200) : rng.randrange(200, 400)] + some(rng.randrange(300))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(0, 60, 4)]
    rows += [(200, "a" * 700), (201, "ab" * 400), (202, "a" * 99), (203, "a" * 100), (204, "x" + "a" * 300), (205, some(50) * 5)]
    rows += [(210 + i, some(400, "ab")) for i in range(5)] + [(220 + i, some(200, "é€😀") + passage[100:330]) for i in range(4)]
    rows += [(300, None), (301, ""), (302, some(99)), (None, passage), (None, None), (-5, passage[50:250]), (303, passage + passage)]
    rows += [(304, passage), (304, passage), (304, passage[:150] + "!"), (305, some(2000) + passage[:101] + some(20_000, "abc") + passage[7:108])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_dedup_bytes(spark, seed):
    rows = texts(seed)
    frame = spark.createDataFrame([(i, t, 1, "m") for i, t in rows], "doc_id long, text string, places int, mark string").repartition(5)
    assert result(frame) == brute(rows)
    assert result(frame, 40) == brute(rows, 40)


def test_edges(spark):
    frame = spark.createDataFrame(texts(3), "doc_id int, text string")
    assert prefix_free.dedup_bytes(frame.limit(0)).count() == 0
    assert result(frame.where("doc_id = 304 AND text LIKE '%!'")) == brute([(r.doc_id, r.text) for r in frame.where("doc_id = 304 AND text LIKE '%!'").collect()])
    assert prefix_free.dedup_bytes(frame).schema["doc_id"].dataType.simpleString() == "int"
    for r in prefix_free.dedup_bytes(frame, keep=True).collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
        assert len(r.spans) == r.n_spans and sum(s.stop - s.start for s in r.spans) == r.n_removed
    with pytest.raises(ValueError):
        prefix_free.dedup_bytes(frame.select(frame.doc_id.cast("string"), "text"))
    assert spark.catalog.listTables() == []


def test_hot_contexts_go_string_by_string(spark, monkeypatch):
    monkeypatch.setattr(prefix_free, "HOT", 3)
    rows = texts(4)
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)


def test_long_text(spark):
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefghijklmnop") for _ in range(1_200_000))
    rows = [(1, long), (2, long[400_000:400_300]), (3, "?" + long[5:1_100_000] + long[:200])]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_strings_of_contexts_against_all_pairs():
    rng = random.Random(7)
    some = lambda n: bytes(rng.choice(b"ab") for _ in range(n))
    before, behind = [some(rng.randrange(5)) for _ in range(200)], [some(rng.randrange(6, 12)) for _ in range(200)]
    doc, row, t = (np.array([rng.randrange(n) for _ in range(200)]) for n in (40, 2, 1000))
    most = np.array([len(b) for b in before])
    found = set(zip(*(x.tolist() for x in prefix_free.repeated_strings(before, behind, np.zeros(200, int), most, doc, row, t, 10))))
    strings = [(k, a, before[k][len(before[k]) - a :] + behind[k][: 10 - a]) for k in range(200) for a in range(most[k] + 1)]
    strings = [s for s in strings if len(s[2]) == 10]
    expected = set()
    for k, a, w in strings:
        for j, b, x in strings:
            if w == x and a == b and (doc[j] < doc[k] or doc[j] == doc[k] and row[j] == row[k] and (t[j], j) < (t[k], k)):
                expected.add((k, a))
    assert found == expected


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op11_suffix_array_dedup"](spark, sf_dir).collect()), key=repr) == brute(rows)
