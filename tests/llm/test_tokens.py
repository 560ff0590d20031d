"""Operators on tokens against the tokenizers library on whole texts."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from obsflow.llm import bpe, token_counts, token_files
from obsflow.llm.queries import QUERIES

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n\n", "a", "  two  spaces ", "tab\tand\n\n\nlines \n", "don't we'll I'VE 123 4567", "x" * 3000,
    "café É À̀ İ ΣΣ ẞ", "nb  \n\nsp   　x", "<|endoftext|>",
    "a <|endoftext|>  b<|endoftext|>", " \x1c\x1d a\x1cb \x85 c", "​ zero ᠎", "emoji \U0001f600\U0001f468‍\U0001f469",
    "กำ क्", "<|startoftext|>x", "á́ ́b", "!!!\n???", "".join(map(chr, range(0x21, 0x250))), "\u212b A\u030a \u0130x \u01c5 <|x|>y",
    "a\u08971\u0897 \U000107bbx \u1c89 \ua7dd",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(ODD)] + [(3, "\n\n", "clash", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, bpe_ids string, n int").repartition(3)


def test_bpe_equals_the_library(odd):
    library = Tokenizer.from_file(BYTE)
    out = bpe.bpe_round_trip(odd, BYTE).collect()
    assert len(out) == len(ODD) + 1 and out[0].n == 1
    for row in out:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert np.frombuffer(row.bpe_ids, "<u4").tolist() == ids, row.text
        assert row.bpe_decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.bpe_round_trip(odd.limit(0), BYTE).count() == 0


def test_query_bpe(spark, sf_dir):
    library = Tokenizer.from_file(BYTE)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op10_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        assert row.decoded_sha256 == hashlib.sha256(decoded).hexdigest()


def expected_files(rows):
    library, start, out = Tokenizer.from_file(WORD), 0, []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_round_trip(spark, odd):
    rows = [(i, t) for i, t in enumerate(ODD)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = token_files.token_files(frame, WORD).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in out) == expected_files(rows)
    assert token_files.token_files(frame.limit(0), WORD).count() == 0
    assert token_files.token_files(odd, WORD).count() == len(ODD) + 1


def test_query_token_files(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = [tuple(r) for r in QUERIES["op5_token_files"](spark, sf_dir).collect()]
    assert sorted(out) == expected_files(rows)


def test_packing_every_length():
    values = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 7], np.uint32)
    for counts in ([9], [0, 4, 0, 5], [1] * 9, [3, 3, 3, 0]):
        n = np.array(counts)
        control, data = token_files.pack(values, n)
        assert [len(c) for c in control] == [-(-k // 4) for k in counts]
        assert token_files.unpack(n, control, data).tolist() == values.tolist()
    assert token_files.pack(values[:0], np.array([0])) == ([b""], [b""])
    assert token_files.unpack(np.array([0]), [b""], [b""]).tolist() == []


def brute_sections(text):
    ends, at = [], 0
    for line in text.splitlines(keepends=True) if not set(text) & set("\r\x0b\x0c\x1c\x1d\x1e\x85  ") else [p + "\n" for p in text.split("\n")]:
        at = min(at + len(line), len(text))
        ends.append(at)
    ends = ends or [0]
    if len(ends) > 1 and ends[-1] == ends[-2]:
        ends.pop()
    counts = [0] * len(ends)
    for a, b in Tokenizer.from_file(BYTE).encode(text, add_special_tokens=False).offsets:
        shares = [min(b, e) - max(a, s) for s, e in zip([0, *ends], ends)]
        counts[shares.index(max(shares))] += 1
    return [(i, s, e, c) for i, (s, e, c) in enumerate(zip([0, *ends], ends, counts))]


def test_sections_equal_brute_force(spark, odd, sf_dir):
    frame = odd.select("doc_id", "text").distinct()
    sample = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 40").selectExpr("doc_id + 1000 AS doc_id", "text")
    rows = frame.union(sample).collect()
    found = {}
    for r in token_counts.section_token_counts(spark.createDataFrame(rows, "doc_id long, text string"), BYTE).collect():
        found.setdefault(r.doc_id, []).append((r.section, r.start, r.end, r.n_tokens))
    for r in rows:
        expected = brute_sections(r.text) if r.text is not None else None
        assert (sorted(found[r.doc_id]) if r.doc_id in found else None) == expected, r.text


def test_query_sections_add_up(spark, sf_dir):
    library = Tokenizer.from_file(BYTE)
    total = QUERIES["op3_token_counts"](spark, sf_dir).groupBy("doc_id").sum("n_tokens").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(total) == len(texts)
    for doc_id, n in total:
        assert n == len(library.encode(texts[doc_id], add_special_tokens=False).ids)
