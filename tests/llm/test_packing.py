"""Packing: exact round trip of the ids, window limits and defined cases."""

from __future__ import annotations

import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from shoplens.llm import packing


def _ids(texts):
    tok = Tokenizer.from_file(packing.default_tokenizer_files()["json"])
    return [[*tok.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def _check(rows, texts, window):
    want, got, sequences = _ids(texts), {}, {}
    for r in rows:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert len(ids) == r.length >= 1 and r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert r.opens_doc == (r.start == 0) and r.closes_doc == (r.start + r.length == r.doc_tokens)
        got.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(got) == list(range(len(texts)))
    for doc, pieces in got.items():
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at == len(want[doc])
    assert sorted(sequences) == list(range(len(sequences)))
    for s, pieces in sequences.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == window or s == len(sequences) - 1 and at <= window


def test_round_trip(spark, make_docs):
    r = random.Random(1)
    texts = [None, "", "a", "<|endoftext|> in text", "naïve café — “x”…", "日本語 ½ \u0085 ​ x", "\r\n\t  y", " ".join(["long"] * 9000)]
    texts += ["".join(r.choices("ab cé\n!0'sß", k=r.randint(0, 900))) for _ in range(80)]
    texts += [texts[-1]] * 3
    for window in (1024, 16):
        _check(packing.pack(make_docs(texts, "part ids start"), window=window).collect(), texts, window)


def test_ids_column(spark, make_docs):
    rows = packing.pack(make_docs(["one two three four", "five"]), window=3, with_ids=True).collect()
    want = _ids(["one two three four", "five"])
    assert all(np.frombuffer(r.piece_ids, "<u4").tolist() == want[r.doc_id][r.start : r.start + r.length] for r in rows)


def test_fast_and_reference_ids_agree_on_the_common_characters():
    encode = packing._Encoder(packing.default_tokenizer_files())
    common = "".join(c for c in map(chr, range(0x2100)) if not packing._COMMON.search(c))
    r = random.Random(5)
    for _ in range(3000):
        text = "".join(r.choices(common, k=r.randint(1, 30)))
        assert encode.fast.encode_ordinary(text) == encode.slow.encode(text, add_special_tokens=False).ids


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    _check(packing.pack(docs).collect(), texts, 1024)


def test_empty_table_and_null_id(spark, make_docs):
    assert packing.pack(make_docs([])).count() == 0
    df = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert [(r.doc_id, r.doc_tokens) for r in packing.pack(df).collect()] == [(None, 3)] * 2
