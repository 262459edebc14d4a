"""Words and shingles."""

from __future__ import annotations

import random
import re

from shoplens.llm.common import shingles, sorted_groups, word_hashes


def test_word_hashes_tell_words_apart():
    r = random.Random(1)
    seen = {}
    for _ in range(3000):
        text = "".join(r.choices("ab é日\t\n\r\x0b\x0c\x00 \xa0.", k=r.randint(0, 40)))
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        got = word_hashes(text).tolist()
        assert len(got) == len(words)
        for w, h in zip(words, got):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen) > 1000


def test_shingles():
    assert len(shingles(None)) == len(shingles("")) == len(shingles(" \n")) == 0
    assert len(shingles("a")) == len(shingles("a b c d")) == len(shingles("a b c d e")) == 1
    assert len(shingles("a b c d e f g")) == 3
    a, b = shingles("a b c d e f"), shingles("x  b\tc d e f")
    assert a[0] != b[0] and a[1] == b[1]
    words = [f"w{i}" for i in range(100_000)]
    assert len(set(shingles(" ".join(words)).tolist())) == 99_996
    assert shingles("a b")[0] != shingles("b a")[0]


def test_groups_span_batches():
    import pyarrow as pa

    keys = [1, 1, 2, 3, 3, 3, 3, 4]
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 2], pa.int64()), pa.array(list(range(i, i + 2)))], ["k", "v"]) for i in range(0, 8, 2)]
    assert [(k.to_pylist(), v.to_pylist()) for k, v in sorted_groups(iter(batches))] == [([1, 1], [0, 1]), ([2], [2]), ([3] * 4, [3, 4, 5, 6]), ([4], [7])]
