"""Containment search against exact containment of every (document, item) pair."""

from __future__ import annotations

import random

import pytest

from shoplens.llm import containment as c


def _set(text):
    words = (text or "").encode().split()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def _brute(docs, items):
    return {(d, i): (len(s & q), len(q)) for d, t in enumerate(docs) for s in [_set(t)] for i, x in items for q in [_set(x)] if q and len(s & q) * 5 >= 4 * len(q)}


def _corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefgh", k=4))
    passage = lambda n: [word() for _ in range(n)]
    items = [passage(r.choice([5, 6, 9, 16, 21, 40, 70, 150, 600])) for _ in range(40)]
    docs = []
    for _ in range(150):
        doc = passage(r.choice([0, 3, 50, 800, 6000]))
        for item in r.sample(items, r.choice([0, 0, 1, 2])):
            copy = list(item)
            if r.random() < 0.4:  # edits, not always few enough
                for _ in range(max(1, len(copy) // 40)):
                    copy[r.randrange(len(copy))] = word()
            if r.random() < 0.2:
                copy = copy[: len(copy) // 2]
            at = r.randint(0, len(doc))
            doc[at:at] = copy
        docs.append(r.choice([" ", "\n", " \t"]).join(doc))
    half = items[-1]
    docs += [None, "", " \n", "one two", " ".join(half[:300] + passage(5000) + half[296:]), docs[5], docs[5], " ".join(passage(120_000) + items[3])]
    rows = [(i, " ".join(x)) for i, x in enumerate(items)] + [(100, None), (101, ""), (102, "one two"), (103, " ".join(items[0])), (None, " ".join(items[1]))]
    return docs, rows


@pytest.mark.parametrize("block", [c.BLOCK_BYTES, 3000])
def test_equals_exact_containment(spark, make_docs, monkeypatch, block):
    monkeypatch.setattr(c, "BLOCK_BYTES", block)
    docs, items = _corpus(1)
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as doc_id")
    frame = make_docs(docs, "item_id containment")
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in c.contaminated(frame, bench).collect()}
    want = _brute(docs, items)
    assert len(want) > 40 and got == want
    kept = c.decontaminate(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(range(len(docs))) - {d for d, _ in want})


def test_empty_sides(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert c.contaminated(make_docs(["a b c d e f"]), none).count() == 0
    assert c.decontaminate(make_docs(["a b c d e f", None]), none).count() == 2
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert c.contaminated(make_docs([]), some).count() == 0


def test_whole_small_table(spark):
    sf = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = docs.collect()
    want = {(rows[d].doc_id, i) for d, i in _brute([r.text for r in rows], [(r.item_id, r.text) for r in bench.collect()])}
    assert {(r.doc_id, r.item_id) for r in c.contaminated(docs, bench).collect()} == want
