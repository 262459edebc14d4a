"""Chosen-path join against all pairs, with deep recursion, blocks, copies and defined cases."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from shoplens.llm import jaccard
from shoplens.llm.common import components


def _set(text):
    words = (text or "").encode().split()
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def _brute(texts):
    sets = [_set(t) for t in texts]
    distinct = {}
    for t, s in zip(texts, sets):
        if s:
            distinct.setdefault(t, s)
    linked = {t: {u for u, r in distinct.items() if u != t and 5 * len(s & r) >= 4 * len(s | r)} for t, s in distinct.items()}
    first, label = {}, {}
    for i, t in enumerate(texts):
        if sets[i]:
            first.setdefault(t, i)
    for t in distinct:
        if t in label:
            continue
        todo, seen = [t], {t}
        while todo:
            for u in linked[todo.pop()] - seen:
                seen.add(u)
                todo.append(u)
        for u in seen:
            label[u] = min(first[x] for x in seen)
    copies = Counter(sets)
    return {i: (label[t], len(linked[t]), copies[sets[i]]) if sets[i] else (i, 0, 1) for i, t in enumerate(texts)}


def _corpus(seed, groups=12, size=14):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefghij", k=4))
    common = [word() for _ in range(30)]
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(r.choice([8, 40, 150, 400]))]
        for _ in range(r.randint(1, size)):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 40))):
                copy[r.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [" ".join(common + [word() for _ in range(r.randint(20, 60))]) for _ in range(30)]
    texts += [None, "", " \n ", "one", "one", "two words", "two  words", "a b c d e", *[texts[0]] * 15, texts[0] + "\n", "x " * 400]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("leaf,depth", [(256, 4), (6, 3)])
def test_equals_all_pairs(spark, make_docs, leaf, depth, monkeypatch):
    if leaf < 10:  # many blocks in verification as well
        monkeypatch.setattr(jaccard, "BLOCK_SETS", 3)
    texts = _corpus(leaf)
    docs = make_docs(texts, "set_key part links label")
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in jaccard.similarity_join(docs, recall=0.99999, leaf=leaf, depth=depth).collect()}
    assert got == _brute(texts)


def test_exact_similarity_matrix():
    r = random.Random(1)
    for n in (2, 5, 9, 60):
        sets = [np.unique(np.array(r.choices(range(40), k=r.randint(1, 60)), np.uint64)) for _ in range(n)]
        want = [[i != j and 5 * len(set(a) & set(b)) >= 4 * len(set(a) | set(b)) for j, b in enumerate(s.tolist() for s in sets)] for i, a in enumerate(s.tolist() for s in sets)]
        assert jaccard.similar(sets, 0.8).tolist() == want


def test_runs_reach_the_recall():
    r, meet = random.Random(0), 0
    for _ in range(3000):  # a pair at the threshold, followed down four levels of one run
        alive = 1
        for _ in range(jaccard.DEPTH):
            tries = sum(1 + (r.random() < 0.25) for _ in range(alive))
            alive = sum(r.random() < 0.8 for _ in range(tries))
        meet += alive > 0
    assert 1 - (1 - meet / 3000) ** jaccard.runs_needed() >= 0.998


def test_components(spark):
    r = random.Random(7)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(110)] + [(i, i + 1) for i in range(300, 360)] + [(500, 500)]
    label = {}
    for a, b in edges:
        label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(400):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {x.node: x.label for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in label.items() if any(k in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_null_ids_repeats_and_empty(spark, make_docs):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (8, None), (8, None)], "doc_id long, text string")
    rows = sorted(((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in jaccard.similarity_join(df).collect()), key=str)
    assert rows == sorted([(None, 7, 0, 4)] * 2 + [(7, 7, 0, 4)] * 2 + [(8, 8, 0, 1)] * 2, key=str)
    assert jaccard.similarity_join(make_docs([])).count() == 0
