"""The filter audit against a plain walk through all 120 orders."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import pytest

from shoplens.llm import audit

LABELS = "doc_id long, quality int, toxic int"


def plain(rows, labels, part=3, min_words=5):
    """rows: (doc_id, text, lang, source, ...)."""
    fails = []
    for i, row in enumerate(rows):
        text = row[1] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        own = set()
        if len(words) < min_words:
            own.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            own.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
            own.add("C")
        if re.search(r"[#$%&*|]", text):
            own.add("D")
        if row[0] is not None and any(o[0] is not None and o[0] < row[0] and (o[1] or "") == text for o in rows):
            own.add("E")
        fails.append(own)
    good, toxic = ({d for d, *v in labels if v[k] == 1 and d is not None} for k in (0, 1))
    out = {}
    for p in {r[part] or "" for r in rows}:
        mine = [i for i, r in enumerate(rows) if (r[part] or "") == p]
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(mine)
            for step, x in enumerate(order, 1):
                gone = [i for i in left if x in fails[i]]
                failing = [i for i in mine if x in fails[i]]
                left = [i for i in left if i not in gone]
                shapley[x] += len(gone)
                out[p, order, step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(fails[i] == {x} for i in mine),
                    sum(rows[i][0] in good for i in gone), sum(rows[i][0] in toxic for i in gone),
                ]
        for (q, order, step), v in out.items():
            if q == p:
                v.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def result(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


TEXTS = [
    "one two three four five six", "one two three four five six", "a a a a a a", "A B C d e f", "cost $ 5 in all here", "", None, "short",
    "one two three four five six", "x\u0085y z w v u t", "ein # zwei", "LOUD LOUD LOUD LOUD LOUD LOUD # $", "a\x00b c d e f g", "tab\tnew\nline\x0bvt\x0cff\rcr",
] + ["very long " * 20_000]


def make(spark, texts, ids=None, sources=None):
    ids = ids or list(range(len(texts)))
    sources = sources or [f"s{i % 2}" if i % 5 else None for i in range(len(texts))]
    return [(i, t, "en", s, None) for i, t, s in zip(ids, texts, sources)]


@pytest.mark.parametrize("ids", [None, [3, 3, 1, None, 5, 5, 6, None, 0, 9, 10, None, 12, 13, 14]])
def test_equals_the_plain_walk(spark, ids):
    rows = make(spark, TEXTS, ids)
    labels = [(0, 1, 0), (1, 0, 1), (2, None, 1), (3, 1, None), (3, 0, 1), (5, 1, 1), (99, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = audit.filter_audit(docs, spark.createDataFrame(labels, LABELS), min_words=5)
    assert result(got) == plain(rows, labels)


def test_clashing_columns_and_empty_tables(spark, make_docs):
    docs = make_docs(TEXTS[:6], extra="hash bits mask n part good l_id salt first_id f_hash")
    labels = spark.createDataFrame([(0, 1, 0, "x")], LABELS + ", part string")
    plain_docs = make_docs(TEXTS[:6])
    assert result(audit.filter_audit(docs, labels)) == result(audit.filter_audit(plain_docs, labels.drop("part")))
    assert audit.filter_audit(docs.limit(0), labels).count() == 0
    assert audit.filter_audit(docs, labels.limit(0)).count() == 2 * 0 + 3 * 600


def test_counts_add_up(spark):
    rows = make(spark, TEXTS * 3, list(range(3 * len(TEXTS))))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = audit.filter_audit(docs, spark.createDataFrame([], LABELS)).collect()
    per_part = Counter(r[3] or "" for r in rows)
    for r in got:
        if r.step == 1:
            assert r.kept + r.removed == per_part[r.part] and r.redundant == 0
        assert r.good_lost == r.toxic_lost == 0
    assert len(got) == 600 * len(per_part)


def test_the_semi_join_is_native_and_not_quadratic(spark, make_docs):
    docs = make_docs(["same text"] * 3000 + ["other"])
    found = audit.failures(docs)
    assert found.filter("mask & 16 > 0").agg({"n": "sum"}).first()[0] == 2999
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
