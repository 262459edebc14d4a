"""Hashed n-gram quality scores against a plain Python version."""

from __future__ import annotations

import math
import random
import re

import xxhash
from pyspark.sql import functions as F

from shoplens.llm import quality as q

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def _hash(*words: str) -> int:
    """Chained 64-bit hash, as a signed number."""
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed & (2**64 - 1))
    return seed - 2**64 if seed >= 2**63 else seed


def _buckets(words, n):
    return [_hash(w) % n for w in words] + [_hash(a, b) % n for a, b in zip(words, words[1:])]


def _base(text):
    text = text or ""
    words = SPLIT.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [s for s in text.split("\n") if SPLIT.search(s)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def _texts():
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(40)] + ["é", "日本", "#x", "a|b"]
    out = [None, "", "  \n\t ", "one", "a b", "x y z", "same line\nsame line\n \nsame line ", "p q r s t " * 9, "a a a a a a a a a a a a"]
    out += [" ".join(r.choices(vocab[: r.choice([6, 44])], k=r.randint(1, 120))) + r.choice(["", "\n", "\r\n x"]) for _ in range(60)]
    return [*out, out[-1], " ".join(r.choices(vocab, k=5000))]


def test_scores_equal_plain_python(spark, make_docs):
    texts, n = _texts(), 97
    docs = make_docs(texts, "score kept _words bucket")
    labels = spark.createDataFrame([(i, 1 if i % 4 == 0 else 0, 1 if i % 8 == 4 else None if i % 3 else 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    target = {i for i in range(len(texts)) if i % 4 == 0 and not i % 8 == 4}
    raw, good = [0] * n, [0] * n
    for i, t in enumerate(texts):
        for b in _buckets(SPLIT.findall(t or ""), n):
            raw[b] += 1
            good[b] += i in target
    ratio = [round((math.log((g + 1) / (sum(good) + n)) - math.log((r + 1) / (sum(raw) + n))) * q.SCALE) for g, r in zip(good, raw)]
    got = {r.doc_id: r for r in q.quality(docs, q.trusted_ids(labels), buckets=n, threshold=-0.01).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        words = SPLIT.findall(t or "")
        r, base = got[i], _base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base, t
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        grams = _buckets(words, n)
        score = sum(ratio[b] for b in grams) / len(grams) / q.SCALE if grams else None
        assert r.base_failed == failed and r.n_ngrams == len(grams)
        assert (r.score is None) == (score is None) and (score is None or abs(r.score - score) < 2e-6)
        assert r.kept == (not failed and score is not None and r.score >= -0.01)


def test_no_targets_and_empty_tables(spark, make_docs):
    docs = make_docs(["a b c d e f g h i j k l", "x"])
    none = spark.createDataFrame([], "doc_id long")
    assert sorted((r.doc_id, r.score, r.kept) for r in q.quality(docs, none).collect()) == [(0, 0.0, True), (1, 0.0, False)]
    assert q.quality(make_docs([]), none).count() == 0


def test_target_bound_is_a_hash_sample(spark):
    labels = spark.range(4000).selectExpr("id as doc_id", "1 as quality", "cast(null as int) as toxic")
    n = q.trusted_ids(labels, max_target=1000).count()
    assert 850 < n < 1150
    assert q.trusted_ids(labels, max_target=4000).count() == 4000


def test_no_python_in_the_plan(spark, make_docs):
    plan = q.quality(make_docs(["a b c"]), spark.createDataFrame([(0,)], "doc_id long"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_long_repetitive_text_takes_linear_time(spark):
    """Every window twice: marked from the sorted windows in one pass, not looked up one by one."""
    import time

    words = [f"w{i}" for i in range(40_000)]
    docs = spark.createDataFrame([(1, " ".join(words + words)), (2, "a b c d e f a b c d e g"), (3, "a a a a a a a")], "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: r.n_repeat_words for r in q.with_base_rules(docs).select("doc_id", "n_repeat_words").collect()}
    assert got == {1: 80_000, 2: 10, 3: 7}
    assert time.time() - began < 30


def test_every_trusted_document_counts(spark, make_docs):
    """No bound on the trusted documents, whatever their ids; repeated and null ids are as before."""
    labels = spark.range(60_000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    assert q.trusted_ids(labels).count() == 60_000
    ids = [-(1 << 63), -65, -64, -1, 0, 1, 63, 64, 70, 5_000_000_000, (1 << 63) - 1]
    docs = spark.createDataFrame([(i, "a b") for i in ids] + [(70, "a b"), (2, "a b"), (-2, "a b"), (None, "a b")], "_id long, t string")
    targets = spark.createDataFrame([(i,) for i in [*ids, 70, None]], "doc_id long")
    got = [(r["_id"], r.trusted) for r in q._with_trust(docs, targets).collect()]
    assert sorted(got, key=str) == sorted([(i, 1) for i in ids] + [(70, 1), (2, 0), (-2, 0), (None, 0)], key=str)


def test_all_trusted_documents_make_the_ratios(spark):
    """60,000 trusted documents: the query counts the words of all of them."""
    labels = spark.range(60_000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    docs = spark.range(70_000).selectExpr("id as doc_id", "if(id < 60000, concat('w', id % 500), 'x') as text")
    ratio = {r.bucket: r.ratio for r in q.log_ratios(docs, q.trusted_ids(labels)).collect()}
    h = docs.selectExpr("pmod(xxhash64(text), 10000) as b", "doc_id < 60000 as t").groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("t").cast("long")).alias("m")).collect()
    for r in h:
        assert ratio[r.b] == round((math.log((r.m + 1) / 70_000) - math.log((r.n + 1) / 80_000)) * q.SCALE)
