"""Whitening by shifted Cholesky QR against dense linear algebra."""

from __future__ import annotations

import math

import numpy as np
import pytest

from shoplens.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows, schema=SCHEMA, parts=5):
    df = spark.createDataFrame(rows, schema)
    return df.repartition(parts) if rows else df


def dense(vectors):
    """Whole numbers, centred exactly, and the eigenvectors of their covariance by the SVD of the centred rows."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    top = n * x - sums
    centred = top / n
    _, s, axes = np.linalg.svd(centred, full_matrices=False)
    return top, centred, axes, s**2 / n


def result(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.component, {})[r.vec_id] = r
    return out


def check(got, vectors, components, tolerance=1e-8):
    top, centred, axes, e = dense(vectors)
    trace = (centred**2).sum() / len(centred)
    assert sorted(got) == list(range(1, components + 1))
    for c, rows in got.items():
        want = centred @ axes[c - 1] / math.sqrt(e[c - 1])
        have = np.array([rows[i].whitened for i in range(len(want))])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < tolerance, c
        for i, r in rows.items():
            assert r.n == len(want) and r.deviation == sum(int(v) ** 2 for v in top[i])
            assert r.explained == pytest.approx(e[c - 1] / trace, rel=1e-6) and r.identity_error < 1e-9
    return got


def test_equals_dense_whitening(spark):
    rng = np.random.default_rng(3)
    v = (rng.normal(size=(700, 12)) * np.geomspace(9, 0.3, 12)).astype(np.float32)
    got = result(whitening.whitened_components(table(spark, [(i, x.tolist(), 0) for i, x in enumerate(v)])))
    check(got, v, 12)


def test_no_more_than_the_asked_components_and_one_number_for_the_identity(spark):
    v = np.random.default_rng(4).normal(size=(300, 40)).astype(np.float32)
    got = result(whitening.whitened_components(table(spark, [(i, x.tolist(), 0) for i, x in enumerate(v)])))
    check(got, v, 32)
    assert len({r.identity_error for rows in got.values() for r in rows.values()}) == 1


def test_sharp_where_a_gram_matrix_is_not(spark):
    """Eigenvalues 1e20 apart: the small one is lost in double precision by a covariance matrix, not by the passes."""
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=400) * 1e10, np.round(rng.normal(size=400) * 64)
    v = np.stack([a, a + b / 64], axis=1)
    df = table(spark, [(i, x.tolist(), 0) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    got = result(whitening.whitened_components(df))
    top, centred, axes, e = dense(v)
    assert len(got) == 2 and got[2][0].explained == pytest.approx(e[1] / e.sum(), rel=1e-4)
    assert got[1][0].identity_error < 1e-4


def test_directions_without_variance_have_no_component(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 3))
    v = np.concatenate([x, x[:, :1], np.full((200, 1), 0.5)], axis=1).astype(np.float32)  # a copy and a constant
    got = result(whitening.whitened_components(table(spark, [(i, r.tolist(), 0) for i, r in enumerate(v)])))
    check(got, v, 3)


def test_bad_rows_are_dropped_and_copies_count(spark):
    rng = np.random.default_rng(7)
    good = rng.normal(size=(60, 4)).astype(np.float32).tolist()
    good += [good[0]] * 40  # one very common vector
    bad = [None, [], [1.0, None, 2.0, 3.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0], [3e38] * 4]
    rows = [(i, x, 1) for i, x in enumerate(good)] + [(1000 + i, x, 1) for i, x in enumerate(bad)]
    got = result(whitening.whitened_components(table(spark, rows)))
    check(got, good, 4)


def test_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 2.0], 0), (None, [2.0, 1.0], 0), (5, [4.0, 4.0], 0), (5, [0.0, 1.0], 0)]
    assert whitening.whitened_components(table(spark, rows)).count() == 8


def test_empty_constant_and_clashing_tables(spark):
    empty = whitening.whitened_components(table(spark, []))
    assert empty.count() == 0 and len(empty.columns) == 7
    assert whitening.whitened_components(table(spark, [(1, [1.0, 2.0], 0)] * 3)).count() == 0
    rows = [(i, [float(i), float(i * i)], "a", 1) for i in range(9)]
    df = table(spark, rows, "vec_id long, embedding array<float>, x string, n int").withColumnRenamed("n", "whitened")
    assert whitening.whitened_components(df).count() == 18


def test_deviation_beyond_a_long_is_null_and_sums_stay_exact(spark):
    big = float(1 << 50)
    rows = [(0, [big / 64, 1.0], 0), (1, [-big / 64, 2.0], 0), (2, [0.0, 4.0], 0)]
    got = whitening.whitened_components(table(spark, rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.deviation for r in got if r.vec_id == 0} == {None}
    x = whitening.whole_vectors(table(spark, rows, "vec_id long, embedding array<double>, label int"))
    assert whitening.sums_of(x).sums == [3_000_000, 64 * 7 + 3_000_000]


def test_the_tables_results_do_not_depend_on_the_partitions(spark):
    v = np.random.default_rng(8).normal(size=(500, 6)).astype(np.float32)
    rows = [(i, x.tolist(), 0) for i, x in enumerate(v)]
    a, b = (result(whitening.whitened_components(table(spark, rows, parts=p))) for p in (1, 16))
    for c in a:
        x, y = (np.array([g[c][i].whitened for i in range(500)]) for g in (a, b))
        assert min(np.abs(x - y).max(), np.abs(x + y).max()) < 1e-9
