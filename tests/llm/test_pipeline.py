"""The pipeline against brute force on a small table with planted rows."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from test_containment import _brute as contained
from test_jaccard import _brute as classes
from test_packing import _check as check_pieces

from shoplens.llm import langid, secrets

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest tables with near copies, leaks, secrets and texts without letters added."""
    sf, to = "/root/testdata/sf0.001", str(tmp_path_factory.mktemp("tables"))
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    r, more = random.Random(8), []
    long = [x for x in rows if len(x[1].split()) > 100]
    for x in r.sample(long, 12):
        words = x[1].split(" ")
        words[len(words) // 2] = "changed"
        more.append(" ".join(words))
    more += [long[0][1], long[1][1], None, "", "12 34 !?", "1 " * 500]
    more += [long[k][1][:200] + " " + items[k][1] + " " + long[k + 1][1][:300] for k in range(6)]
    more += ["The password: hunter2hunter2 of the " + x[1][:150] for x in long[20:25]]
    rows += [(10**6 + i, t, "en", "added", None if t is None else len(t)) for i, t in enumerate(more)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{to}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{to}/benchmark.parquet")
    return to, rows, items


def test_stages_and_run_equal_brute_force(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")], name
    rows = [x for x in rows if x[1] and langid._LETTERS.search(x[1])]
    assert rows
    found = classes([x[1] for x in rows])
    # the least document id of each class, not the least position
    least: dict = {}
    for i, x in enumerate(rows):
        least[found[i][0]] = min(least.get(found[i][0], x[0]), x[0])
    rows = [x for x in rows if x[0] in set(least.values())]
    leaks = {d for d, _ in contained([x[1] for x in rows], items)}
    assert leaks
    rows = [x for i, x in enumerate(rows) if i not in leaks]
    want = {x[0]: secrets.redacted(x[1]) for x in rows}
    assert any(want[x[0]] != x[1] for x in rows)
    assert {r.doc_id: r.text for r in docs.collect()} == want
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    number = {d: i for i, d in enumerate(sorted(want))}
    pieces = corpus_pipeline.run(spark, path)
    assert set(pieces.columns) >= {"doc_id", "start", "length", "sequence_id", "offset"}
    numbered = [r for r in pieces.collect()]
    check_pieces([type("Piece", (), r.asDict() | {"doc_id": number[r.doc_id]}) for r in numbered], [want[d] for d in sorted(want)], 1024)


def test_empty_and_repeated_documents(spark, folder, tmp_path):
    path, _, items = folder
    empty = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, path).count() == 0
    rows = [(1, "a plain text of eight small words here", "en", "s", 38)] * 3 + [(None, "a plain text of eight small words here", "en", "s", 38), (None, "another one", "en", None, None)]
    kept = corpus_pipeline.jaccard_join(spark, spark.createDataFrame(rows, COLUMNS), path).collect()
    assert sorted((str(r.doc_id), r.text[:7]) for r in kept) == [("1", "a plain"), ("None", "another")]
