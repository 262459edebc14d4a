"""Resharding: optimal flows, placement by the plan, near-equal shards, slots and rewritten files."""

from __future__ import annotations

import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from shoplens.llm import resharding as rs


def _cheapest(supply, capacity):
    """Fewest moved units by trying every way of keeping units in place."""
    best = None
    options = [range(min(s, capacity[i] if i < len(capacity) else 0) + 1) for i, s in enumerate(supply)]
    for stay in itertools.product(*options):
        rest = sum(supply) - sum(stay)
        room = sum(c - (stay[j] if j < len(stay) else 0) for j, c in enumerate(capacity))
        if room >= rest and (best is None or rest < best):
            best = rest
    return best


def test_flow_is_feasible_and_cheapest():
    r = random.Random(4)
    for _ in range(60):
        supply = [r.randint(0, 6) for _ in range(r.randint(1, 4))]
        m = r.randint(1, 5)
        capacity = [r.randint(0, 7) for _ in range(m)]
        capacity[-1] += max(0, sum(supply) - sum(capacity))
        flow = rs.min_cost_flow(supply, capacity)
        assert [sum(n for (i, _), n in flow.items() if i == k) for k in range(len(supply))] == supply
        assert all(sum(n for (_, j), n in flow.items() if j == k) <= c for k, c in enumerate(capacity))
        assert sum(n for (i, j), n in flow.items() if i != j) == _cheapest(supply, capacity)
    with pytest.raises(ValueError):
        rs.min_cost_flow([5], [4])


def _check(rows, texts, shards=24):
    assert len(rows) == len(texts)
    load, slots = [0] * shards, {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert r.size == len(data) + 8 and r.text_crc32 == zlib.crc32(data) and r.law == "bytes" and r.grown_shard is None
        load[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return load


def test_documents_get_near_equal_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    load = _check(rs.reshard_documents(docs).collect(), texts)
    longest = max(len((t or "").encode()) + 8 for t in texts.values())
    assert max(load) - min(load) <= 2 * longest


def test_moves_no_more_than_the_flow(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "repeat('x', cast(id % 50 as int)) as text", "'k' as shard_name")
    old = F.pmod(F.col("doc_id"), F.lit(4))
    plan, placed, path = rs.reshard(docs, old, 4, new_shards=6)
    total, moved = placed.agg(F.sum("_size"), F.sum(F.when(F.col("_old") != F.col("shard"), F.col("_size")))).first()
    assert abs(moved - plan.moved) <= 0.01 * total and abs(plan.moved - total / 3) <= 0.01 * total
    back = spark.read.parquet(path)
    assert back.count() == 4000 and set(back.columns) == {"doc_id", "text", "shard_name", "shard"}


def test_only_affected_shards_are_rewritten(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'abc' as text")
    old = F.pmod(F.col("doc_id"), F.lit(3))
    size = 1000 * 11
    plan, placed, path = rs.reshard(docs, old, 3, new_shards=4, capacity=[size, size, size // 2, size // 2])
    assert plan.affected == {2, 3}
    assert {r.shard for r in spark.read.parquet(path).select("shard").distinct().collect()} == {2, 3}
    assert placed.filter("_old < 2 and _old != shard").count() == 0


def test_nulls_repeats_and_empty(spark, make_docs):
    texts = [None, "", "é", "x" * 30000, *["same"] * 40]
    _check(rs.reshard_documents(make_docs(texts, "size shard position")).collect(), texts)
    nulls = spark.createDataFrame([(None, "a"), (None, None), (None, "a")], "doc_id long, text string")
    rows = rs.reshard_documents(nulls).collect()
    assert len(rows) == 3 and len({(r.shard, r.slot) for r in rows}) == 3
    assert rs.reshard_documents(make_docs([])).count() == 0


def test_equal_rows_spread_over_all_shards(spark):
    """Half of the rows are one and the same: they still make near-equal shards, and no window numbers them all."""
    docs = spark.range(12000).selectExpr("if(id < 6000, 7, id) as doc_id", "if(id < 6000, 'the same text', repeat('x', cast(id % 25 as int))) as text").repartition(6)
    rows = rs.reshard_documents(docs).collect()
    load = [0] * 24
    for r in rows:
        load[r.shard] += r.size
    assert len(rows) == 12000 and min(load) > 0.9 * max(load)
    assert all(sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows))) for k in range(24))
