"""Invariants on the driver fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from support import SF_MID

from shoplens import operators as ops
from shoplens.sources import from_driver_dir


def _t(spark):
    return from_driver_dir(spark, SF_MID)


def test_new_plus_repeat_equals_sessions(spark):
    t = _t(spark)
    out = ops.channel_new_vs_repeat(t).agg(F.sum("new_sessions") + F.sum("repeated_sessions")).first()[0]
    n = t.S.filter("created_at >= '2014-01-01' and created_at < '2014-11-05' and user_id is not null").count()
    assert out == n


def test_bounces_never_exceed_sessions(spark):
    for r in ops.landing_page_test(_t(spark)).collect():
        assert 0 <= r.bounce_numbers <= r.total_sessions


def test_left_join_row_conservation(spark):
    # joined-row counts = sessions without orders + all orders of sessions in the window
    t = _t(spark)
    got = ops.new_vs_repeat_performance(t).agg(F.sum("sessions")).first()[0]
    s = t.S.filter("created_at >= '2014-01-01' and created_at < '2014-11-08'")
    j = s.join(t.O.select("website_session_id"), "website_session_id", "left").count()
    assert got == j


def test_results_independent_of_partition_count(spark):
    t = _t(spark)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        res = []
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            res.append(sorted(map(tuple, ops.product_funnels(t).collect())))
            res.append(sorted(map(tuple, ops.conversion_funnel_rates(t).collect())))
        assert res[0] == res[2] and res[1] == res[3]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_user_counts_match_histogram(spark):
    t = _t(spark)
    users = ops.repeat_visitors(t).agg(F.sum("users")).first()[0]
    n = t.S.filter("created_at >= '2014-01-01' and created_at < '2014-11-01'").select("user_id").distinct().count()
    assert users == n


def test_fixture_keys_are_unique(spark):
    for name, dups in _t(spark).key_violations().items():
        assert dups.limit(1).count() == 0, name


def test_fixture_keeps_events_without_user(spark):
    import datetime as dt

    from shoplens.sources import derive_tables

    ev = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 1), None), (2, dt.datetime(2024, 1, 1, 2), None), (3, dt.datetime(2024, 1, 1, 3), 5)],
        "event_id long, ts timestamp_ntz, user_id long",
    )
    part = spark.createDataFrame([(k, 900.0 + k / 10) for k in range(4)], "p_partkey long, p_retailprice double")
    t = derive_tables(ev, part, chunk_size=1)
    assert t.P.count() == 3 and t.S.count() == 2
    assert sorted(r.website_session_id for r in t.P.select("website_session_id").collect()) == [1, 1, 3]


def test_chunked_rank_equals_single_chunk(spark):
    """The in-session rank is computed inside chunks of consecutive events
    (so a huge session never sorts in one task); tiny chunks must give the
    same tables as one chunk per session."""
    import os

    from support import SF_SMALL

    from shoplens.sources import derive_tables

    ev = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet"))
    part = spark.read.parquet(os.path.join(SF_SMALL, "part.parquet"))
    a, b = derive_tables(ev, part, chunk_size=7), derive_tables(ev, part)
    for name in ("website_sessions", "website_pageviews", "orders", "order_items", "order_item_refunds"):
        x, y = getattr(a, name), getattr(b, name)
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name
