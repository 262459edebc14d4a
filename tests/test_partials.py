"""Stored partial states: analyses from states equal those from raw pageviews, and an append touches its own month only."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from support import SF_MID, pv_row
from test_random_tables import random_rows

from shoplens import operators as ops
from shoplens.model import TABLE_SCHEMAS, Tables
from shoplens.plans.partials import SessionStates, append_states, session_states, write_states
from shoplens.sources import from_driver_dir, read_parquet_tables, write_parquet_tables

#: The analyses with undated pageview counts.
UNDATED = [
    "home_bounce_rate", "landing_page_test", "landing_page_weekly_trend", "session_click_funnel", "conversion_funnel_rates",
    "product_pathing", "product_funnels",
]


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture(scope="module")
def random_tables(spark):
    rows = random_rows(21)
    return Tables(**{n: spark.createDataFrame(r, TABLE_SCHEMAS[n]).cache() for n, r in rows.items()})


@pytest.fixture(scope="module")
def stated(spark, random_tables, tmp_path_factory):
    """States of the same pageviews, written by two appends that cut sessions and months apart."""
    path = str(tmp_path_factory.mktemp("states") / "s")
    p = random_tables.P
    write_states(p.filter("website_pageview_id % 3 = 0"), path)
    append_states(p.filter("website_pageview_id % 3 = 1"), path)
    append_states(p.filter("website_pageview_id % 3 = 2"), path)
    return replace(random_tables, states=SessionStates.read(spark, path))


@pytest.mark.parametrize("name", UNDATED)
def test_equal_to_raw_pageviews(random_tables, stated, name):
    got, want = ops.OPERATORS[name](stated).collect(), ops.OPERATORS[name](random_tables).collect()
    assert want and any(v not in (None, 0) for r in want for v in r)
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("name", UNDATED)
def test_equal_on_the_driver_tables(spark, name):
    t = from_driver_dir(spark, SF_MID)
    got, want = ops.OPERATORS[name](replace(t, states=SessionStates.of(t.P))).collect(), ops.OPERATORS[name](t).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("before", ["2012-06-14", "2012-07-01", "2012-06-14 13:30:00"])
def test_bounds_within_and_between_months(random_tables, stated, before):
    assert ops.home_bounce_rate(stated, before=before).collect() == ops.home_bounce_rate(random_tables, before=before).collect()


def test_an_append_touches_the_partitions_of_its_months_only(spark, make_tables, tmp_path):
    path = str(tmp_path / "s")
    views = [pv_row(i, f"2012-0{1 + i % 6}-10 10:00:00", i % 7, "/home" if i % 2 else "/cart") for i in range(60)]
    write_states(make_tables(website_pageviews=views).P, path)
    before = {f: os.stat(f).st_mtime_ns for f in files(path)}
    more = make_tables(website_pageviews=[pv_row(100, "2012-03-11 10:00:00", 3, "/home"), pv_row(101, "2012-03-12 10:00:00", 99, None)]).P
    append_states(more, path)
    after = files(path)
    assert {os.path.basename(os.path.dirname(f)) for f in after - set(before)} == {"created_month=201203"}
    assert all(os.stat(f).st_mtime_ns == t for f, t in before.items())
    states = SessionStates.read(spark, path)
    counts = {r[0]: r[1] for r in states.view_counts().collect()}
    assert counts[99] == 1 and counts[3] == sum(i % 7 == 3 for i in range(60)) + 1


def test_undated_counts_do_not_read_raw_pageviews(spark, random_tables, tmp_path):
    write_parquet_tables(random_tables, str(tmp_path / "t"))
    t = read_parquet_tables(spark, str(tmp_path / "t"))
    write_states(t.P, str(tmp_path / "s"))
    t = replace(t, states=SessionStates.read(spark, str(tmp_path / "s")))
    for name in UNDATED:
        plan = ops.OPERATORS[name](t)._jdf.queryExecution().executedPlan().toString()
        for scan in (x for x in plan.splitlines() if "FileScan" in x and "pageview_url:string" in x):
            assert "PartitionFilters: [isnotnull(created_month" in scan, (name, scan)
    bounce = ops.landing_page_test(t)._jdf.queryExecution().executedPlan().toString()
    (scan,) = [x for x in bounce.splitlines() if "n_views:bigint" in x and "FileScan" in x]
    assert "url_views" not in scan and "landing_page" not in scan.split("ReadSchema")[1]


def test_nulls_hot_sessions_and_empty_tables(spark, make_tables, tmp_path):
    views = [pv_row(i, "2012-03-10 10:00:00", 1, f"/p{i % 4}") for i in range(500)] + [pv_row(900, "2012-03-10 10:00:00", None, "/home"), (901, None, 2, "/home"), (None, None, 2, None)]
    states = session_states(make_tables(website_pageviews=views).P).collect()
    got = {(r.website_session_id, r.created_month): (r.n_views, r.first_pv_id, r.landing_page, r.url_views) for r in states}
    assert got == {(1, 201203): (500, 0, "/p0", {f"/p{k}": 125 for k in range(4)}), (2, None): (1, 901, "/home", {"/home": 1})}
    write_states(make_tables().P, str(tmp_path / "empty"))
    empty = SessionStates.read(spark, str(tmp_path / "empty"))
    assert empty.view_counts().count() == empty.url_counts({"a": "/home"}).count() == 0
    assert empty.states.filter(F.col("created_month") == 1).count() == 0
