"""The URL dictionary: landing pages as numbers, stored with the tables and extended by appends."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from support import pv_row
from test_random_tables import random_rows

from shoplens import operators as ops
from shoplens.model import TABLE_SCHEMAS, Tables
from shoplens.plans.urls import check_dictionary, url_dictionary
from shoplens.sources import read_parquet_tables, write_parquet_tables


def test_top_entry_pages_is_equal_and_a_hash_aggregate(spark):
    rows = random_rows(41)
    t = Tables(**{n: spark.createDataFrame(r, TABLE_SCHEMAS[n]).cache() for n, r in rows.items()})
    plain = ops.top_entry_pages(t, before="2014-01-01")
    numbered = ops.top_entry_pages(replace(t, urls=url_dictionary(t.P)), before="2014-01-01")
    assert sorted(map(str, numbered.collect())) == sorted(map(str, plain.collect()))
    assert any(r.landing_page is None for r in plain.collect())
    assert "SortAggregate" in plain._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in numbered._jdf.queryExecution().executedPlan().toString()


def test_stored_with_the_tables_and_extended_by_an_append(spark, make_tables, tmp_path):
    path = str(tmp_path / "t")
    first = make_tables(website_pageviews=[pv_row(1, "2012-03-20 10:00:00", 1, "/home"), pv_row(2, "2012-03-20 10:01:00", 1, "/cart"), pv_row(3, "2012-03-20 10:01:00", 2, None)])
    write_parquet_tables(first, path)
    write_parquet_tables(make_tables(website_pageviews=[pv_row(4, "2012-03-20 10:00:00", 3, "/new"), pv_row(5, "2012-03-20 10:00:00", 4, "/home")]), path, mode="append")
    t = read_parquet_tables(spark, path)
    assert sorted(r.pageview_url for r in t.urls.collect()) == ["/cart", "/home", "/new"]
    got = {r[0]: r[1] for r in ops.top_entry_pages(t).collect()}
    assert got == {"/home": 2, "/new": 1, None: 1}


def test_urls_that_share_a_hash_are_refused(spark):
    with pytest.raises(ValueError, match="2 URLs share the hash 5"):
        check_dictionary(spark.createDataFrame([(5, "/a"), (5, "/b"), (6, "/c")], "url_key long, pageview_url string"))


def test_tables_without_a_dictionary_still_read(spark, make_tables, tmp_path):
    t = make_tables(website_pageviews=[pv_row(1, "2012-03-20 10:00:00", 1, "/home")])
    for name, df in t.as_dict().items():
        df.write.parquet(str(tmp_path / name))
    back = read_parquet_tables(spark, str(tmp_path))
    assert back.urls is None and ops.top_entry_pages(back).collect()[0].landing_page == "/home"
    assert back.P.filter(F.col("pageview_url").isNull()).count() == 0
