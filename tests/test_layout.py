"""Stored layouts: the caller states which tables are bucketed, and the
analyses give the same results on every layout."""

from __future__ import annotations

import datetime as dt

import pytest

from support import order_row, pv_row, session_row

from shoplens.operators import OPERATORS
from shoplens.sources import bucket_skew, write_bucketed_tables

HOT = 1
BUCKETS = 8


@pytest.fixture(scope="module")
def hot_tables(make_tables):
    start = dt.datetime(2012, 4, 2, 9, 0, 0)

    def at(minutes: int) -> str:
        return (start + dt.timedelta(minutes=minutes)).isoformat(sep=" ")

    sessions = [session_row(s, at(s), user=s, device="mobile" if s % 3 == 0 else "desktop") for s in range(1, 41)]
    pageviews, pvid = [], 0
    steps = ["/home", "/products", "/the-original-mr-fuzzy", "/cart", "/shipping", "/billing"]
    # session 1 holds most pageviews; the others have 1-3 views
    for s in range(1, 41):
        n = 300 if s == HOT else 1 + s % 3
        for i in range(n):
            pvid += 1
            pageviews.append(pv_row(pvid, at(s + i), s, steps[i % len(steps)] if s != 2 else "/lander-1"))
    orders = [order_row(o, at(o + 5), o, user=o) for o in (1, 4, 7)]
    return make_tables(website_sessions=sessions, website_pageviews=pageviews, orders=orders)


def test_bucket_skew_measures_the_hot_bucket(hot_tables):
    skew, top = bucket_skew(hot_tables.P, "website_session_id", BUCKETS)
    assert top >= 300
    assert skew > 4.0
    skew_s, top_s = bucket_skew(hot_tables.S, "website_session_id", BUCKETS)
    assert top_s < 40 and skew_s < skew


def test_layout_is_the_callers_choice(spark, hot_tables, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shoplens_hot LOCATION '{tmp_path / 'db'}'")
    try:
        stored = write_bucketed_tables(
            spark, hot_tables, str(tmp_path / "t"), buckets=BUCKETS, database="shoplens_hot", layout={"website_pageviews": "plain"}
        )

        def bucketed(name: str) -> bool:
            info = spark.sql(f"DESCRIBE TABLE EXTENDED shoplens_hot.{name}").collect()
            return any(r["col_name"] == "Num Buckets" for r in info)

        assert not bucketed("website_pageviews")
        assert bucketed("website_sessions") and bucketed("order_items")

        for name, kw in [
            ("home_bounce_rate", {}),
            ("top_entry_pages", {}),
            ("session_click_funnel", {"after": "2012-01-01", "before": "2013-01-01"}),
            ("traffic_conversion_rates", {}),
            ("device_conversion", {}),
        ]:
            got = OPERATORS[name](stored, **kw).collect()
            want = OPERATORS[name](hot_tables, **kw).collect()
            assert want and any(v not in (None, 0) for r in want for v in r), name
            assert sorted(map(tuple, got)) == sorted(map(tuple, want)), name
    finally:
        spark.sql("DROP DATABASE IF EXISTS shoplens_hot CASCADE")


def test_bucket_skew_uses_the_writers_bucket_ids(spark, hot_tables, tmp_path):
    """The bucket id ``bucket_skew`` counts by is the one in the written file names."""
    from pyspark.sql import functions as F

    spark.sql(f"CREATE DATABASE IF NOT EXISTS shoplens_ids LOCATION '{tmp_path / 'db'}'")
    try:
        stored = write_bucketed_tables(spark, hot_tables, str(tmp_path / "t"), buckets=BUCKETS, database="shoplens_ids")
        files = stored.S.select(
            "website_session_id",
            F.regexp_extract(F.input_file_name(), r"_(\d{5})(\.c\d+)?\.[^/]*$", 1).cast("int").alias("file_bucket"),
            F.pmod(F.hash("website_session_id"), F.lit(BUCKETS)).alias("bucket"),
        ).collect()
        assert len(files) == 40
        assert all(r["file_bucket"] == r["bucket"] for r in files)
    finally:
        spark.sql("DROP DATABASE IF EXISTS shoplens_ids CASCADE")


def test_bucket_skew_of_an_empty_table(make_tables):
    empty = make_tables()
    assert bucket_skew(empty.P, "website_session_id", BUCKETS) == (0.0, 0)


def test_unknown_layouts_are_refused(spark, hot_tables, tmp_path):
    for layout in ({"website_pageviews": "sorted"}, {"pageviews": "plain"}):
        with pytest.raises(ValueError):
            write_bucketed_tables(spark, hot_tables, str(tmp_path / "u"), buckets=BUCKETS, layout=layout)


def test_a_hot_session_alone_never_changes_the_layout(spark, hot_tables, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shoplens_all LOCATION '{tmp_path / 'db'}'")
    try:
        write_bucketed_tables(spark, hot_tables, str(tmp_path / "t"), buckets=BUCKETS, database="shoplens_all")
        info = spark.sql("DESCRIBE TABLE EXTENDED shoplens_all.website_pageviews").collect()
        assert any(r["col_name"] == "Num Buckets" for r in info)
    finally:
        spark.sql("DROP DATABASE IF EXISTS shoplens_all CASCADE")
