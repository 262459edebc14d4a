"""The SQL surface: views over the tables and the week() function."""

from __future__ import annotations

from support import SF_SMALL

from shoplens import operators as ops
from shoplens.functions import sunday_week
from shoplens.sources import from_driver_dir
from shoplens.sql import register_sql


def test_week_function_matches_column_expression(spark):
    t = from_driver_dir(spark, SF_SMALL)
    register_sql(spark, t)
    got = spark.sql("SELECT website_session_id, week(created_at) AS w FROM website_sessions")
    want = t.S.select("website_session_id", sunday_week("created_at").alias("w"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # a DATE argument is accepted too
    assert spark.sql("SELECT week(DATE'2012-01-08') AS w").first().w == 2


def test_sql_report_equals_dataframe_analysis(spark):
    t = from_driver_dir(spark, SF_SMALL)
    register_sql(spark, t)
    by_sql = spark.sql(
        """
        SELECT min(created_at) AS start_date, count(DISTINCT website_session_id) AS sessions
        FROM website_sessions
        WHERE created_at < '2015-01-01' AND utm_source = 'gsearch' AND utm_campaign = 'nonbrand'
        GROUP BY week(created_at)
        """
    )
    by_df = ops.traffic_source_trend(t, before="2015-01-01")
    assert sorted(by_sql.collect()) == sorted(by_df.collect())


def test_catalog_tables_are_not_shadowed_by_views(spark, tmp_path):
    from shoplens.sources import write_bucketed_tables

    small = from_driver_dir(spark, SF_SMALL)
    register_sql(spark, small)  # temp views with the table names
    before = spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shoplens_shadow LOCATION '{tmp_path / 'db'}'")
    spark.catalog.setCurrentDatabase("shoplens_shadow")
    try:
        bt = write_bucketed_tables(spark, small, str(tmp_path / "t"), buckets=2, database=None)
        plan = bt.P._jdf.queryExecution().executedPlan().toString()
        assert "spark_catalog.shoplens_shadow.website_pageviews" in plan
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE IF EXISTS shoplens_shadow CASCADE")
