"""Column-expression rules: week numbering, ratio, rounding, channel groups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shoplens.functions import channel_group, ratio, round_half_up_avg, sunday_week


def test_sunday_week_known_days(spark):
    days = ["2011-01-01", "2012-01-01", "2012-01-07", "2012-01-08", "2012-12-31", "2008-02-20", "2012-04-15"]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(d),) for d in days], "t timestamp_ntz")
    got = [r[0] for r in df.select(sunday_week("t")).collect()]
    assert got == [0, 1, 1, 2, 53, 7, 16]


def test_sunday_week_matches_percent_u_for_forty_years(spark):
    df = spark.range(0, 366 * 41).select(
        F.date_add(F.to_date(F.lit("1990-01-01")), F.col("id").cast("int")).alias("d")
    )
    rows = df.select("d", sunday_week(F.col("d").cast("timestamp_ntz")).alias("w")).collect()
    bad = [(r.d, r.w) for r in rows if int(r.d.strftime("%U")) != r.w]
    assert not bad, bad[:5]


def test_ratio_is_null_on_zero_or_null(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (3, 4), (0, 5)], "a long, b long")
    got = [r[0] for r in df.select(ratio("a", "b")).collect()]
    assert got == [None, None, 0.75, 0.0]


def test_round_half_up_average(spark):
    # avg 1.15 must round to 1.2 (half-up on the exact value), avg 1.25 -> 1.3
    df = spark.createDataFrame([(1, 1)] * 17 + [(1, 2)] * 3 + [(2, 1), (2, 1), (2, 1), (2, 2)], "g int, v long")
    # group 1: twenty values, sum 23 -> 1.15 ; group 2: 5/4 = 1.25
    got = dict(df.groupBy("g").agg(round_half_up_avg("v", 1).alias("r")).collect())
    assert got == {1: 1.2, 2: 1.3}


def test_channel_group_first_match(spark):
    rows = [
        ("gsearch", "brand", "x"),
        ("bsearch", "nonbrand", "x"),
        ("socialbook", "pilot", "x"),
        (None, None, None),
        (None, None, "https://www.gsearch.com"),
        ("gsearch", "pilot", "x"),
    ]
    df = spark.createDataFrame(rows, "utm_source string, utm_campaign string, http_referer string")
    got = [r[0] for r in df.select(channel_group()).collect()]
    assert got == ["paid_brand", "paid_nonbrand", "paid_social", "direct_type_in", "dorganic_search", "opps_wrong"]
