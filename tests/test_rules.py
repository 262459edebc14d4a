"""Hand-made rows, one case per semantic rule (FIXTURES section 3)."""

from __future__ import annotations

from support import order_row, pv_row, session_row, ts

from shoplens import operators as ops


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_zero_denominator_gives_null(make_tables):
    # a week with bsearch mobile sessions but no gsearch mobile sessions
    t = make_tables(
        website_sessions=[
            session_row(1, "2012-11-06 10:00:00", source="bsearch", device="mobile"),
            session_row(2, "2012-11-06 11:00:00", source="gsearch", device="desktop"),
        ]
    )
    (r,) = rows(ops.channel_device_weekly(t))
    assert r["gm_sessions"] == 0 and r["bm_sessions"] == 1 and r["bm_gm_rate"] is None
    assert r["bd_fd_rate"] == 0.0


def test_week_merging_across_years(make_tables):
    # same %U week number (week 1) in 2012 and 2013 -> one row
    t = make_tables(
        website_sessions=[
            session_row(1, "2012-01-02 10:00:00"),
            session_row(2, "2013-01-07 10:00:00"),
        ]
    )
    out = rows(ops.channel_weekly_sessions(t, after="2011-01-01", before="2014-01-01"))
    assert len(out) == 1 and out[0]["week_date"] == 1 and out[0]["gsearch_sessions"] == 2


def test_time_bounds_are_exact(make_tables):
    t = make_tables(
        website_sessions=[
            session_row(1, "2012-08-22 00:00:00"),  # excluded by '>'
            session_row(2, "2012-08-22 00:00:01"),  # included
            session_row(3, "2012-11-28 23:59:59"),  # included
            session_row(4, "2012-11-29 00:00:00"),  # excluded by '<'
        ]
    )
    (r,) = rows(ops.channel_device_mix(t))
    assert r["total_sessions"] == 2


def test_between_is_inclusive_at_midnight(make_tables):
    t = make_tables(
        website_sessions=[
            session_row(1, "2013-09-15 00:00:00"),
            session_row(2, "2013-11-15 00:00:00"),
            session_row(3, "2013-11-15 00:00:01"),
        ]
    )
    out = {r["hr"]: r for r in rows(ops.hourly_weekday_pattern(t))}
    # 2013-09-15 is a Sunday, 2013-11-15 a Friday; the second after midnight is excluded
    assert out[0]["Sun"] == 1.0 and out[0]["Fri"] == 1.0 and len(out) == 1


def test_date_bound_excludes_whole_day(make_tables):
    s = [session_row(i, "2012-06-01 00:00:00") for i in (1, 2, 3)]
    p = [
        pv_row(10, "2012-06-01 23:00:00", 1, "/home"),  # date > 2012-06-01 is false
        pv_row(11, "2012-06-02 00:00:00", 2, "/home"),
        pv_row(12, "2012-08-30 23:59:59", 3, "/lander-1"),
    ]
    t = make_tables(website_sessions=s, website_pageviews=p)
    out = rows(ops.landing_page_weekly_trend(t))
    assert sum(r["total_sessions"] for r in out) == 2


def test_bounce_counts_undated_pageviews(make_tables):
    # the 2nd pageview lies after the cut-off: the session is not a bounce
    s = [session_row(1, "2012-06-10 10:00:00"), session_row(2, "2012-06-10 11:00:00")]
    p = [
        pv_row(1, "2012-06-10 10:00:00", 1, "/home"),
        pv_row(2, "2012-06-20 10:00:00", 1, "/products"),
        pv_row(3, "2012-06-10 11:00:00", 2, "/home"),
    ]
    t = make_tables(website_sessions=s, website_pageviews=p)
    (r,) = rows(ops.home_bounce_rate(t))
    assert r == {"total_sessions": 2, "bounce_number": 1, "bounce_rate": 0.5}


def test_landing_page_is_min_id_not_min_time(make_tables):
    p = [
        pv_row(5, "2012-06-01 10:05:00", 1, "/lander-1"),  # lower id, later time
        pv_row(6, "2012-06-01 10:00:00", 1, "/home"),
    ]
    t = make_tables(website_pageviews=p)
    out = rows(ops.top_entry_pages(t))
    assert out == [{"landing_page": "/lander-1", "sessions_hitting_this_page": 1}]


def test_order_fan_out(make_tables):
    s = [session_row(1, "2012-09-01 10:00:00")]
    o = [order_row(100, "2012-09-01 10:10:00", 1), order_row(101, "2012-09-01 10:20:00", 1)]
    t = make_tables(website_sessions=s, orders=o)
    (plain,) = rows(ops.cross_channel_conversion(t))
    assert plain["sessions"] == 2 and plain["orders"] == 2
    (dist,) = rows(ops.traffic_conversion_rates(t, before="2013-01-01"))
    assert dist["sessions"] == 1 and dist["orders"] == 2


def test_pathing_fan_out(make_tables):
    p = [
        pv_row(1, "2012-11-01 10:00:00", 1, "/products"),
        pv_row(2, "2012-11-01 10:01:00", 1, "/products"),
        pv_row(3, "2012-11-01 10:02:00", 1, "/the-original-mr-fuzzy"),
    ]
    t = make_tables(website_pageviews=p)
    (r,) = rows(ops.product_pathing(t))
    assert r["time_period"] == "A_Pre_Product2"
    assert r["sessions"] == 1 and r["product_to_nextpg"] == 1 and r["to_mrfuzzy"] == 2
    assert r["pct_to_mrfuzzy"] == 2.0


def test_product_funnel_fan_out(make_tables):
    p = [
        pv_row(1, "2013-02-01 10:00:00", 1, "/the-forever-love-bear"),
        pv_row(2, "2013-02-01 10:01:00", 1, "/the-forever-love-bear"),
        pv_row(3, "2013-02-01 10:02:00", 1, "/cart"),
        pv_row(4, "2013-02-01 10:03:00", 1, "/shipping"),
    ]
    t = make_tables(website_pageviews=p)
    (r,) = rows(ops.product_funnels(t))
    assert r["products"] == "the_flb"
    assert (r["to_main"], r["to_cart"], r["to_shipping"], r["to_billing"]) == (4, 2, 2, 0)
    assert r["billing_click_rate"] is None


def test_period_split_gives_one_row_per_period(make_tables):
    p = [
        pv_row(1, "2013-09-25 00:00:00", 1, "/cart"),  # <= split: pre
        pv_row(2, "2013-09-25 00:00:01", 1, "/shipping"),  # post
    ]
    o = [order_row(10, "2013-09-25 00:10:00", 1, items=2, price="100.00")]
    t = make_tables(website_pageviews=p, orders=o)
    out = {r["time_period"]: r for r in rows(ops.cross_sell(t))}
    assert set(out) == {"pre_change", "post_change"}
    assert out["pre_change"]["cart_sessions"] == 1 and out["post_change"]["shipping_sessions"] == 1
    assert out["pre_change"]["aov"] == 100.0 and out["post_change"]["products_per_order"] == 2.0


def test_portfolio_session_on_both_sides(make_tables):
    p = [
        pv_row(1, "2013-12-11 23:00:00", 1, "/home"),
        pv_row(2, "2013-12-12 01:00:00", 1, "/cart"),
        pv_row(3, "2013-12-20 01:00:00", 2, "/home"),
    ]
    o = [order_row(10, "2013-12-12 02:00:00", 1, price="60.00")]
    t = make_tables(website_pageviews=p, orders=o)
    out = {r["time_period"]: r for r in rows(ops.portfolio_expansion(t))}
    assert out["pre_change"]["conv_rate"] == 1.0
    assert out["post_change"]["conv_rate"] == 0.5 and out["post_change"]["revenue_per_session"] == 30.0


def test_refund_rate_absent_product(make_tables):
    items = [(20, ts("2014-01-05 10:00:00"), 2, 1), (21, ts("2014-01-05 10:00:00"), 2, 1)]
    refunds = [(21, 2), (21, 2)]
    t = make_tables(order_items=items, order_item_refunds=refunds)
    (r,) = rows(ops.product_refund_rates(t))
    # two items of product 1 in one order; item 21 has two refund rows
    assert r["p1_order"] == 1 and r["p1_order_rt"] == 2.0
    assert r["p2_order"] == 0 and r["p2_order_rt"] is None


def test_channel_case(make_tables):
    s = [
        session_row(1, "2014-02-01 10:00:00", source="gsearch", campaign="pilot"),
        session_row(2, "2014-02-01 10:00:00", source="socialbook", campaign="pilot", repeat=1),
        session_row(3, "2014-02-01 10:00:00", source=None, campaign=None, referer=None),
        session_row(4, "2014-02-01 10:00:00", source=None, campaign=None),
    ]
    t = make_tables(website_sessions=s)
    out = {r["channel_group"]: (r["new_sessions"], r["repeated_sessions"]) for r in rows(ops.channel_new_vs_repeat(t))}
    assert out == {"opps_wrong": (1, 0), "paid_social": (0, 1), "direct_type_in": (1, 0), "dorganic_search": (1, 0)}


def test_empty_input_global_results(make_tables):
    t = make_tables()
    (b,) = rows(ops.home_bounce_rate(t))
    assert b == {"total_sessions": 0, "bounce_number": None, "bounce_rate": None}
    (f,) = rows(ops.conversion_funnel_rates(t))
    assert f["total_session"] is None and f["lander_p_rate"] is None
    (g,) = rows(ops.repeat_interval(t))
    assert g == {"max_days": None, "min_days": None, "avg_days": None}
    assert rows(ops.top_pages(t)) == []


def test_billing_threshold_defaults_to_first_new_version_view(make_tables):
    p = [
        pv_row(5, "2012-09-01 10:00:00", 1, "/billing"),  # before /billing-2 existed: excluded
        pv_row(8, "2012-09-10 10:00:00", 2, "/billing-2"),
        pv_row(9, "2012-09-11 10:00:00", 3, "/billing"),
        pv_row(10, "2012-09-11 10:01:00", 3, "/billing-2"),  # a session seeing both counts in both
    ]
    o = [order_row(30, "2012-09-11 10:05:00", 3)]
    t = make_tables(website_pageviews=p, orders=o)
    out = {r["billing_version"]: (r["sessions"], r["orders"]) for r in rows(ops.billing_page_test(t))}
    assert out == {"/billing": (1, 1), "/billing-2": (2, 1)}
    fixed = {r["billing_version"]: r["sessions"] for r in rows(ops.billing_page_test(t, min_pageview_id=0))}
    assert fixed["/billing"] == 2


def test_repeat_interval_weights_every_new_session(make_tables):
    s = [
        session_row(1, "2014-02-01 10:00:00", user=7, repeat=0),
        session_row(2, "2014-02-01 12:00:00", user=7, repeat=0),
        session_row(3, "2014-02-05 10:00:00", user=7, repeat=0),
        session_row(4, "2014-02-11 10:00:00", user=7, repeat=1),
        session_row(5, "2014-03-11 10:00:00", user=7, repeat=1),
    ]
    t = make_tables(website_sessions=s)
    (r,) = rows(ops.repeat_interval(t))
    assert r["max_days"] == 10 and r["min_days"] == 6 and r["avg_days"] == (10 + 10 + 6) / 3


def test_funnel_with_custom_steps(make_tables):
    s = [session_row(1, "2012-08-10 10:00:00")]
    p = [
        pv_row(1, "2012-08-10 10:00:00", 1, "/lander-1"),
        pv_row(2, "2012-08-10 10:01:00", 1, "/products"),
        pv_row(3, "2012-08-10 10:02:00", 1, "/cart"),
    ]
    t = make_tables(website_sessions=s, website_pageviews=p)
    steps = {"l": "/lander-1", "p": "/products", "c": "/cart", "s": "/shipping"}
    (r,) = rows(ops.conversion_funnel_rates(t, steps=steps))
    assert r == {"total_session": 1, "p_rate": 1.0, "c_rate": 1.0, "s_rate": 0.0}


def test_general_conversion_form(make_tables):
    s = [
        session_row(1, "2013-01-05 10:00:00", device="mobile"),
        session_row(2, "2013-01-06 10:00:00", device="mobile"),
        session_row(3, "2013-01-07 10:00:00", device="desktop"),
    ]
    o = [order_row(10, "2013-02-01 10:00:00", 2), order_row(11, "2013-02-02 10:00:00", 2)]
    t = make_tables(website_sessions=s, orders=o)
    out = {r["device_type"]: r for r in rows(ops.conversion(t, by=["device_type"], from_="2013-01-06"))}
    assert out["mobile"]["sessions"] == 1 and out["mobile"]["orders"] == 2 and out["mobile"]["conv_rate"] == 2.0
    assert out["desktop"]["orders"] == 0 and out["desktop"]["conv_rate"] == 0.0


def test_general_first_seen_form(make_tables):
    p = [pv_row(9, "2013-01-01 00:00:00", 1, "/cart"), pv_row(4, "2013-02-01 00:00:00", 2, "/cart")]
    t = make_tables(website_pageviews=p)
    (r,) = rows(ops.first_seen(t, "/cart"))
    assert r["first_created_at"] == ts("2013-01-01 00:00:00") and r["first_pv_id"] == 4
