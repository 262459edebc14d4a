"""List parameters of any length, coupled parameters, pageviews without a session, and column types."""

from __future__ import annotations

import dataclasses

import pytest
from support import order_row, pv_row, session_row
from pyspark.sql import functions as F

from shoplens import operators as ops

FUZZY, BEAR, BIRD = "/the-original-mr-fuzzy", "/the-forever-love-bear", "/the-birthday-bird"


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_product_pathing_counts_every_url(make_tables):
    at = "2012-12-01 10:00:00"
    t = make_tables(website_pageviews=[pv_row(1, at, 1, "/products"), pv_row(2, at, 1, BIRD), pv_row(3, at, 2, "/products"), pv_row(4, at, 2, FUZZY)])
    (r,) = rows(ops.product_pathing(t, to_urls=[FUZZY, BEAR, BIRD]))
    assert r["product_to_nextpg"] == 2 and r["pct_to_nextpg"] == 1.0
    assert (r["to_mrfuzzy"], r["to_flovebear"], r["to_the_birthday_bird"]) == (1, 0, 1)
    (r,) = rows(ops.product_pathing(t, to_urls={"bird": BIRD}))
    assert r["to_bird"] == 1 and r["pct_to_bird"] == 1.0 and "to_mrfuzzy" not in r


def test_product_funnels_name_every_product(make_tables):
    at = "2013-06-01 10:00:00"
    t = make_tables(website_pageviews=[pv_row(1, at, 1, BIRD), pv_row(2, at, 1, "/cart"), pv_row(3, at, 2, BEAR), pv_row(4, at, 3, FUZZY)])
    got = {r["products"]: (r["to_main"], r["to_cart"]) for r in rows(ops.product_funnels(t, product_urls=[FUZZY, BEAR, BIRD]))}
    assert got == {"the_omf": (1, 0), "the_flb": (1, 0), "the_birthday_bird": (1, 1)}


def test_weekly_trend_has_a_column_for_every_landing_page(make_tables):
    at = "2012-06-05 10:00:00"
    pages = ["/home", "/lander-1", "/lander-2"]
    t = make_tables(website_sessions=[session_row(i, at) for i in (1, 2, 3)], website_pageviews=[pv_row(i, at, i, u) for i, u in enumerate(pages, 1)])
    (r,) = rows(ops.landing_page_weekly_trend(t, landings=pages))
    assert (r["total_sessions"], r["home_num"], r["lander_1_num"], r["lander_2"]) == (3, 1, 1, 1)


def test_urls_need_names_of_their_own(make_tables):
    with pytest.raises(ValueError):
        ops.product_pathing(make_tables(), to_urls=["/a-b", "/a_b"])


def test_portfolio_expansion_counts_sessions_only(make_tables):
    at = "2013-12-01 10:00:00"
    t = make_tables(website_pageviews=[pv_row(1, at, 1, "/home"), pv_row(2, at, None, "/home")], orders=[order_row(1, at, 1)])
    (r,) = rows(ops.portfolio_expansion(t))
    assert r["conv_rate"] == 1.0 and r["revenue_per_session"] == 50.0
    t = make_tables(website_pageviews=[pv_row(2, at, None, "/home")])
    (r,) = rows(ops.portfolio_expansion(t))  # the period stays
    assert r["time_period"] == "pre_change" and r["conv_rate"] is None


def test_cross_sell_counts_views_of_sessions_only(make_tables):
    at = "2013-09-01 10:00:00"
    t = make_tables(website_pageviews=[pv_row(1, at, 1, "/cart"), pv_row(2, at, None, "/cart"), pv_row(3, at, None, "/cart")])
    (r,) = rows(ops.cross_sell(t))
    assert r["cart_sessions"] == 1 and r["cart_ctr"] == 0.0


def test_product_funnel_pages_without_a_session(make_tables):
    at = "2013-06-01 10:00:00"
    t = make_tables(website_pageviews=[pv_row(1, at, None, FUZZY), pv_row(2, at, 1, BEAR), pv_row(3, at, 1, None), pv_row(4, at, None, "/cart")])
    assert {r["pageview_url"] for r in rows(ops.product_funnel_pages(t))} == {None, BEAR}
    t = make_tables(website_pageviews=[pv_row(2, at, 1, BEAR), pv_row(3, at, 2, None)])
    assert {r["pageview_url"] for r in rows(ops.product_funnel_pages(t))} == {BEAR}


def test_the_funnel_starts_at_the_landing_page(make_tables):
    at = "2012-08-10 10:00:00"
    t = make_tables(website_sessions=[session_row(1, at)], website_pageviews=[pv_row(1, at, 1, "/lander-2"), pv_row(2, at, 1, "/products")])
    (r,) = rows(ops.conversion_funnel_rates(t, landing="/lander-2"))
    assert r["total_session"] == 1 and r["lander_p_rate"] == 1.0
    steps = {"a": "/lander-2", "b": "/products"}
    (r,) = rows(ops.session_click_funnel(t, steps=steps))
    assert (r["a"], r["b"]) == (1, 1)
    with pytest.raises(ValueError):
        ops.session_click_funnel(t, landing="/home", steps=steps)


def test_billing_page_test_starts_at_the_last_version(make_tables):
    at = "2012-11-01 10:00:00"
    t = make_tables(website_pageviews=[pv_row(1, at, 1, "/pay"), pv_row(2, at, 2, "/pay-2"), pv_row(3, at, 3, "/pay")])
    got = {r["billing_version"]: r["sessions"] for r in rows(ops.billing_page_test(t, urls=("/pay", "/pay-2")))}
    assert got == {"/pay": 1, "/pay-2": 1}
    with pytest.raises(ValueError):
        ops.billing_page_test(t, urls=("/pay", "/pay-2"), new_url="/billing-2")


@pytest.mark.parametrize(
    "table,column,kind",
    [
        ("website_sessions", "created_at", "string"),
        ("website_pageviews", "website_session_id", "string"),
        ("orders", "price_usd", "double"),
        ("order_items", "product_id", "string"),
        ("order_item_refunds", "order_id", "double"),
    ],
)
def test_wrong_types_are_refused(make_tables, table, column, kind):
    t = make_tables()
    assert t.validate() is t
    bad = dataclasses.replace(t, **{table: getattr(t, table).withColumn(column, F.col(column).cast(kind))})
    with pytest.raises(ValueError, match=column):
        bad.validate()
    wide = dataclasses.replace(t, order_items=t.order_items.withColumn("product_id", F.col("product_id").cast("long")))
    wide.validate()
