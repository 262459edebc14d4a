"""General forms, any number of periods, and columns for found values, against plain joins in DuckDB."""

from __future__ import annotations

import math

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from support import order_row, session_row
from test_random_tables import DUCK_NAMES, random_rows, with_repeats

from shoplens import operators as ops
from shoplens.model import TABLE_SCHEMAS, Tables
from shoplens.plans.partials import SessionStates
from shoplens.plans.periods import Periods
from shoplens.plans.pivot import found_values
from shoplens.plans.reducer import Reducer
from shoplens.plans.steps import tag_of_url

STEPS = {"products": "/products", "cart": "/cart", "pay": ["/billing", "/billing-2"], "done": "/thank-you-for-your-order"}
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module", params=["keys", "repeats", "states", "reducer"])
def data(request, spark):
    rows = random_rows(31, 900)
    if request.param == "repeats":
        rows = with_repeats(rows, 31)
    t = Tables(**{n: spark.createDataFrame(r, TABLE_SCHEMAS[n]).cache() for n, r in rows.items()})
    if request.param != "repeats":
        t = t.declare_unique()
    if request.param == "states":
        t = Tables(**t.as_dict(), unique=t.unique, states=SessionStates.of(t.P))
    if request.param == "reducer":
        t = Tables(**t.as_dict(), unique=t.unique, reducer=Reducer())
    con = duckdb.connect()
    for name, r in rows.items():
        con.register("_rows", pd.DataFrame(r, columns=[f.name for f in TABLE_SCHEMAS[name].fields]))
        casts = [f"CAST({f.name} AS {KINDS.get(f.dataType.simpleString(), f.dataType.simpleString().upper())}) AS {f.name}" for f in TABLE_SCHEMAS[name].fields]
        con.execute(f"CREATE TABLE {DUCK_NAMES.get(name, name)} AS SELECT {', '.join(casts)} FROM _rows")
    return t, con


def same(df, con, sql):
    got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    want = sorted((tuple(r[cols.index(c)] for c in sorted(cols)) for r in res.fetchall()), key=str)
    assert sorted(df.columns) == sorted(cols) and len(got) == len(want) > 0
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            assert x == y or math.isclose(float(x), float(y), rel_tol=1e-12), (a, b)


def rate(a, b):
    return f"CAST({a} AS DOUBLE) / nullif({b}, 0)"


def step(urls):
    urls = [urls] if isinstance(urls, str) else urls
    return f"count(CASE WHEN w.pageview_url IN ({', '.join(map(repr, urls))}) THEN 1 END)"


STEP_SQL = ", ".join(f"{step(u)} AS {n}" for n, u in STEPS.items())
RATE_SQL = ", ".join(f"{rate(step(STEPS[b]), step(STEPS[a]))} AS {b}_rate" for a, b in zip(STEPS, list(STEPS)[1:]))


def test_funnel_by_device_equals_the_plain_join(data):
    t, con = data
    landed = """SELECT website_session_id FROM (
        SELECT website_session_id, arg_min(coalesce(pageview_url, ''), website_pageview_id) AS landing FROM website_pageviews
        WHERE created_at > TIMESTAMP '2012-06-01' AND created_at < TIMESTAMP '2013-06-01' GROUP BY ALL) WHERE landing = '/lander-1'"""
    same(
        ops.GENERAL["funnel"](t, steps=STEPS, by=["device_type"], landing="/lander-1", where=F.col("utm_source") == "gsearch", after="2012-06-01", before="2013-06-01"),
        con,
        f"""SELECT s.device_type, count(DISTINCT s.website_session_id) AS sessions, {STEP_SQL}, {RATE_SQL}
        FROM (SELECT DISTINCT website_session_id, device_type FROM website_sessions WHERE utm_source = 'gsearch') s
        LEFT JOIN website_pageviews w USING (website_session_id)
        WHERE s.website_session_id IN ({landed}) GROUP BY 1""",
    )


def test_funnel_by_viewed_product_equals_the_plain_join(data):
    t, con = data
    pages = {"fuzzy": "/the-original-mr-fuzzy", "bear": "/the-forever-love-bear", "home": "/home"}
    same(
        ops.GENERAL["funnel"](t, steps=STEPS, by={"product": tag_of_url(pages)}, view=F.col("pageview_url").isin(*pages.values()), from_="2012-09-01", before="2014-01-01"),
        con,
        f"""SELECT v.product, count(DISTINCT v.website_session_id) AS sessions, {STEP_SQL}, {RATE_SQL}
        FROM (SELECT website_session_id, CASE pageview_url {' '.join(f"WHEN '{u}' THEN '{n}'" for n, u in pages.items())} END AS product
              FROM website_pageviews WHERE created_at >= TIMESTAMP '2012-09-01' AND created_at < TIMESTAMP '2014-01-01') v
        LEFT JOIN website_pageviews w ON w.website_session_id = v.website_session_id
        WHERE v.product IS NOT NULL GROUP BY 1""",
    )


def test_funnel_tags_need_views(data):
    with pytest.raises(ValueError, match="tags of views"):
        ops.GENERAL["funnel"](data[0], steps=STEPS, by={"x": F.lit(1)})


def test_bounce_by_source_equals_the_plain_join(data):
    t, con = data
    same(
        ops.GENERAL["bounce"](t, by=["utm_source"], where=F.col("device_type") == "mobile", after="2012-06-01", before="2013-06-01"),
        con,
        f"""WITH f AS (SELECT website_session_id, nullif(arg_min(coalesce(pageview_url, ''), website_pageview_id), '') AS landing_page
              FROM website_pageviews WHERE created_at > TIMESTAMP '2012-06-01' AND created_at < TIMESTAMP '2013-06-01' GROUP BY 1),
        n AS (SELECT website_session_id, count(*) AS n FROM website_pageviews GROUP BY 1)
        SELECT landing_page, utm_source, count(*) AS total_sessions, count(*) FILTER (n = 1) AS bounces, {rate("count(*) FILTER (n = 1)", "count(*)")} AS bounce_rate
        FROM f JOIN n USING (website_session_id)
        JOIN (SELECT DISTINCT website_session_id, utm_source FROM website_sessions WHERE device_type = 'mobile') USING (website_session_id)
        GROUP BY 1, 2""",
    )


def test_variant_test_equals_the_plain_join(data):
    t, con = data
    same(
        ops.GENERAL["variant_test"](t, urls=["/home", "/lander-1", "/lander-2"], since=500, before="2013-12-01"),
        con,
        f"""SELECT pageview_url AS version, count(DISTINCT p.website_session_id) AS sessions, count(DISTINCT order_id) AS orders,
              {rate("count(DISTINCT order_id)", "count(DISTINCT p.website_session_id)")} AS order_rate
        FROM website_pageviews p LEFT JOIN m_orders o ON o.website_session_id = p.website_session_id
        WHERE pageview_url IN ('/home', '/lander-1', '/lander-2') AND website_pageview_id >= 500 AND p.created_at < TIMESTAMP '2013-12-01'
          AND p.website_session_id IS NOT NULL GROUP BY 1""",
    )


SPLITS, LABELS = ["2012-10-01", "2013-03-01", "2013-08-01"], ["a", "b", "c", "d"]


def period_sql(op, ts="created_at"):
    tests = " ".join(f"WHEN {ts} {op} TIMESTAMP '{s}' THEN '{x}'" for s, x in zip(SPLITS, LABELS))
    return f"CASE {tests} ELSE 'd' END"


def test_period_compare_of_four_periods(data):
    t, con = data
    same(
        ops.GENERAL["period_compare"](t, splits=SPLITS, labels=LABELS, views={"carts": F.col("pageview_url") == "/cart"}, after="2012-06-01", before="2014-01-01"),
        con,
        f"""WITH v AS (SELECT website_session_id AS sid, {period_sql("<")} AS time_period, count(*) FILTER (pageview_url = '/cart') AS carts
              FROM website_pageviews WHERE created_at > TIMESTAMP '2012-06-01' AND created_at < TIMESTAMP '2014-01-01' AND website_session_id IS NOT NULL GROUP BY ALL),
        o AS (SELECT website_session_id AS sid, count(*) AS n, sum(items_purchased) AS items, sum(price_usd) AS revenue FROM m_orders GROUP BY 1)
        SELECT time_period, count(*) AS sessions, CAST(sum(greatest(coalesce(n, 0), 1)) AS BIGINT) AS joined_rows, CAST(sum(carts) AS BIGINT) AS carts,
          CAST(coalesce(sum(n), 0) AS BIGINT) AS orders, {rate("coalesce(sum(n), 0)", "count(*)")} AS orders_per_session, {rate("sum(items)", "sum(n)")} AS items_per_order,
          {rate("sum(revenue)", "count(*)")} AS revenue_per_session, {rate("sum(revenue)", "sum(n)")} AS aov
        FROM v LEFT JOIN o USING (sid) GROUP BY 1""",
    )


def test_pathing_over_four_periods_equals_the_plain_join(data):
    t, con = data
    n = "count(DISTINCT w.website_pageview_id)"
    fuzzy, bear = (f"count(w.website_pageview_id) FILTER (w.pageview_url = '{u}')" for u in ("/the-original-mr-fuzzy", "/the-forever-love-bear"))
    same(
        ops.product_pathing(t, after="2012-06-01", before="2014-01-01", split=SPLITS, labels=LABELS),
        con,
        f"""SELECT {period_sql("<", "p.created_at")} AS time_period, count(DISTINCT p.website_session_id) AS sessions, {n} AS product_to_nextpg,
          {rate(n, "count(DISTINCT p.website_session_id)")} AS pct_to_nextpg, {fuzzy} AS to_mrfuzzy, {rate(fuzzy, n)} AS pct_to_mrfuzzy,
          {bear} AS to_flovebear, {rate(bear, n)} AS pct_to_flovebear
        FROM website_pageviews p LEFT JOIN website_pageviews w ON w.website_session_id = p.website_session_id
          AND w.pageview_url IN ('/the-original-mr-fuzzy', '/the-forever-love-bear')
        WHERE p.pageview_url = '/products' AND p.created_at > TIMESTAMP '2012-06-01' AND p.created_at < TIMESTAMP '2014-01-01' GROUP BY 1""",
    )


def test_cross_sell_and_portfolio_over_four_periods(data):
    t, con = data
    window = "created_at > TIMESTAMP '2012-06-01' AND created_at < TIMESTAMP '2014-01-01'"
    same(
        ops.cross_sell(t, after="2012-06-01", before="2014-01-01", split=SPLITS, labels=LABELS),
        con,
        f"""WITH c AS (SELECT website_session_id AS sid, {period_sql("<=")} AS time_period,
              count(website_session_id) FILTER (pageview_url = '/cart') AS cart, count(website_session_id) FILTER (pageview_url = '/shipping') AS ship
              FROM website_pageviews WHERE {window} AND pageview_url IN ('/shipping', '/cart') GROUP BY ALL)
        SELECT time_period, CAST(sum(cart) AS BIGINT) AS cart_sessions, CAST(sum(ship) AS BIGINT) AS shipping_sessions, {rate("sum(ship)", "sum(cart)")} AS cart_ctr,
          {rate("sum(items_purchased)", "count(order_id)")} AS products_per_order, {rate("sum(price_usd)", "count(order_id)")} AS aov,
          {rate("sum(price_usd)", "sum(cart)")} AS rev_per_cart_session
        FROM c LEFT JOIN m_orders ON website_session_id = sid GROUP BY 1""",
    )
    same(
        ops.portfolio_expansion(t, after="2012-06-01", before="2014-01-01", split=SPLITS, labels=LABELS),
        con,
        f"""SELECT time_period, {rate("count(order_id)", "count(sid)")} AS conv_rate, {rate("sum(items_purchased)", "count(order_id)")} AS products_per_order,
          {rate("sum(price_usd)", "count(sid)")} AS revenue_per_session, {rate("sum(price_usd)", "count(order_id)")} AS aov
        FROM (SELECT DISTINCT p.website_session_id AS sid, order_id, items_purchased, price_usd, {period_sql("<=", "p.created_at")} AS time_period
              FROM website_pageviews p LEFT JOIN m_orders o ON p.website_session_id = o.website_session_id WHERE {window.replace("created_at", "p.created_at")})
        GROUP BY 1""",
    )


def test_period_lookup_is_a_binary_search(spark):
    ts = ["2012-09-30 23:59:59", "2012-10-01 00:00:00", "2013-02-01 00:00:00", "2013-03-01 00:00:00", "2013-08-01 00:00:00", "2020-01-01 00:00:00", None]
    df = spark.createDataFrame([(x,) for x in ts], "x string").selectExpr("cast(x as timestamp_ntz) as x")
    index = lambda **kw: [r[0] for r in df.select(Periods(tuple(SPLITS), tuple(LABELS), **kw).index("x")).collect()]
    assert index() == [0, 1, 1, 2, 3, 3, None] and index(until=True) == [0, 0, 1, 1, 2, 3, None]
    for bad in (["2013-01-01", "2012-01-01"], ["2013-01-01", "2013-01-01"]):
        with pytest.raises(ValueError, match="must rise"):
            Periods.of(bad, None, ("a", "b"))
    with pytest.raises(ValueError, match="different labels"):
        Periods.of("2013-01-01", ["a"], ("a", "b"))


def test_a_fifth_product_gets_its_columns(make_tables):
    orders = [order_row(k, "2012-05-01 10:00:00", k, product=k) for k in range(1, 6)]
    items = [(k, orders[0][1], k, k) for k in range(1, 6)]
    t = make_tables(website_sessions=[session_row(k, "2012-05-01 09:00:00") for k in range(1, 6)], orders=orders, order_items=items, order_item_refunds=[(5, 5)])
    (r,) = ops.product_refund_rates(t, product_ids=None).collect()
    assert (r.p5_order, r.p5_order_rt, r.p1_order_rt) == (1, 1.0, 0.0) and "p6_order" not in r
    (r,) = ops.product_launch(t, product_ids=None).collect()
    assert r.product5_orders == 1
    assert "p5_order" not in ops.product_refund_rates(t).columns
    with pytest.raises(ValueError, match="more than 4 values"):
        found_values(t.O, "primary_product_id", limit=4)
