"""V. Product analyses: sales, launches, pathing, funnels, cross-sell,
portfolio expansion and refund rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions import count_if, in_range, named_urls, ratio, sum_if
from shoplens.model import Tables
from shoplens.plans.distinct import TIMES, distinct_order_rows, key_grain, with_orders
from shoplens.plans.periods import Periods
from shoplens.plans.pivot import found_values
from shoplens.plans.session_facts import (
    SID,
    URL,
    explode_periods,
    left_join_weight,
    order_facts,
)

# Product page paths and funnel pages, and the short names of the products.
MR_FUZZY = "/the-original-mr-fuzzy"
LOVE_BEAR = "/the-forever-love-bear"
PRODUCT_URLS = (MR_FUZZY, LOVE_BEAR)
PATH_NAMES = {"mrfuzzy": MR_FUZZY, "flovebear": LOVE_BEAR}
FUNNEL_NAMES = {"the_omf": MR_FUZZY, "the_flb": LOVE_BEAR}
PRODUCTS = "/products"
CART = "/cart"
SHIPPING = "/shipping"
BILLING_2 = "/billing-2"
THANK_YOU = "/thank-you-for-your-order"
CHANGE = ("pre_change", "post_change")


def _zero(c: str):
    return F.coalesce(F.col(c), F.lit(0))


def product_sales(t: Tables, *, before: str = "2013-01-04") -> DataFrame:
    """Orders, revenue and margin per year and month."""
    o = t.O.filter(in_range(t.O, before=before))
    per_order = key_grain(
        t,
        "orders",
        o,
        {"yr": F.year("created_at"), "mo": F.month("created_at")},
        revenue=("sum", F.col("price_usd")),
        margin=("sum", F.col("price_usd") - F.col("cogs_usd")),
    )
    return per_order.groupBy("yr", "mo").agg(
        F.count("order_id").alias("num_of_sales"),
        F.sum("revenue").cast("decimal(18,2)").alias("total_revenue"),
        F.sum("margin").cast("decimal(18,2)").alias("total_margin"),
    )


def product_launch(
    t: Tables, *, after: str = "2012-04-01", before: str = "2013-04-05", product_ids: Sequence[int] | None = (1, 2)
) -> DataFrame:
    """Monthly sessions, orders, conversion, revenue per session and orders
    per primary product.  Sessions and orders are distinct; revenue and orders
    per product count joined rows.  ``product_ids=None`` makes a column for every
    product found among the orders."""
    if product_ids is None:
        product_ids = found_values(t.O, "primary_product_id")
    per_product = [count_if(F.col("primary_product_id") == k, "order_id").alias(f"p{k}") for k in product_ids]
    s = t.S.filter(in_range(t.S, after=after, before=before))
    months = key_grain(t, "website_sessions", s, {"yr": F.year("created_at"), "mo": F.month("created_at")})
    return with_orders(t, months, ["yr", "mo"], *per_product).groupBy("yr", "mo").agg(
        F.count(SID).alias("sessions"),
        F.sum(_zero("n_orders")).alias("orders"),
        ratio(F.sum(_zero("n_orders")), F.count(SID)).alias("con_rate"),
        ratio(F.sum(F.col(TIMES) * F.col("revenue")), F.count(SID)).alias("revenue_per_session"),
        *[F.sum(_zero(TIMES) * _zero(f"p{k}")).alias(f"product{k}_orders") for k in product_ids],
    )


def _joined_count(cond: Column) -> Column:
    """Views that a join on the session id can reach: those with a session."""
    return F.count(F.when(cond & F.col(SID).isNotNull(), 1))


def _windowed_and_undated(
    t: Tables, window: Column, relevant: Column, windowed: Sequence[Column], undated: Mapping[str, str | Sequence[str]]
) -> DataFrame:
    """Per session: the ``windowed`` aggregates, and the views of all time of
    each URL (or URL set) in ``undated``.

    From raw pageviews that is one grouped aggregate over the ``relevant``
    views of all time.  With stored states only the views in the ``window`` are
    read, and the undated counts come from the states."""
    if t.states:
        seen = t.P.filter(window).groupBy(SID).agg(*windowed)
        counts = t.states.url_counts(undated)
        return seen.join(counts, SID, "left").select(*seen.columns, *[_zero(name).alias(name) for name in undated])
    urls = {name: [u] if isinstance(u, str) else list(u) for name, u in undated.items()}
    counts = [_joined_count(F.col(URL).isin(*us)).alias(name) for name, us in urls.items()]
    return t.P.filter(relevant).groupBy(SID).agg(*windowed, *counts)


def product_pathing(
    t: Tables,
    *,
    after: str = "2012-10-06",
    before: str = "2013-04-06",
    split: str | Sequence[str] = "2013-01-06",
    from_url: str = PRODUCTS,
    to_urls: Mapping[str, str] | Sequence[str] = PRODUCT_URLS,
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """Click-through from ``from_url`` to any number of product pages before
    and after ``split`` (or in each of the periods between several splits).  As in a plain self-join, every ``from_url`` view of a
    session is paired with every product-page view of that session (any time),
    so ``to_<name>`` counts pairs while ``product_to_nextpg`` counts distinct
    product-page views.

    One pass: a single grouped aggregate per session holds the windowed
    ``from_url`` views of all periods and the undated product views (which
    stored states give, if there are any)."""
    url, periods = F.col(URL), Periods.of(split, labels, ("A_Pre_Product2", "B_Post_Product2"))
    targets = named_urls(to_urls, PATH_NAMES)
    start = in_range("created_at", after=after, before=before) & (url == from_url)
    per_session = _windowed_and_undated(
        t,
        in_range(t.P, after=after, before=before) & (url == from_url),
        url.isin(from_url, *targets.values()),
        periods.counts("created_at", k=start),
        {f"m_{name}": u for name, u in targets.items()},
    )
    e = explode_periods(per_session, periods.columns("k"), ["k"])
    views = {name: F.col(f"m_{name}") for name in targets}
    nextpg = F.sum(sum(views.values(), F.lit(0)))
    cols = []
    for name, m in views.items():
        pairs = F.sum(F.col("k") * m)
        cols += [pairs.alias(f"to_{name}"), ratio(pairs, nextpg).alias(f"pct_to_{name}")]
    return e.groupBy("time_period").agg(
        F.count(SID).alias("sessions"),
        nextpg.alias("product_to_nextpg"),
        ratio(nextpg, F.count(SID)).alias("pct_to_nextpg"),
        *cols,
    )


def product_funnel_pages(
    t: Tables, *, after: str = "2013-01-06", before: str = "2014-04-10", product_urls: Sequence[str] = PRODUCT_URLS
) -> DataFrame:
    """Distinct URLs seen in sessions that viewed a product page in the window.
    As in a left join, product views without a session id add a NULL URL.

    The window comes first: its filter reaches the scan, and its sessions reduce
    the (session, URL) pairs of all time, each of them one row however often it
    was viewed, before these become URLs."""
    viewed = t.P.filter(in_range(t.P, after=after, before=before) & F.col(URL).isin(*product_urls)).select(SID)
    sessions = viewed.filter(F.col(SID).isNotNull()).distinct()
    seen = t.of_sessions(t.P.filter(F.col(SID).isNotNull()), sessions).select(SID, URL).distinct()
    pages = seen.join(sessions, SID, "left_semi").select(URL)
    unnamed = viewed.filter(F.col(SID).isNull()).select(F.lit(None).cast("string").alias(URL))
    return pages.unionByName(unnamed).distinct()


def product_funnels(
    t: Tables,
    *,
    after: str = "2013-01-06",
    before: str = "2014-04-10",
    product_urls: Mapping[str, str] | Sequence[str] = PRODUCT_URLS,
    billing_url: str = BILLING_2,
) -> DataFrame:
    """Funnel from each of any number of product pages to the thank-you page.
    Each product view of a session repeats all of the session's step counts
    (one joined row per view), so the sums are weighted by the number of views
    ``k``.

    One pass: a single grouped aggregate per session holds the windowed views
    per product and the undated step counts (which stored states give, if there
    are any)."""
    products = named_urls(product_urls, FUNNEL_NAMES)
    url = F.col(URL)
    window = in_range("created_at", after=after, before=before)
    steps = {"p_cart": CART, "p_shipping": SHIPPING, "p_billing": billing_url, "p_ty": THANK_YOU}
    per_session = _windowed_and_undated(
        t,
        in_range(t.P, after=after, before=before) & url.isin(*products.values()),
        url.isin(*products.values(), *steps.values()),
        [F.count(F.when(window & (url == u), 1)).alias(f"k_{i}") for i, u in enumerate(products.values())],
        {"p_main": list(products.values()), **steps},
    )
    periods = {name: [f"k_{i}"] for i, name in enumerate(products)}
    e = explode_periods(per_session, periods, ["k"], label="products")
    main, cart, ship, bill, ty = (
        F.sum(F.col("k") * F.col(c)) for c in ("p_main", "p_cart", "p_shipping", "p_billing", "p_ty")
    )
    return e.groupBy("products").agg(
        main.alias("to_main"),
        ratio(cart, main).alias("main_click_rate"),
        cart.alias("to_cart"),
        ratio(ship, cart).alias("cart_click_rate"),
        ship.alias("to_shipping"),
        ratio(bill, ship).alias("shipping_click_rate"),
        bill.alias("to_billing"),
        ratio(ty, bill).alias("billing_click_rate"),
        ty.alias("to_ty"),
    )


def cross_sell(
    t: Tables,
    *,
    after: str = "2013-08-25",
    before: str = "2013-10-25",
    split: str | Sequence[str] = "2013-09-25",
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """Cart click-through and order value before/after ``split`` (``<=`` is
    "pre"), or in each of the periods between several splits.  A session's cart/shipping views per period are joined to all of
    its orders, so sessions with several orders weigh several times.  Views
    without a session id are not counted."""
    url, known = F.col(URL), F.col(SID).isNotNull()
    periods = Periods.of(split, labels, CHANGE, until=True)
    fields = {"n": F.lit(True), "cart_click": known & (url == CART), "shipping_click": known & (url == SHIPPING)}
    v = (
        t.P.filter(in_range(t.P, after=after, before=before) & url.isin(SHIPPING, CART))
        .groupBy(SID)
        .agg(*periods.counts("created_at", **fields))
    )
    j = v.join(order_facts(t.of_sessions(t.O, v)), SID, "left")
    e = explode_periods(j, periods.columns(*fields), list(fields))
    wt = left_join_weight()
    carts = F.sum(wt * F.col("cart_click"))
    ships = F.sum(wt * F.col("shipping_click"))
    n_orders = F.sum(_zero("n_orders"))
    return e.groupBy("time_period").agg(
        carts.alias("cart_sessions"),
        ships.alias("shipping_sessions"),
        ratio(ships, carts).alias("cart_ctr"),
        ratio(F.sum("items"), n_orders).alias("products_per_order"),
        ratio(F.sum("revenue"), n_orders).alias("aov"),
        ratio(F.sum("revenue"), carts).alias("rev_per_cart_session"),
    )


def portfolio_expansion(
    t: Tables,
    *,
    after: str = "2013-11-12",
    before: str = "2014-01-12",
    split: str | Sequence[str] = "2013-12-12",
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """Conversion, items per order, revenue per session and order value
    before/after ``split``, over distinct (session, order, items, price, period)
    rows; a session with views on both sides of the split appears in both periods
    (or, with several splits, in each period that it has views in)."""
    periods = Periods.of(split, labels, CHANGE, until=True)
    in_window = t.P.filter(in_range(t.P, after=after, before=before))
    v = in_window.groupBy(SID).agg(*periods.counts("created_at", n=F.lit(True)))
    j = v.join(order_facts(distinct_order_rows(t, t.of_sessions(t.O, v))), SID, "left")
    e = explode_periods(j, periods.columns("n"), ["n"])
    # rows are counted by session id: those without one keep their period but count 0
    rows = F.sum(F.when(F.col(SID).isNull(), 0).otherwise(left_join_weight()))
    n_orders = F.sum(_zero("n_orders"))
    return e.groupBy("time_period").agg(
        ratio(n_orders, rows).alias("conv_rate"),
        ratio(F.sum("items"), n_orders).alias("products_per_order"),
        ratio(F.sum("revenue"), rows).alias("revenue_per_session"),
        ratio(F.sum("revenue"), n_orders).alias("aov"),
    )


def product_refund_rates(
    t: Tables, *, before: str = "2014-10-15", product_ids: Sequence[int] | None = (1, 2, 3, 4)
) -> DataFrame:
    """Monthly orders per product and refunded items per such order;
    ``product_ids=None`` makes columns for every product found in the window.

    The numerator counts refunded item rows, the denominator distinct orders;
    a product without sales in a month gives 0 orders and a NULL rate."""
    items = t.I.filter(in_range(t.I, before=before)).select(
        "order_item_id", "order_id", "product_id", "created_at"
    )
    if product_ids is None:
        product_ids = found_values(items, "product_id")
    refunds = t.R.groupBy("order_item_id").agg(F.count("order_id").alias("n_refunded"))
    j = items.join(refunds, "order_item_id", "left")
    # one row per (month, order, product): the distinct-order grain
    per_order = j.groupBy(
        F.year("created_at").alias("yr"), F.month("created_at").alias("mo"), "order_id", "product_id"
    ).agg(F.sum(_zero("n_refunded")).alias("refunds"))
    cols = []
    for k in product_ids:
        is_k = F.col("product_id") == k
        n = count_if(is_k, "order_id")
        cols += [n.alias(f"p{k}_order"), ratio(sum_if(is_k, "refunds"), n).alias(f"p{k}_order_rt")]
    return per_order.groupBy("yr", "mo").agg(*cols)
