"""Derive the five clickstream tables from the driver's ``events`` and
``part`` tables.

This is test preparation: the analyses themselves only see the five tables.
The mapping is fixed (see FIXTURES.md); all of it is integer arithmetic so
that any engine reproduces it row for row.

Scale notes
-----------
* A session is ``(user_id, b)``.  One session may hold a large share of all
  events, so the in-session rank ``pos`` is not one window over the session:
  events are cut into chunks of consecutive ``event_id``; a tiny per-chunk
  count table gives each chunk its offset, and ``row_number`` only runs inside
  a ``(session, chunk)`` group of at most ``chunk_size`` rows.
* Session attributes are computed on the per-chunk table (one row per chunk),
  so no join ever sends a whole session to one task.
* The price lookup is reduced to at most four rows (one per product key)
  before it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.model import Tables

# Fixed values of the fixture mapping.
EPOCH_EVENTS = "2024-01-01"          # day 0 of the driver's event stream
EPOCH_SITE = "2012-03-19 00:00:00"   # day 0 of the derived web site
BUCKET_SECONDS = 5529600             # 64 days of site time per 2-day event bucket
SPREAD_MULT = 3417481                # spreads session starts inside a bucket
PAGEVIEW_GAP_SECONDS = 90
GSEARCH_URL = "https://www.gsearch.com"
BSEARCH_URL = "https://www.bsearch.com"
SOCIALBOOK_URL = "https://www.socialbook.com"
LOVE_BEAR = "/the-forever-love-bear"
MR_FUZZY = "/the-original-mr-fuzzy"
THANK_YOU = "/thank-you-for-your-order"

DEFAULT_CHUNK = 1 << 20


def idiv(c: Column, n: int) -> Column:
    """Exact floor division of an integral column by a positive constant."""
    return ((c - F.pmod(c, F.lit(n))) / F.lit(n)).cast("long")


def _session_chunks(events: DataFrame, chunk_size: int) -> tuple[DataFrame, DataFrame]:
    ev = events.select(
        "event_id",
        "user_id",
        idiv(F.datediff(F.to_date("ts"), F.to_date(F.lit(EPOCH_EVENTS))).cast("long"), 2).alias("b"),
    ).withColumn("chunk", idiv(F.col("event_id"), chunk_size))
    per_chunk = ev.groupBy("user_id", "b", "chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("cmin")
    )
    sess = Window.partitionBy("user_id", "b")
    before = sess.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return ev, per_chunk.select(
        "user_id",
        "b",
        "chunk",
        "cmin",
        F.min("cmin").over(sess).alias("sid"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
    )


def _session_start(b: Column, sid: Column) -> Column:
    secs = b * F.lit(BUCKET_SECONDS) + F.pmod(sid * F.lit(SPREAD_MULT), F.lit(BUCKET_SECONDS))
    return F.timestamp_add("SECOND", secs, F.lit(EPOCH_SITE).cast("timestamp_ntz"))


def _landing_url(h2: Column) -> Column:
    m = F.pmod(h2, F.lit(4))
    return F.when(m <= 1, "/lander-1").when(m == 2, "/home").otherwise("/lander-2")


def _page_url(pos: Column, h1: Column, h2: Column) -> Column:
    even_h1 = F.pmod(h1, F.lit(2)) == 0
    return (
        F.when(pos == 1, _landing_url(h2))
        .when(pos == 3, F.when(F.pmod(h2, F.lit(3)) == 0, LOVE_BEAR).otherwise(MR_FUZZY))
        .when(pos == 4, "/cart")
        .when(pos == 5, "/shipping")
        .when(pos == 6, F.when(even_h1, "/billing").otherwise("/billing-2"))
        .when(pos.isin(7, 9), THANK_YOU)
        .when(pos == 8, F.when(even_h1, LOVE_BEAR).otherwise(MR_FUZZY))
        .otherwise("/products")
    )


def derive_tables(events: DataFrame, part: DataFrame, *, chunk_size: int = DEFAULT_CHUNK) -> Tables:
    ev, chunks = _session_chunks(events, chunk_size)

    # ---- website_sessions: one row per session (the chunk holding its min id)
    sessions = chunks.filter(F.col("cmin") == F.col("sid")).select("user_id", "b", "sid")
    sid = F.col("sid")
    m12 = F.pmod(sid, F.lit(12))
    site_user = F.col("user_id") * F.lit(6) + idiv(F.col("b"), 3)
    sessions = sessions.withColumn("site_user", site_user)
    # a site user spans at most three event buckets, so this window is tiny
    first_b = F.min("b").over(Window.partitionBy("site_user"))
    website_sessions = sessions.select(
        sid.alias("website_session_id"),
        _session_start(F.col("b"), sid).alias("created_at"),
        F.col("site_user").alias("user_id"),
        F.when(F.col("b") == first_b, 0).otherwise(1).cast("int").alias("is_repeat_session"),
        F.when(m12 <= 5, "gsearch").when(m12 <= 8, "bsearch").when(m12 == 11, "socialbook").alias("utm_source"),
        F.when(m12.isin(5, 8), "brand").when(m12 <= 8, "nonbrand").when(m12 == 11, "pilot").alias("utm_campaign"),
        F.when(F.pmod(idiv(sid, 12), F.lit(3)) == 0, "mobile").otherwise("desktop").alias("device_type"),
        F.when((m12 <= 5) | (m12 == 10), GSEARCH_URL)
        .when(m12 <= 8, BSEARCH_URL)
        .when(m12 == 11, SOCIALBOOK_URL)
        .alias("http_referer"),
    )

    # ---- website_pageviews: one per event, ranked inside (session, chunk)
    rank = Window.partitionBy("user_id", "b", "chunk").orderBy("event_id")
    # null-safe on the user: events without a user still form one session per bucket
    ch = chunks.select(
        F.col("user_id").alias("c_user"), F.col("b").alias("c_b"), F.col("chunk").alias("c_chunk"), "sid", "offset"
    )
    on = F.col("user_id").eqNullSafe(F.col("c_user")) & (F.col("b") == F.col("c_b")) & (F.col("chunk") == F.col("c_chunk"))
    pv = ev.join(ch, on).select(
        "event_id",
        "user_id",
        "b",
        "sid",
        (F.col("offset") + F.row_number().over(rank)).alias("pos"),
    )
    pv = pv.select(
        "event_id",
        "user_id",
        "b",
        "sid",
        "pos",
        F.timestamp_add(
            "SECOND", (F.col("pos") - 1) * F.lit(PAGEVIEW_GAP_SECONDS), _session_start(F.col("b"), sid)
        ).alias("created_at"),
        _page_url(F.col("pos"), idiv(sid, 12), idiv(sid, 36)).alias("pageview_url"),
    )
    website_pageviews = pv.select(
        F.col("event_id").alias("website_pageview_id"),
        "created_at",
        sid.alias("website_session_id"),
        "pageview_url",
    )

    # ---- orders: the 7th and 9th view of a session
    prices = (
        part.filter(F.col("p_partkey").isin(0, 1, 2, 3))
        .groupBy("p_partkey")
        .agg(F.max("p_retailprice").alias("retail"))
    )  # at most four rows: safe to broadcast
    items = F.when(F.pmod(sid, F.lit(5)) == 0, 2).otherwise(1).cast("int")
    o = pv.filter(F.col("pos").isin(7, 9)).select(
        F.col("event_id").alias("order_id"),
        "created_at",
        sid.alias("website_session_id"),
        site_user.alias("user_id"),
        (F.pmod(sid, F.lit(4)) + 1).cast("int").alias("primary_product_id"),
        items.alias("items_purchased"),
        F.pmod(sid, F.lit(4)).alias("pkey"),
    )
    o = o.join(F.broadcast(prices), o.pkey == prices.p_partkey, "left")
    orders = o.select(
        "order_id",
        "created_at",
        "website_session_id",
        "user_id",
        "primary_product_id",
        "items_purchased",
        (F.col("retail").cast("decimal(12,2)") * F.col("items_purchased")).cast("decimal(12,2)").alias("price_usd"),
        (F.col("retail") * F.lit(0.4)).cast("decimal(12,2)").alias("cogs_unit"),
    ).withColumn("cogs_usd", (F.col("cogs_unit") * F.col("items_purchased")).cast("decimal(12,2)")).drop("cogs_unit")

    # ---- order_items: one per purchased item
    oi = orders.select(
        "order_id",
        "created_at",
        "primary_product_id",
        # no slots (not a descending sequence) when an order has no items
        F.explode(
            F.when(F.col("items_purchased") > 0, F.sequence(F.lit(0), F.col("items_purchased") - 1))
        ).alias("i"),
    )
    order_items = oi.select(
        (F.col("order_id") * 2 + F.col("i")).alias("order_item_id"),
        "created_at",
        "order_id",
        F.when(F.col("i") == 0, F.col("primary_product_id"))
        .otherwise(F.pmod(F.col("primary_product_id"), F.lit(4)) + 1)
        .cast("int")
        .alias("product_id"),
    )

    # ---- order_item_refunds: every 7th item id
    order_item_refunds = order_items.filter(F.pmod(F.col("order_item_id"), F.lit(7)) == 0).select(
        "order_item_id", "order_id"
    )

    return Tables(website_sessions, website_pageviews, orders, order_items, order_item_refunds).validate()
