"""II. Website performance: top pages, entry pages, bounce rates, landing
page tests, conversion funnels and the billing page test."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import count_if, date_in_range, in_range, named_urls, ratio, sunday_week
from shoplens.model import Tables
from shoplens.plans.distinct import sessions_where, with_orders
from shoplens.plans.session_facts import (
    PVID,
    SID,
    URL,
    explode_periods,
    first_views,
    url_counts,
    view_counts,
    with_bounce,
)
from shoplens.plans.urls import KEY, landing_keys, named

# The page paths of the shop's funnel.
HOME = "/home"
LANDER_1 = "/lander-1"
PRODUCTS = "/products"
MR_FUZZY = "/the-original-mr-fuzzy"
CART = "/cart"
SHIPPING = "/shipping"
BILLING = "/billing"
BILLING_2 = "/billing-2"
THANK_YOU = "/thank-you-for-your-order"

LANDING_NAMES = {"home_num": HOME, "lander_1_num": LANDER_1}

CLICK_STEPS: dict[str, str] = {
    "lander_click": LANDER_1,
    "products_click": PRODUCTS,
    "t_omf_click": MR_FUZZY,
    "cart_click": CART,
    "shipping_click": SHIPPING,
    "billing_click": BILLING,
    "tyfyo_click": THANK_YOU,
}


def top_pages(t: Tables, *, before: str = "2012-06-09") -> DataFrame:
    """Distinct sessions per URL; a session counts once per URL.

    Written as two aggregates rather than ``count_distinct``: Spark plans a
    single distinct count with its exchange on the URL alone, so every
    (URL, session) pair of a page would go to one task and the parallelism
    would be the number of pages.  Here the pairs are made distinct with an
    exchange on (URL, session), then counted per URL from partial counts."""
    p = t.P.filter(in_range(t.P, before=before))
    pairs = p.select(URL, SID).distinct()
    return pairs.groupBy(URL).agg(F.count(SID).alias("sessions")).orderBy(F.desc("sessions"))


def top_entry_pages(t: Tables, *, before: str = "2012-06-12") -> DataFrame:
    """Sessions per landing page (URL of the session's lowest pageview id).

    With a URL dictionary the aggregate carries the URL's number, and only the
    counts per page are joined with the URLs."""
    p = t.P.filter(in_range(t.P, before=before))
    counts = F.count(SID).alias("sessions_hitting_this_page")
    if t.urls is not None:
        per_page = landing_keys(p).groupBy(KEY).agg(counts)
        return named(per_page, t.urls, "landing_page").select("landing_page", "sessions_hitting_this_page")
    return first_views(p).groupBy("landing_page").agg(counts)


def _bounce_flag(sessions: DataFrame, t: Tables) -> DataFrame:
    if t.states:
        return with_bounce(sessions, t.states.view_counts())
    return with_bounce(sessions, view_counts(t.of_sessions(t.P, sessions)))


def home_bounce_rate(t: Tables, *, before: str = "2012-06-14", landing: str = HOME) -> DataFrame:
    """Bounce rate of sessions landing on ``landing`` (one row).

    One pass: a single grouped aggregate per session holds whether its lowest
    windowed pageview id is a view of ``landing``, and its undated view count.
    With stored states, both come from these, but for the bound's own month."""
    total, bounces = F.count(SID), F.sum(F.when(F.col("n_views") == 1, 1).otherwise(0)).cast("long")
    rates = [total.alias("total_sessions"), bounces.alias("bounce_number"), ratio(bounces, total).alias("bounce_rate")]
    if t.states:
        first = t.states.first_views(t.P, before).filter(F.col("landing_page") == landing)
        return first.join(t.states.view_counts(), SID).agg(*rates)
    windowed = F.when(in_range("created_at", before=before), F.col(PVID))
    is_landing = F.when(F.col(URL) == landing, 1).otherwise(0)
    landed = (
        t.P.filter(F.col(SID).isNotNull())
        .groupBy(SID)
        .agg(F.min_by(is_landing, windowed).alias("landed"), F.count(PVID).alias("n_views"))
        .filter(F.col("landed") == 1)
    )
    return landed.agg(*rates)


def first_seen(t: Tables, url: str, *, names: tuple[str, str] = ("first_created_at", "first_pv_id"),
               dated_only: bool = False) -> DataFrame:
    """One row: the earliest time and the lowest pageview id of ``url`` (two
    independent minima).  ``dated_only`` skips views without a timestamp."""
    cond = F.col(URL) == url
    if dated_only:
        cond = cond & F.col("created_at").isNotNull()
    return t.P.filter(cond).agg(F.min("created_at").alias(names[0]), F.min(PVID).alias(names[1]))


def lander_first_seen(t: Tables, *, url: str = LANDER_1) -> DataFrame:
    """First time and first pageview id of ``url``."""
    return first_seen(t, url, names=("frist_date_for_lander1", "first_pv_lander1"), dated_only=True)


def billing_first_seen(t: Tables, *, url: str = BILLING_2) -> DataFrame:
    """First time and first pageview id of ``url``."""
    return first_seen(t, url)


def landing_page_test(
    t: Tables,
    *,
    from_date: str = "2012-06-19",
    before_date: str = "2012-07-28",
    source: str = "gsearch",
    campaign: str = "nonbrand",
    landings: Sequence[str] = (HOME, LANDER_1),
) -> DataFrame:
    """Bounce rate per landing page for one source/campaign; the window is
    on calendar dates of the pageviews."""
    pw = t.P.filter(date_in_range(t.P, from_=from_date, before=before_date))
    first = first_views(pw, landings=landings).join(
        sessions_where(t, (F.col("utm_source") == source) & (F.col("utm_campaign") == campaign)), SID
    )
    landed = _bounce_flag(first.filter(F.col("landing_page").isNotNull()).select(SID, "landing_page"), t)
    total, bounces = F.count(SID), F.sum("bounce_or_not").cast("long")
    return landed.groupBy("landing_page").agg(
        total.alias("total_sessions"), bounces.alias("bounce_numbers"), ratio(bounces, total).alias("bounce_rate")
    )


def landing_page_weekly_trend(
    t: Tables,
    *,
    after_date: str = "2012-06-01",
    before_date: str = "2012-08-31",
    source: str = "gsearch",
    campaign: str = "nonbrand",
    landings: Mapping[str, str] | Sequence[str] = (HOME, LANDER_1),
) -> DataFrame:
    """Weekly bounce rate and landing-page mix for one source/campaign, with a
    column per landing page (named by a mapping, or after its path).
    Both end days are excluded (``date > after`` and ``date < before``)."""
    pages = named_urls(landings, LANDING_NAMES)
    pw = t.P.filter(date_in_range(t.P, after=after_date, before=before_date))
    first = first_views(pw, F.min(F.to_date("created_at")).alias("created_date"), landings=list(pages.values())).join(
        sessions_where(t, (F.col("utm_source") == source) & (F.col("utm_campaign") == campaign)), SID
    )
    b = _bounce_flag(first.select(SID, "landing_page", "created_date"), t)
    return b.groupBy(sunday_week("created_date").alias("week_num")).agg(
        F.min("created_date").alias("start_date"),
        F.count(SID).alias("total_sessions"),
        F.sum("bounce_or_not").cast("long").alias("bounce_num"),
        ratio(F.sum("bounce_or_not"), F.count(SID)).alias("bounce_rate"),
        *[count_if(F.col("landing_page") == u, "landing_page").alias(name) for name, u in pages.items()],
    )


def _funnel_steps(landing: str | None, steps: Mapping[str, str] | None) -> tuple[str, dict[str, str]]:
    """The landing page and the steps of a funnel, which go together: with
    default steps the first one is the landing page, with own steps the landing
    page is the first one unless another of them is named."""
    if steps is None:
        landing = landing or LANDER_1
        first = next(iter(CLICK_STEPS))
        return landing, CLICK_STEPS | {first: landing}
    landing = landing or next(iter(steps.values()))
    if landing not in steps.values():
        raise ValueError(f"the landing page {landing!r} is not among the steps")
    return landing, dict(steps)


def session_click_funnel(
    t: Tables,
    *,
    after: str = "2012-08-05",
    before: str = "2012-09-05",
    source: str = "gsearch",
    landing: str | None = None,
    steps: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per session that landed on ``landing``: number of views of each
    funnel page (views, not 0/1 flags; pageviews are not date-bounded)."""
    landing, steps = _funnel_steps(landing, steps)
    pw = t.P.filter(in_range(t.P, after=after, before=before))
    first = first_views(pw, landings=[landing]).join(sessions_where(t, F.col("utm_source") == source), SID)
    landed = first.filter(F.col("landing_page") == landing).select(SID)
    counts = t.states.url_counts(steps) if t.states else url_counts(t.of_sessions(t.P, landed), steps)
    names = list(steps)
    return landed.join(counts, SID, "left").select(
        SID, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names]
    )


FUNNEL_RATE_NAMES = (
    "lander_p_rate",
    "products_tomf_rate",
    "tomf_cart_rate",
    "cart_s_rate",
    "shipping_b_rate",
    "billing_e_rate",
)


def conversion_funnel_rates(t: Tables, **kw) -> DataFrame:
    """Step-to-step click rates summed over the funnel sessions (one row).

    Takes the parameters of ``session_click_funnel``.  With the default steps
    the rates carry the report's names; with other steps each rate is named
    ``<step>_rate`` after the step it leads to."""
    _, steps = _funnel_steps(kw.get("landing"), kw.get("steps"))
    names = list(steps)
    per = session_click_funnel(t, **kw)
    sums = [F.sum(n) for n in names]
    if list(steps) == list(CLICK_STEPS):
        rate_names = list(FUNNEL_RATE_NAMES)
    else:
        rate_names = [f"{n}_rate" for n in names[1:]]
    return per.agg(
        sums[0].alias("total_session"),
        *[ratio(sums[i + 1], sums[i]).alias(rate_names[i]) for i in range(len(names) - 1)],
    )


def billing_page_test(
    t: Tables,
    *,
    before: str = "2012-11-10",
    min_pageview_id: int | None = None,
    urls: Sequence[str] = (BILLING, BILLING_2),
    new_url: str | None = None,
) -> DataFrame:
    """Billing-page version vs order rate.  By default the id threshold is
    the first pageview id of the new version (the last of ``urls``; a scalar
    subquery, evaluated once by Spark), so the test only covers the period both
    versions ran."""
    new_url = new_url or urls[-1]
    if new_url not in urls:
        raise ValueError(f"the new version {new_url!r} is not among the pages tested")
    if min_pageview_id is None:
        threshold = t.P.filter(F.col(URL) == new_url).agg(F.min(PVID)).scalar()
    else:
        threshold = F.lit(min_pageview_id)
    # one row per session with a presence count per version (grouping by the
    # session alone keeps the join with the order facts exchange-free)
    seen = (
        t.P.filter(in_range(t.P, before=before) & (F.col(PVID) >= threshold) & F.col(URL).isin(*urls))
        .groupBy(SID)
        .agg(*[F.count(F.when(F.col(URL) == u, 1)).alias(f"v{i}") for i, u in enumerate(urls)])
    )
    per_version = explode_periods(seen, {u: [f"v{i}"] for i, u in enumerate(urls)}, ["n"], label="billing_version")
    per_version = with_orders(t, per_version, ["billing_version"])
    sessions, orders = F.count(SID), F.coalesce(F.sum("n_orders"), F.lit(0))
    return per_version.groupBy("billing_version").agg(
        sessions.alias("sessions"), orders.alias("orders"), ratio(orders, sessions).alias("billing_to_order_rate")
    )
