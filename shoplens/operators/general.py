"""General forms of the analyses: any pages, steps, tags, windows and periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions import in_range, ratio
from shoplens.model import Tables
from shoplens.plans.distinct import sessions_where, with_orders
from shoplens.plans.periods import Periods
from shoplens.plans.session_facts import (
    PVID,
    SID,
    URL,
    explode_periods,
    first_views,
    left_join_weight,
    order_facts,
    view_counts,
    with_bounce,
)
from shoplens.plans.steps import session_steps, session_tags, step_totals


def _session_rows(t: Tables, by: Sequence[str], where: Column | None) -> DataFrame:
    """Sessions (id and attributes), one row each unless stored with several attribute values."""
    s = (t.S if where is None else t.S.filter(where)).select(SID, *by)
    return s if "website_sessions" in t.unique else s.distinct()


def bounce(
    t: Tables,
    *,
    by: Sequence[str] = (),
    landings: Sequence[str] | None = None,
    where: Column | None = None,
    after: str | None = None,
    from_: str | None = None,
    before: str | None = None,
) -> DataFrame:
    """Bounce rate per landing page and session attributes ``by``.

    The landing page is the URL of a session's lowest pageview id in the
    window; a session bounces if it has one pageview of all time.  ``where`` is
    a condition on sessions; without it and ``by``, sessions that are only known
    from pageviews count too."""
    first = first_views(t.P.filter(in_range(t.P, after=after, from_=from_, before=before)), landings=landings)
    first = first.filter(F.col(SID).isNotNull())
    if landings is not None:
        first = first.filter(F.col("landing_page").isNotNull())
    first = first.select(SID, "landing_page")
    if by or where is not None:
        first = first.join(_session_rows(t, by, where), SID)
    counts = t.states.view_counts() if t.states else view_counts(t.of_sessions(t.P, first))
    total, bounces = F.count(SID), F.sum("bounce_or_not").cast("long")
    return with_bounce(first, counts).groupBy("landing_page", *by).agg(
        total.alias("total_sessions"), bounces.alias("bounces"), ratio(bounces, total).alias("bounce_rate")
    )


def funnel(
    t: Tables,
    *,
    steps: Mapping[str, str | Sequence[str]],
    by: Sequence[str] | Mapping[str, Column] = (),
    landing: str | None = None,
    view: Column | None = None,
    where: Column | None = None,
    after: str | None = None,
    from_: str | None = None,
    before: str | None = None,
) -> DataFrame:
    """Views per step, and the rate from each step to the next, split by any tag.

    The funnel's rows are the sessions that landed on ``landing`` in the window;
    or, with ``view`` (a condition on pageviews), every such view in the window,
    so that a session with two of them weighs twice.  ``by`` names session
    attributes, or with ``view`` gives tags of the view as columns.  ``where`` is
    a condition on sessions.  Steps count views of all time."""
    window = t.P.filter(in_range(t.P, after=after, from_=from_, before=before))
    tags: dict[str, Column] = dict(by) if isinstance(by, Mapping) else {}
    attributes = [] if isinstance(by, Mapping) else list(by)
    if tags and view is None:
        raise ValueError("tags of views need a condition on views")
    if view is not None:
        rows = session_tags(window.filter(view), **tags)
    else:
        first = first_views(window, landings=None if landing is None else [landing])
        first = first if landing is None else first.filter(F.col("landing_page") == landing)
        rows = first.select(SID, F.lit(1).cast("long").alias("weight"))
    if attributes or where is not None:
        rows = rows.join(_session_rows(t, attributes, where), SID)
    names = list(steps)
    out = step_totals(session_steps(t, rows, steps), [*tags, *attributes], names)
    rates = [ratio(b, a).alias(f"{b}_rate") for a, b in zip(names, names[1:])]
    return out.select(*tags, *attributes, "sessions", *names, *rates)


def variant_test(t: Tables, *, urls: Sequence[str], since: int | None = None, before: str | None = None) -> DataFrame:
    """Sessions, orders and order rate per page version.  Views count from
    pageview id ``since`` on (default: the first id of the last version)."""
    threshold = F.lit(since) if since is not None else t.P.filter(F.col(URL) == urls[-1]).agg(F.min(PVID)).scalar()
    rows = t.P.filter(in_range(t.P, before=before) & (F.col(PVID) >= threshold) & F.col(URL).isin(*urls))
    seen = rows.filter(F.col(SID).isNotNull()).select(F.col(URL).alias("version"), SID).distinct()
    sessions, orders = F.count(SID), F.coalesce(F.sum("n_orders"), F.lit(0))
    return with_orders(t, seen, ["version"]).groupBy("version").agg(
        sessions.alias("sessions"), orders.alias("orders"), ratio(orders, sessions).alias("order_rate")
    )


def period_compare(
    t: Tables,
    *,
    splits: str | Sequence[str],
    labels: Sequence[str] | None = None,
    until: bool = False,
    views: Mapping[str, Column] | None = None,
    where: Column | None = None,
    after: str | None = None,
    from_: str | None = None,
    before: str | None = None,
) -> DataFrame:
    """Per period of the window: sessions with views in it, views by condition
    (``views``: name -> condition on pageviews), and orders, items and revenue
    of these sessions.  A session with views in several periods counts in each.
    ``where`` is a condition on sessions."""
    periods = Periods.of(splits, labels, ("before", "after"), until)
    conds = {f"v{i}": cond for i, cond in enumerate((views or {}).values())}
    seen = t.P.filter(in_range(t.P, after=after, from_=from_, before=before) & F.col(SID).isNotNull())
    per_session = seen.groupBy(SID).agg(*periods.counts("created_at", n=F.lit(True), **conds))
    if where is not None:
        per_session = per_session.join(sessions_where(t, where), SID)
    j = per_session.join(order_facts(t.of_sessions(t.O, per_session)), SID, "left")
    e = explode_periods(j, periods.columns("n", *conds), ["n", *conds])
    orders = F.coalesce(F.sum("n_rows"), F.lit(0))
    return e.groupBy("time_period").agg(
        F.count(SID).alias("sessions"),
        F.sum(left_join_weight()).alias("joined_rows"),
        *[F.sum(c).alias(name) for c, name in zip(conds, views or {})],
        orders.alias("orders"),
        ratio(orders, F.count(SID)).alias("orders_per_session"),
        ratio(F.sum("items"), orders).alias("items_per_order"),
        ratio(F.sum("revenue"), F.count(SID)).alias("revenue_per_session"),
        ratio(F.sum("revenue"), orders).alias("aov"),
    )
