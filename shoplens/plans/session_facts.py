"""Session-grain building blocks.

Every web analysis keys on ``website_session_id``.  Instead of joining fact
tables row by row (which multiplies rows when a session has several orders or
several views of a page, and sends every row of a hot session to one task),
each fact table is first reduced to one row per session with a grouped
aggregate.  Spark computes such aggregates map-side first (partial
aggregation), so a session holding a third of all rows costs one row per map
task in the shuffle.  The reduced tables are then joined one-to-one on the
session key, and the reference's fan-out counts are recovered arithmetically
(``count(*)`` of a left join = ``greatest(matches, 1)``, a per-row count
repeated ``k`` times = ``k * count``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SID = "website_session_id"
PVID = "website_pageview_id"
URL = "pageview_url"


def first_views(pageviews: DataFrame, *extra: Column, landings: Sequence[str] | None = None) -> DataFrame:
    """Per session: the lowest pageview id and its URL (the landing page).

    "First" means the minimum id, not the earliest time.  ``min_by`` replaces
    the join back to pageviews on the id (the id is the table's key).

    With ``landings`` the caller only cares whether the landing page is one
    of those URLs: ``landing_page`` is then that URL or NULL.  The aggregate
    then carries the URL's position in the list (an integer) instead of the
    string, which keeps it a hash aggregate; a string-valued ``min_by`` would
    force a sort-based aggregate over every pageview."""
    if landings is None:
        landing = F.min_by(URL, PVID).alias("landing_page")
        return pageviews.groupBy(SID).agg(F.min(PVID).alias("first_pv_id"), landing, *extra)
    urls = F.array(*[F.lit(u) for u in landings])
    pos = F.min_by(F.array_position(urls, F.col(URL)).cast("int"), PVID)
    return pageviews.groupBy(SID).agg(
        F.min(PVID).alias("first_pv_id"),
        F.when(pos > 0, F.element_at(urls, pos)).alias("landing_page"),
        *extra,
    )


def view_counts(pageviews: DataFrame) -> DataFrame:
    """Per session: number of pageviews over the whole table (no date bound)."""
    return pageviews.groupBy(SID).agg(F.count(PVID).alias("n_views"))


def with_bounce(sessions: DataFrame, counts: DataFrame) -> DataFrame:
    """Attach ``bounce_or_not``: 1 when the session has exactly one pageview
    in the whole table (``view_counts``, deliberately not date-bounded).

    Inner join: every session given here came from a pageview, so its count
    is >= 1 and nothing is lost; an inner join also lets AQE broadcast the
    smaller side."""
    return sessions.join(counts, SID).withColumn(
        "bounce_or_not", F.when(F.col("n_views") == 1, 1).otherwise(0)
    )


def url_counts(pageviews: DataFrame, steps: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """Per session: number of views of each step URL (or URL set).

    Only rows whose URL belongs to some step are read, and the ``IN`` filter
    reaches the Parquet scan.  Sessions without any step view are absent;
    callers left-join and treat missing counts as 0."""
    urls: list[str] = []
    conds: dict[str, Column] = {}
    for name, u in steps.items():
        us = [u] if isinstance(u, str) else list(u)
        urls.extend(us)
        conds[name] = F.col(URL).isin(*us)
    distinct_urls = list(dict.fromkeys(urls))
    return (
        pageviews.filter(F.col(URL).isin(*distinct_urls))
        .groupBy(SID)
        .agg(*[F.count(F.when(c, F.lit(1))).alias(name) for name, c in conds.items()])
    )


def order_facts(orders: DataFrame, *extra: Column) -> DataFrame:
    """Per session: joined-row count, order count and money totals.

    ``n_rows`` is the number of order rows of the session (what a left join
    multiplies by); ``n_orders`` counts non-null order ids, which is the distinct
    count where the id is a declared key (see ``shoplens.plans.distinct``)."""
    return orders.groupBy(SID).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("order_id").alias("n_orders"),
        F.sum("items_purchased").alias("items"),
        F.sum("price_usd").alias("revenue"),
        *extra,
    )


def left_join_weight(n_rows: str | Column = "n_rows") -> Column:
    """Rows a session contributes to ``sessions LEFT JOIN facts``."""
    c = F.col(n_rows) if isinstance(n_rows, str) else n_rows
    return F.greatest(F.coalesce(c, F.lit(0)), F.lit(1))


def explode_periods(
    df: DataFrame,
    periods: Mapping[str, Sequence[str]],
    fields: Sequence[str],
    label: str = "time_period",
) -> DataFrame:
    """Turn per-session, per-period columns into one row per (session, period).

    ``periods`` maps a period label to the session's columns for that period,
    in the order of ``fields``; the first field is the presence count and rows
    where it is 0 (the session has no row in that period) are dropped.  This
    is a narrow, per-row transformation: grouping by session alone (instead of
    by session and period) keeps every table hash-partitioned on the session
    key, so the following join needs no exchange."""
    structs = [
        F.struct(F.lit(name).alias(label), *[F.col(c).alias(f) for c, f in zip(cols, fields)])
        for name, cols in periods.items()
    ]
    keep = [c for c in df.columns if all(c not in cols for cols in periods.values())]
    return df.select(*keep, F.inline(F.array(*structs))).filter(F.col(fields[0]) > 0)
