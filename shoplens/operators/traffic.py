"""I. Traffic source analyses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import in_range, ratio, sunday_week
from shoplens.model import Tables
from shoplens.plans.distinct import key_grain, with_orders
from shoplens.plans.session_facts import SID

SOURCE_KEYS = ("utm_source", "utm_campaign", "http_referer")


def top_traffic_sources(t: Tables, *, before: str = "2012-04-12", by: Sequence[str] = SOURCE_KEYS) -> DataFrame:
    """Sessions per source/campaign/referer (NULLs form their own groups)."""
    s = t.S.filter(in_range(t.S, before=before))
    return key_grain(t, "website_sessions", s, by).groupBy(*by).agg(F.count(SID).alias("sessions")).orderBy(F.desc("sessions"))


def conversion(
    t: Tables,
    *,
    by: Sequence[str],
    after: str | None = None,
    from_: str | None = None,
    before: str | None = None,
) -> DataFrame:
    """Sessions, orders and session-to-order conversion per ``by`` for the
    sessions started in the window; their orders count whenever placed.
    Distinct counts: a session with two orders is one session, two orders."""
    s = t.S.filter(in_range(t.S, after=after, from_=from_, before=before))
    j = with_orders(t, key_grain(t, "website_sessions", s, by), by)
    sessions, orders = F.count(SID), F.coalesce(F.sum("n_orders"), F.lit(0))
    return j.groupBy(*by).agg(
        sessions.alias("sessions"), orders.alias("orders"), ratio(orders, sessions).alias("conv_rate")
    )


def traffic_conversion_rates(
    t: Tables, *, before: str = "2012-04-12", by: Sequence[str] = SOURCE_KEYS
) -> DataFrame:
    """Session-to-order conversion per source; orders placed after the bound
    still count (only sessions are filtered)."""
    return conversion(t, by=by, before=before).orderBy(F.desc("conv_rate"))


def traffic_source_trend(
    t: Tables, *, before: str = "2012-05-10", source: str = "gsearch", campaign: str = "nonbrand"
) -> DataFrame:
    """Weekly sessions of one source/campaign.  Weeks carry no year and the
    week number itself is not returned: rows are identified by start_date."""
    s = t.S.filter(
        in_range(t.S, before=before) & (F.col("utm_source") == source) & (F.col("utm_campaign") == campaign)
    )
    weeks = key_grain(t, "website_sessions", s, {"wk": sunday_week("created_at")}, start=("min", F.col("created_at")))
    return weeks.groupBy("wk").agg(F.min("start").alias("start_date"), F.count(SID).alias("sessions")).drop("wk")


def device_conversion(t: Tables, *, before: str = "2012-05-11") -> DataFrame:
    """Conversion per device type (all sources)."""
    return conversion(t, by=["device_type"], before=before)


def device_weekly_trend(
    t: Tables,
    *,
    after: str = "2012-04-15",
    before: str = "2012-06-09",
    source: str = "gsearch",
    campaign: str = "nonbrand",
) -> DataFrame:
    """Weekly mobile vs desktop sessions of one source/campaign."""
    s = t.S.filter(
        in_range(t.S, after=after, before=before)
        & (F.col("utm_source") == source)
        & (F.col("utm_campaign") == campaign)
    )
    devices = {d: ("max", F.when((F.col("device_type") == d) & F.col(SID).isNotNull(), 1)) for d in ("mobile", "desktop")}
    weeks = key_grain(
        t, "website_sessions", s, {"week_num": sunday_week("created_at")}, day=("min", F.to_date("created_at")), **devices
    )
    return weeks.groupBy("week_num").agg(
        F.min("day").alias("start_data"),
        F.count("mobile").alias("mobile_sessions"),
        F.count("desktop").alias("desktop_sessions"),
    )
