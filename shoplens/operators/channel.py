"""III. Channel portfolio analyses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import ORGANIC_REFERERS, count_if, in_range, ratio, sunday_week
from shoplens.model import Tables
from shoplens.plans.distinct import key_grain
from shoplens.plans.session_facts import SID, left_join_weight, order_facts


def _nonbrand(t: Tables, after: str, before: str, campaign: str) -> DataFrame:
    return t.S.filter(in_range(t.S, after=after, before=before) & (F.col("utm_campaign") == campaign))


def channel_weekly_sessions(
    t: Tables, *, after: str = "2012-08-22", before: str = "2012-11-29", campaign: str = "nonbrand"
) -> DataFrame:
    """Weekly gsearch vs bsearch sessions of one campaign."""
    s = _nonbrand(t, after, before, campaign)
    src = F.col("utm_source")
    return s.groupBy(sunday_week("created_at").alias("week_date")).agg(
        F.min("created_at").alias("start_date"),
        count_if(src == "gsearch", SID).alias("gsearch_sessions"),
        count_if(src == "bsearch", SID).alias("bsearch_sessions"),
    )


def channel_device_mix(
    t: Tables, *, after: str = "2012-08-22", before: str = "2012-11-29", campaign: str = "nonbrand"
) -> DataFrame:
    """Share of mobile sessions per source (distinct sessions, mobile rows)."""
    s = _nonbrand(t, after, before, campaign)
    is_mobile = F.when((F.col("device_type") == "mobile") & F.col(SID).isNotNull(), 1).otherwise(0)
    total, mobile = F.count(SID), F.sum("mobile")
    return key_grain(t, "website_sessions", s, ["utm_source"], mobile=("sum", is_mobile)).groupBy("utm_source").agg(
        total.alias("total_sessions"), mobile.alias("mobile_sessions"), ratio(mobile, total).alias("pct_of_mobile")
    )


def cross_channel_conversion(
    t: Tables, *, after: str = "2012-08-22", before: str = "2012-09-19", campaign: str = "nonbrand"
) -> DataFrame:
    """Conversion per device and source, counting joined rows (a session with
    two orders counts twice as a session), as a plain left join would."""
    s = _nonbrand(t, after, before, campaign).select(SID, "device_type", "utm_source")
    j = s.join(order_facts(t.of_sessions(t.O, s)), SID, "left")
    sessions, orders = F.sum(left_join_weight()), F.sum(F.coalesce(F.col("n_rows"), F.lit(0)))
    return j.groupBy("device_type", "utm_source").agg(
        sessions.alias("sessions"), orders.alias("orders"), ratio(orders, sessions).alias("conv_rate")
    )


def channel_device_weekly(
    t: Tables, *, after: str = "2012-11-04", before: str = "2012-12-22", campaign: str = "nonbrand"
) -> DataFrame:
    """Weekly source x device sessions with bsearch/gsearch ratios."""
    s = _nonbrand(t, after, before, campaign)
    src, dev = F.col("utm_source"), F.col("device_type")

    gm, bm, gd, bd = (
        count_if((src == source) & (dev == device), SID)
        for device in ("mobile", "desktop")
        for source in ("gsearch", "bsearch")
    )
    return s.groupBy(sunday_week("created_at").alias("week_date")).agg(
        F.min("created_at").alias("start_date"),
        gm.alias("gm_sessions"),
        bm.alias("bm_sessions"),
        ratio(bm, gm).alias("bm_gm_rate"),
        gd.alias("gd_sessions"),
        bd.alias("bd_sessions"),
        ratio(bd, gd).alias("bd_fd_rate"),
    )


def free_channel_trend(
    t: Tables, *, before: str = "2012-12-23", organic_referers: Sequence[str] = ORGANIC_REFERERS
) -> DataFrame:
    """Monthly brand, direct and organic sessions relative to paid nonbrand.
    Months carry no year."""
    s = t.S.filter(in_range(t.S, before=before))
    camp, src, ref = F.col("utm_campaign"), F.col("utm_source"), F.col("http_referer")
    nonbrand = count_if(camp == "nonbrand", SID)
    brand = count_if(camp == "brand", SID)
    direct = count_if(src.isNull() & ref.isNull(), SID)
    organic = count_if(src.isNull() & ref.isin(*organic_referers), SID)
    return s.groupBy(F.month("created_at").alias("month_date")).agg(
        F.min(F.to_date("created_at")).alias("start_date"),
        nonbrand.alias("nonbrand_sessions"),
        brand.alias("brand_sessions"),
        ratio(brand, nonbrand).alias("brand_pct_of_nonbrand"),
        direct.alias("direct_sessions"),
        ratio(direct, nonbrand).alias("direct_pct_of_nonbrand"),
        organic.alias("organic_sessions"),
        ratio(organic, nonbrand).alias("organic_pct_of_nonbrand"),
    )
