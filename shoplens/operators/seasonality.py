"""IV. Seasonality and business patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import in_range, round_half_up_avg, weekday_mon0
from shoplens.model import Tables
from shoplens.plans.distinct import key_grain, with_orders
from shoplens.plans.session_facts import SID

WEEKDAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def monthly_seasonality(t: Tables, *, before: str = "2013-01-01") -> DataFrame:
    """Sessions and orders per year and month of the session start."""
    s = t.S.filter(in_range(t.S, before=before))
    months = key_grain(t, "website_sessions", s, {"year": F.year("created_at"), "month": F.month("created_at")})
    return with_orders(t, months, ["year", "month"]).groupBy("year", "month").agg(
        F.count(SID).alias("sessions"),
        F.coalesce(F.sum("n_orders"), F.lit(0)).alias("orders"),
    )


def hourly_weekday_pattern(
    t: Tables, *, start: str = "2013-09-15", end: str = "2013-11-15"
) -> DataFrame:
    """Average sessions per hour of day for each weekday.  The average runs
    over the days on which that hour had sessions (absent hours are not
    zeros); ``BETWEEN`` bounds are inclusive, the end at midnight."""
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    s = t.S.filter(F.col("created_at").between(lo, hi))
    hours = {"day": F.to_date("created_at"), "wkday": weekday_mon0("created_at"), "hr": F.hour("created_at")}
    per_day = key_grain(t, "website_sessions", s, hours).groupBy(*hours).agg(F.count(SID).alias("website_sessions"))
    return per_day.groupBy("hr").agg(
        *[
            round_half_up_avg(F.when(F.col("wkday") == k, F.col("website_sessions")), 1).alias(name)
            for k, name in enumerate(WEEKDAY_NAMES)
        ]
    )
