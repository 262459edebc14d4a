"""VI. User analyses: repeat visitors, repeat gaps, channels and value of
new vs repeat sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import channel_group, count_if, in_range, ratio
from shoplens.model import Tables
from shoplens.plans.session_facts import SID, left_join_weight, order_facts


def repeat_visitors(t: Tables, *, from_: str = "2014-01-01", before: str = "2014-11-01") -> DataFrame:
    """Histogram: number of users by their count of repeat sessions in the
    window (users whose first session predates the window are included)."""
    s = t.S.filter(in_range(t.S, from_=from_, before=before))
    per_user = s.groupBy("user_id").agg(F.sum("is_repeat_session").alias("repeat_num"))
    return per_user.groupBy("repeat_num").agg(F.count("user_id").alias("users"))


def repeat_interval(t: Tables, *, from_: str = "2014-01-01", before: str = "2014-11-03") -> DataFrame:
    """Days from a user's new session to their first repeat session, both in
    the window: max, min and average over (user, new session) pairs.

    One pass: a single grouped aggregate per user holds the first repeat day
    ``s`` and, of the new sessions' days ``d``, count, min, max and sum.  The
    pair gaps ``s - d`` then give ``max = s - min(d)``, ``min = s - max(d)`` and
    ``sum = n*s - sum(d)`` exactly (integers)."""
    day = F.unix_date(F.to_date("created_at"))
    new = F.when(F.col("is_repeat_session") == 0, day)
    again = F.when(F.col("is_repeat_session") == 1, day)
    per_user = (
        t.S.filter(in_range(t.S, from_=from_, before=before) & F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.min(again).alias("s"),
            F.count(new).alias("n"),
            F.min(new).alias("d_min"),
            F.max(new).alias("d_max"),
            F.sum(new).alias("d_sum"),
        )
        .filter(F.col("s").isNotNull() & (F.col("n") > 0))
    )
    s = F.col("s")
    return per_user.agg(
        F.max(s - F.col("d_min")).cast("int").alias("max_days"),
        F.min(s - F.col("d_max")).cast("int").alias("min_days"),
        ratio(F.sum(F.col("n") * s - F.col("d_sum")), F.sum("n")).alias("avg_days"),
    )


def channel_new_vs_repeat(t: Tables, *, from_: str = "2014-01-01", before: str = "2014-11-05") -> DataFrame:
    """New vs repeat sessions per channel group."""
    s = t.S.filter(in_range(t.S, from_=from_, before=before))
    rep = F.col("is_repeat_session")
    return s.groupBy(channel_group().alias("channel_group")).agg(
        count_if(rep == 0, "user_id").alias("new_sessions"),
        count_if(rep == 1, "user_id").alias("repeated_sessions"),
    )


def new_vs_repeat_performance(
    t: Tables, *, from_: str = "2014-01-01", before: str = "2014-11-08"
) -> DataFrame:
    """Conversion and revenue per session for new vs repeat sessions
    (joined-row counts, as a plain left join gives)."""
    s = t.S.filter(in_range(t.S, from_=from_, before=before)).select(SID, "is_repeat_session")
    j = s.join(order_facts(t.of_sessions(t.O, s)), SID, "left")
    rows = F.sum(left_join_weight())
    return j.groupBy("is_repeat_session").agg(
        rows.alias("sessions"),
        ratio(F.sum(F.coalesce(F.col("n_rows"), F.lit(0))), rows).alias("rate"),
        ratio(F.sum("revenue"), rows).alias("revernue_per_session"),
    )
