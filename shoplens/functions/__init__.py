"""Reusable column expressions (ratio, week numbering, conditional counts,
channel classification, time bounds)."""

from shoplens.functions.exprs import (  # noqa: F401
    ORGANIC_REFERERS,
    PAID_SOURCES,
    all_of,
    channel_group,
    count_if,
    date_in_range,
    in_range,
    named_urls,
    ratio,
    round_half_up_avg,
    sum_if,
    sunday_week,
    weekday_mon0,
)
