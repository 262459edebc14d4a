"""The 34 analyses, one function per result, each ``(Tables, **params) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from shoplens.model import Tables
from shoplens.operators.channel import (
    channel_device_mix,
    channel_device_weekly,
    channel_weekly_sessions,
    cross_channel_conversion,
    free_channel_trend,
)
from shoplens.operators.general import bounce, funnel, period_compare, variant_test
from shoplens.operators.product import (
    cross_sell,
    portfolio_expansion,
    product_funnel_pages,
    product_funnels,
    product_launch,
    product_pathing,
    product_refund_rates,
    product_sales,
)
from shoplens.operators.seasonality import hourly_weekday_pattern, monthly_seasonality
from shoplens.operators.traffic import (
    conversion,
    device_conversion,
    device_weekly_trend,
    top_traffic_sources,
    traffic_conversion_rates,
    traffic_source_trend,
)
from shoplens.operators.users import (
    channel_new_vs_repeat,
    new_vs_repeat_performance,
    repeat_interval,
    repeat_visitors,
)
from shoplens.operators.website import (
    billing_first_seen,
    billing_page_test,
    conversion_funnel_rates,
    first_seen,
    home_bounce_rate,
    landing_page_test,
    landing_page_weekly_trend,
    lander_first_seen,
    session_click_funnel,
    top_entry_pages,
    top_pages,
)

OPERATORS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (
        # I. traffic source
        top_traffic_sources,
        traffic_conversion_rates,
        traffic_source_trend,
        device_conversion,
        device_weekly_trend,
        # II. website performance
        top_pages,
        top_entry_pages,
        home_bounce_rate,
        lander_first_seen,
        landing_page_test,
        landing_page_weekly_trend,
        session_click_funnel,
        conversion_funnel_rates,
        billing_first_seen,
        billing_page_test,
        # III. channel portfolio
        channel_weekly_sessions,
        channel_device_mix,
        cross_channel_conversion,
        channel_device_weekly,
        free_channel_trend,
        # IV. seasonality
        monthly_seasonality,
        hourly_weekday_pattern,
        # V. product
        product_sales,
        product_launch,
        product_pathing,
        product_funnel_pages,
        product_funnels,
        cross_sell,
        portfolio_expansion,
        product_refund_rates,
        # VI. user
        repeat_visitors,
        repeat_interval,
        channel_new_vs_repeat,
        new_vs_repeat_performance,
    )
}


def run(name: str, tables: Tables, **params) -> DataFrame:
    return OPERATORS[name](tables, **params)


# general forms the analyses are built from (not part of the registry)
GENERAL = {f.__name__: f for f in (conversion, first_seen, bounce, funnel, variant_test, period_compare)}

__all__ = ["OPERATORS", "GENERAL", "run", *OPERATORS, *GENERAL]
