"""Session-grain plan builders shared by the analyses."""

from shoplens.plans.session_facts import (  # noqa: F401
    PVID,
    SID,
    URL,
    explode_periods,
    first_views,
    left_join_weight,
    order_facts,
    url_counts,
    view_counts,
    with_bounce,
)
