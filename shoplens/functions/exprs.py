"""Column expressions shared by the analyses.

Everything here returns a built-in Catalyst expression, so it stays inside
whole-stage codegen; nothing is evaluated in Python.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The paid and social sources and the organic-search referers
# that the analyses classify by (the channel labels are in channel_group).
PAID_SOURCES = ("gsearch", "bsearch")
SOCIAL_SOURCE = "socialbook"
ORGANIC_REFERERS = ("https://www.gsearch.com", "https://www.bsearch.com")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: str | Column, den: str | Column) -> Column:
    """Null-safe ratio as double: ``x / 0`` and ``x / NULL`` give NULL.

    Spark 4 runs in ANSI mode where a plain division by zero raises, so the
    division goes through ``try_divide`` on doubles.  Decimal sums are cast to
    double first so the result type does not depend on decimal precision.
    """
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def named_urls(urls: Mapping[str, str] | Sequence[str], known: Mapping[str, str]) -> dict[str, str]:
    """``{name: url}`` in the given order.  A mapping is taken as it is; in a
    plain list a URL has its name in ``known``, else one made from its path."""
    if isinstance(urls, Mapping):
        return dict(urls)
    by_url = {u: n for n, u in known.items()}
    named = {by_url.get(u) or re.sub(r"\W+", "_", u.strip("/")).lower() or "root": u for u in urls}
    if len(named) < len(urls):
        raise ValueError(f"URLs without a name of their own: {list(urls)}")
    return named


def sunday_week(ts: str | Column) -> Column:
    """Week of the year, Sunday-first, 0..53; week 1 starts on the first
    Sunday of the year (days before it are week 0).  This is the classic
    ``%U`` numbering; it carries no year."""
    d = F.to_date(col(ts))
    return F.floor((F.dayofyear(d) + F.lit(7) - F.dayofweek(d)) / F.lit(7)).cast("int")


def count_if(cond: Column, value: str | Column) -> Column:
    """``count(CASE WHEN cond THEN value END)`` (plain, not distinct)."""
    return F.count(F.when(cond, col(value)))


def sum_if(cond: Column, value: str | Column) -> Column:
    """``sum(CASE WHEN cond THEN value END)``: NULL when nothing matches."""
    return F.sum(F.when(cond, col(value)))


def weekday_mon0(ts: str | Column) -> Column:
    """Day of week with Monday = 0 .. Sunday = 6."""
    return F.weekday(col(ts))


#: Partition column of a stored table: year and month of ``created_at`` as yyyymm.
MONTH = "created_month"


def _month(bound: str) -> int:
    return int(bound[:4]) * 100 + int(bound[5:7])


def _bounded(
    what: str | Column | DataFrame, value: Callable[[Column], Column], literal: Callable[[str], Column], bounds: Mapping[str, str | None]
) -> Column:
    """Conjunction of bounds on ``value`` of a time column.  For a table that is
    the table's ``created_at``, and if the table is stored by month, the months
    are bounded as well, so that files of other months are not even opened."""
    table = what if isinstance(what, DataFrame) else None
    c = value(F.col("created_at") if table is not None else col(what))
    tests = {
        "after": lambda x, y: x > y,
        "from_": lambda x, y: x >= y,
        "before": lambda x, y: x < y,
        "until": lambda x, y: x <= y,
    }
    conds: list[Column] = []
    for kind, bound in bounds.items():
        if bound is None:
            continue
        conds.append(tests[kind](c, literal(bound)))
        if table is not None and MONTH in table.columns:
            month = F.col(MONTH)
            conds.append(month >= _month(bound) if kind in ("after", "from_") else month <= _month(bound))
    return all_of(conds)


def in_range(
    c: str | Column | DataFrame,
    *,
    after: str | None = None,
    from_: str | None = None,
    before: str | None = None,
    until: str | None = None,
) -> Column:
    """Conjunction of time bounds on a column, or on ``created_at`` of a table:
    ``after`` is ``>``, ``from_`` is ``>=``, ``before`` is ``<``, ``until`` is
    ``<=``.  Bounds are ISO dates (midnight) or timestamps."""
    bounds = {"after": after, "from_": from_, "before": before, "until": until}
    return _bounded(c, lambda x: x, lambda b: F.lit(b).cast("timestamp_ntz"), bounds)


def date_in_range(
    c: str | Column | DataFrame,
    *,
    after: str | None = None,
    from_: str | None = None,
    before: str | None = None,
) -> Column:
    """Bounds on the calendar date of a timestamp (``date(ts) > d`` excludes
    the whole day ``d``).  Spark unwraps ``to_date(ts) op d`` into a timestamp
    range, so these still reach the Parquet scan as pushed filters."""
    bounds = {"after": after, "from_": from_, "before": before}
    return _bounded(c, F.to_date, lambda b: F.to_date(F.lit(b)), bounds)


def all_of(conds: Iterable[Column]) -> Column:
    out: Column | None = None
    for c in conds:
        out = c if out is None else (out & c)
    return F.lit(True) if out is None else out


def channel_group(
    source: str | Column = "utm_source",
    campaign: str | Column = "utm_campaign",
    referer: str | Column = "http_referer",
) -> Column:
    """First-match channel classification of a session."""
    s, c, r = col(source), col(campaign), col(referer)
    paid = s.isin(*PAID_SOURCES)
    return (
        F.when(paid & (c == "brand"), F.lit("paid_brand"))
        .when(paid & (c == "nonbrand"), F.lit("paid_nonbrand"))
        .when(s == SOCIAL_SOURCE, F.lit("paid_social"))
        .when(s.isNull() & r.isNull(), F.lit("direct_type_in"))
        .when(s.isNull() & r.isNotNull(), F.lit("dorganic_search"))
        .otherwise(F.lit("opps_wrong"))
    )


def round_half_up_avg(value: str | Column, digits: int) -> Column:
    """``round(avg(value), digits)`` by the rule of the original SQL engine: the
    average of integers is a decimal of four places, rounded half-up, which is
    then rounded half-up again.  (So 0.04996 becomes 0.0500 and then 0.1.)"""
    avg_dec = F.avg(col(value).cast("decimal(20,0)"))
    return F.round(avg_dec, digits).cast("double")
