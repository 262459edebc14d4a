"""A dictionary of the site's URLs, so that aggregates carry a number instead of a text.

``min_by`` of a string needs a sort-based aggregate over every pageview, since a
string does not fit a hash aggregate's buffer.  The 64-bit hash of a URL does.
The dictionary gives hash and URL of all pageviews; it is made when the tables
are written, and making it checks that no two URLs share a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.plans.session_facts import PVID, SID, URL

KEY = "url_key"
SCHEMA = f"{KEY} long, {URL} string"


def url_key(url: Column) -> Column:
    """The number of a URL; NULL for none."""
    return F.when(url.isNotNull(), F.xxhash64(url))


def url_dictionary(pageviews: DataFrame) -> DataFrame:
    """(url_key, pageview_url) of the distinct URLs: one partially aggregated pass."""
    urls = pageviews.filter(F.col(URL).isNotNull()).select(URL).distinct()
    return urls.select(url_key(F.col(URL)).alias(KEY), URL)


def check_dictionary(urls: DataFrame) -> None:
    """Raise if two URLs share a number (the driver gets one row)."""
    if bad := urls.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first():
        raise ValueError(f"{bad['n']} URLs share the hash {bad[KEY]}")


def landing_keys(pageviews: DataFrame) -> DataFrame:
    """Per session: the number of the URL of its lowest pageview id, from a hash aggregate."""
    return pageviews.groupBy(SID).agg(F.min_by(url_key(F.col(URL)), PVID).alias(KEY))


def named(rows: DataFrame, urls: DataFrame, alias: str) -> DataFrame:
    """``rows`` with the URL of ``url_key`` as ``alias``; a NULL key stays NULL."""
    return rows.join(urls.withColumnRenamed(URL, alias), KEY, "left").drop(KEY)
