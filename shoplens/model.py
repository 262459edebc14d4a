"""Data model: the five clickstream tables and their Spark schemas."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SESSIONS_SCHEMA = T.StructType(
    [
        T.StructField("website_session_id", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("is_repeat_session", T.IntegerType()),
        T.StructField("utm_source", T.StringType()),
        T.StructField("utm_campaign", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("http_referer", T.StringType()),
    ]
)

PAGEVIEWS_SCHEMA = T.StructType(
    [
        T.StructField("website_pageview_id", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("website_session_id", T.LongType()),
        T.StructField("pageview_url", T.StringType()),
    ]
)

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("website_session_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("primary_product_id", T.IntegerType()),
        T.StructField("items_purchased", T.IntegerType()),
        T.StructField("price_usd", T.DecimalType(12, 2)),
        T.StructField("cogs_usd", T.DecimalType(12, 2)),
    ]
)

ORDER_ITEMS_SCHEMA = T.StructType(
    [
        T.StructField("order_item_id", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.IntegerType()),
    ]
)

REFUNDS_SCHEMA = T.StructType(
    [
        T.StructField("order_item_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
    ]
)

TABLE_SCHEMAS = {
    "website_sessions": SESSIONS_SCHEMA,
    "website_pageviews": PAGEVIEWS_SCHEMA,
    "orders": ORDERS_SCHEMA,
    "order_items": ORDER_ITEMS_SCHEMA,
    "order_item_refunds": REFUNDS_SCHEMA,
}

# Primary keys.  Where a key is declared unique (Tables.unique), a count of it at
# its own grain is the distinct count; elsewhere the analyses reduce rows to one
# per group and key first (shoplens.plans.distinct).
PRIMARY_KEYS = {
    "website_sessions": "website_session_id",
    "website_pageviews": "website_pageview_id",
    "orders": "order_id",
    "order_items": "order_item_id",
}


_KINDS = (T.IntegralType, T.DecimalType, T.StringType, (T.TimestampType, T.TimestampNTZType))


def _compatible(have: T.DataType, want: T.DataType) -> bool:
    return have == want or any(isinstance(have, k) and isinstance(want, k) for k in _KINDS)


@dataclass(frozen=True)
class Tables:
    """The five related tables every analysis reads.

    ``unique`` names the tables whose primary key is known to hold (no value
    twice, none NULL).  It is a constraint that readers and writers set after a
    check (``declare_unique``); without it every result still is right, from a
    plan with one more exchange.

    ``reducer`` (a ``shoplens.plans.reducer.Reducer``) turns on the explicit
    semi-join reduction of whole-history tables by a window's sessions.  It
    costs a count of those sessions when an analysis is built, so it is for
    tables whose history is far larger than the windows asked for.

    ``states`` (a ``shoplens.plans.partials.SessionStates``) gives the undated
    pageview counts of the bounce and funnel analyses from stored partial
    states instead of raw pageviews.  They must cover the same pageviews.

    ``urls`` is the dictionary of the pageviews' URLs (``shoplens.plans.urls``),
    which the writers store beside the tables."""

    website_sessions: DataFrame
    website_pageviews: DataFrame
    orders: DataFrame
    order_items: DataFrame
    order_item_refunds: DataFrame
    unique: frozenset[str] = frozenset()
    reducer: Any = None
    states: Any = None
    urls: DataFrame | None = None

    # short aliases used throughout the operators
    @property
    def S(self) -> DataFrame:
        return self.website_sessions

    @property
    def P(self) -> DataFrame:
        return self.website_pageviews

    @property
    def O(self) -> DataFrame:  # noqa: E743
        return self.orders

    @property
    def I(self) -> DataFrame:  # noqa: E743
        return self.order_items

    @property
    def R(self) -> DataFrame:
        return self.order_item_refunds

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLE_SCHEMAS}

    def of_sessions(self, facts: DataFrame, sessions: DataFrame) -> DataFrame:
        """``facts``, of which only rows of ``sessions`` are wanted: reduced to
        these (and a few more) where a reducer is set."""
        return self.reducer.reduce(facts, sessions) if self.reducer else facts

    def key_violations(self) -> dict[str, DataFrame]:
        """Per table, the key values that occur more than once or are NULL
        (lazy; empty DataFrames when the keys hold).  Distributed: one grouped
        count per table, nothing is collected."""
        out = {}
        for name, key in PRIMARY_KEYS.items():
            df = getattr(self, name)
            counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            out[name] = counts.filter((F.col("n") > 1) | F.col(key).isNull())
        return out

    def declare_unique(self, names: Iterable[str] = tuple(PRIMARY_KEYS), *, check: bool = True) -> "Tables":
        """These tables with the primary keys of ``names`` declared unique.

        The check counts each table's keys in Spark and takes one offending
        value to the driver; a key that does not hold raises ``ValueError``.
        ``check=False`` is for keys that hold by construction."""
        names = frozenset(names)
        if unknown := names - set(PRIMARY_KEYS):
            raise ValueError(f"tables without a primary key: {sorted(unknown)}")
        violations = self.key_violations() if check else {}
        for name in sorted(names if check else ()):
            if bad := violations[name].first():
                raise ValueError(f"{name}.{PRIMARY_KEYS[name]} is not unique: {bad[0]!r} occurs {bad['n']} times")
        return replace(self, unique=self.unique | names)

    def validate(self) -> "Tables":
        """Check that every required column is present with a compatible type:
        the schema's own, or one of the same kind (any integer for an integer,
        any decimal for a decimal, a timestamp with or without time zone)."""
        for name, df in self.as_dict().items():
            have = {f.name: f.dataType for f in df.schema.fields}
            for want in TABLE_SCHEMAS[name].fields:
                if want.name not in have:
                    raise ValueError(f"{name}: missing column {want.name!r}")
                if not _compatible(have[want.name], want.dataType):
                    found = have[want.name].simpleString()
                    raise ValueError(f"{name}.{want.name}: type {found}, expected {want.dataType.simpleString()}")
        return self
