"""Declared keys: checked when declared, stored with the tables, and only ever a matter of the plan."""

from __future__ import annotations

import pytest

from support import SF_SMALL, order_row, session_row

from shoplens import operators as ops
from shoplens.model import PRIMARY_KEYS
from shoplens.sources import from_driver_dir, read_parquet_tables, write_parquet_tables

SESSION = session_row(1, "2012-03-20 10:00:00")
ORDER = order_row(7, "2012-03-20 11:00:00", 1)


def test_repeated_rows_count_once_where_a_count_is_distinct(make_tables):
    t = make_tables(website_sessions=[SESSION] * 3, orders=[ORDER] * 2)
    (r,) = ops.top_traffic_sources(t).collect()
    assert r.sessions == 1
    (r,) = ops.traffic_conversion_rates(t).collect()
    assert (r.sessions, r.orders, r.conv_rate) == (1, 1, 1.0)
    (r,) = ops.product_sales(t).collect()
    assert r.num_of_sales == 1 and r.total_revenue == 100
    (r,) = ops.product_launch(t, after="2012-01-01").collect()
    assert (r.sessions, r.orders, r.revenue_per_session, r.product1_orders) == (1, 1, 300.0, 6)


def test_an_order_of_two_sessions_counts_once_in_their_group(make_tables):
    t = make_tables(
        website_sessions=[SESSION, session_row(2, "2012-03-21 10:00:00"), session_row(3, "2012-03-21 10:00:00", source="bsearch")],
        orders=[ORDER, order_row(7, "2012-03-21 11:00:00", 2), order_row(7, "2012-03-21 11:00:00", 3)],
    )
    got = {r.utm_source: (r.sessions, r.orders) for r in ops.traffic_conversion_rates(t).collect()}
    assert got == {"gsearch": (2, 1), "bsearch": (1, 1)}


def test_a_key_that_does_not_hold_is_refused(make_tables):
    t = make_tables(website_sessions=[SESSION], orders=[ORDER] * 2)
    assert t.declare_unique(["website_sessions"]).unique == {"website_sessions"}
    with pytest.raises(ValueError, match="orders.order_id is not unique: 7 occurs 2 times"):
        t.declare_unique()
    with pytest.raises(ValueError, match="without a primary key"):
        t.declare_unique(["order_item_refunds"])
    null = make_tables(orders=[(None, *ORDER[1:])])
    with pytest.raises(ValueError, match="orders.order_id"):
        null.declare_unique(["orders"])


def test_declared_keys_are_stored_and_read_back(spark, make_tables, tmp_path):
    t = make_tables(website_sessions=[SESSION], orders=[ORDER]).declare_unique(["orders"])
    write_parquet_tables(t, str(tmp_path / "a"))
    assert read_parquet_tables(spark, str(tmp_path / "a")).unique == {"orders"}
    assert read_parquet_tables(spark, str(tmp_path / "a"), unique=[]).unique == frozenset()
    write_parquet_tables(make_tables(orders=[ORDER] * 2), str(tmp_path / "b"))
    assert read_parquet_tables(spark, str(tmp_path / "b")).unique == frozenset()
    with pytest.raises(ValueError, match="orders.order_id"):
        read_parquet_tables(spark, str(tmp_path / "b"), unique=["orders"])


def test_appending_checks_declared_keys_over_old_and_new_rows(spark, make_tables, tmp_path):
    path = str(tmp_path / "t")
    write_parquet_tables(make_tables(website_sessions=[SESSION], orders=[ORDER]).declare_unique(), path)
    with pytest.raises(ValueError, match="orders.order_id is not unique: 7"):
        write_parquet_tables(make_tables(orders=[ORDER]), path, mode="append")
    assert read_parquet_tables(spark, path).O.count() == 1
    write_parquet_tables(make_tables(orders=[order_row(8, "2012-04-20 11:00:00", 1)]), path, mode="append")
    back = read_parquet_tables(spark, path)
    assert back.O.count() == 2 and "orders" in back.unique


def test_the_derived_tables_keys_hold(spark):
    t = from_driver_dir(spark, SF_SMALL)
    assert t.unique == set(PRIMARY_KEYS)
    for name, bad in t.key_violations().items():
        assert bad.isEmpty(), name


@pytest.mark.parametrize("name", ["top_traffic_sources", "product_sales", "hourly_weekday_pattern", "traffic_conversion_rates"])
def test_undeclared_keys_are_counted_over_group_and_key(spark, make_tables, name):
    """No DISTINCT aggregate and no Expand: the exchange carries partial results on group and key."""
    t = make_tables(website_sessions=[SESSION], orders=[ORDER])
    safe = ops.OPERATORS[name](t)._jdf.queryExecution().executedPlan().toString()
    fast = ops.OPERATORS[name](t.declare_unique())._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in safe and "distinct" not in safe
    key = "order_id" if name == "product_sales" else "website_session_id"
    spread = [x for x in safe.splitlines() if "hashpartitioning(" in x and "," in x.split("hashpartitioning(")[1].split(")")[0] and key in x]
    assert spread and safe.count("Exchange") > fast.count("Exchange"), safe
