"""Distinct counts that do not trust keys.

``count(distinct key)`` per group is a plain count where the rows are one per
key.  Whether they are is a declared constraint (``Tables.unique``), which the
reader or writer of the tables has checked.  Without it, rows are first reduced
to one per (group, key): a grouped aggregate whose exchange is on group and key
together and carries partial results, so neither a group that holds most keys
nor a key with very many rows meets in one task.  (A DISTINCT aggregate would
be exchanged on the group alone.)  Either way the analyses go on with rows of
the same shape.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.model import PRIMARY_KEYS, Tables
from shoplens.plans.session_facts import SID, order_facts

#: Rows of the table that a (group, key) row stands for.
TIMES = "times"

_REDUCE = {"min": F.min, "max": F.max, "sum": F.sum}


def key_grain(
    t: Tables,
    table: str,
    rows: DataFrame,
    by: Mapping[str, Column] | Sequence[str],
    **measures: tuple[str, Column],
) -> DataFrame:
    """``rows`` (of ``table``) as one row per group and key: the group's
    columns, the key, ``times`` and every measure, given as
    ``name=("min" | "max" | "sum", column)``.

    Counting the key then gives the distinct count, and summing a measure or
    ``times`` gives what counts every row.  A key that occurs in several groups
    counts in each."""
    key = PRIMARY_KEYS[table]
    groups = dict(by) if isinstance(by, Mapping) else {c: F.col(c) for c in by}
    keys = [c.alias(name) for name, c in groups.items()] + [F.col(key)]
    if table in t.unique:
        return rows.select(*keys, F.lit(1).alias(TIMES), *[c.alias(name) for name, (_, c) in measures.items()])
    reduced = [_REDUCE[how](c).alias(name) for name, (how, c) in measures.items()]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(TIMES), *reduced)


def with_orders(t: Tables, groups: DataFrame, by: Sequence[str], *measures: Column) -> DataFrame:
    """``groups``, one row per (``by``, session), left-joined with the orders of
    the session (see ``order_facts``), so that the sum of ``n_orders`` per group
    is its number of distinct orders.

    Without a declared order key, an order may be stored several times, for one
    session or for several: the distinct (group, order) pairs then come as rows
    of their own, with ``n_orders`` 1 and nothing else but the group."""
    orders = t.of_sessions(t.O, groups)
    joined = groups.join(order_facts(orders, *measures), SID, "left")
    if "orders" in t.unique:
        return joined
    ids = orders.filter(F.col("order_id").isNotNull() & F.col(SID).isNotNull()).select(SID, "order_id").distinct()
    pairs = groups.select(*by, SID).join(ids, SID).select(*by, "order_id").distinct()
    once = pairs.select(*by, F.lit(1).cast("long").alias("n_orders"))
    return joined.withColumn("n_orders", F.lit(0).cast("long")).unionByName(once, allowMissingColumns=True)


def sessions_where(t: Tables, cond: Column) -> DataFrame:
    """Ids of the sessions that fulfil ``cond``, each once: joining with them filters and multiplies nothing."""
    ids = t.S.filter(cond).select(SID)
    return ids if "website_sessions" in t.unique else ids.distinct()


def distinct_order_rows(t: Tables, orders: DataFrame) -> DataFrame:
    """``orders`` without repeated (session, order, items, price) rows, as a row-wise DISTINCT over these columns gives."""
    return orders if "orders" in t.unique else orders.select(SID, "order_id", "items_purchased", "price_usd").distinct()
