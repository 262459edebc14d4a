"""Property check: on random five-table data with heavy fan-out (several
orders per session, repeated page views, several refund rows per item,
pageview ids out of time order, sessions and orders stored several times) and NULLs (sources, referers, URLs, pageview
times, users, order sessions, item products) every analysis equals the plain
relational DuckDB statement run over the very same rows."""

from __future__ import annotations

import datetime as dt
import os
import random
import sys
from decimal import Decimal

import duckdb
import pandas as pd
import pytest

from support import ROOT

sys.path.insert(0, os.path.join(ROOT, "tools"))
from compare import rows_of  # noqa: E402

from duck_oracle import table_sql  # noqa: E402
from shoplens.model import TABLE_SCHEMAS, Tables  # noqa: E402
from shoplens.operators import OPERATORS  # noqa: E402

URLS = [
    "/home", "/lander-1", "/lander-2", "/products", "/the-original-mr-fuzzy", "/the-forever-love-bear",
    "/cart", "/shipping", "/billing", "/billing-2", "/thank-you-for-your-order",
]
SOURCES = ["gsearch", "gsearch", "gsearch", "bsearch", "socialbook", None]
CAMPAIGNS = ["brand", "nonbrand", "nonbrand", "nonbrand", "pilot", None]
LANDERS = ["/home", "/lander-1", "/lander-1", "/lander-2"]
REFERERS = ["https://www.gsearch.com", "https://www.bsearch.com", "https://www.socialbook.com", None]
START = dt.datetime(2012, 3, 1)
SPAN_SECONDS = 1000 * 86400


def random_rows(seed: int, n_sessions: int = 1500):
    rnd = random.Random(seed)
    sessions, views, orders, items, refunds = [], [], [], [], []
    pvids = rnd.sample(range(1, 50 * n_sessions), 12 * n_sessions)  # ids not in time order
    order_id, item_id = 1, 1
    for sid in range(1, n_sessions + 1):
        created = START + dt.timedelta(seconds=rnd.randrange(SPAN_SECONDS))
        user = rnd.randrange(1, n_sessions // 3) if rnd.random() > 0.01 else None
        sessions.append((sid, created, user, rnd.randint(0, 1), rnd.choice(SOURCES), rnd.choice(CAMPAIGNS),
                         rnd.choice(["mobile", "desktop"]), rnd.choice(REFERERS)))
        for k in range(rnd.choice([1, 1, 2, 3, 5, 8, 12])):
            t = created + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400 if k else 1))
            url = rnd.choice(LANDERS) if k == 0 and rnd.random() < 0.7 else rnd.choice(URLS)
            if rnd.random() < 0.02:
                url = None
            if rnd.random() < 0.01:
                t = None  # undated views still count in the per-session totals
            # a few pageviews belong to no session
            views.append((pvids.pop(), t, None if rnd.random() < 0.02 else sid, url))
        for _ in range(rnd.choice([0, 0, 0, 1, 1, 2, 3])):
            n_items = rnd.randint(1, 3)
            price = Decimal(rnd.randrange(1000, 9000)) / 100
            oc = created + dt.timedelta(seconds=rnd.randrange(0, 86400 * 30))
            o_sid = sid if rnd.random() > 0.02 else None
            orders.append((order_id, oc, o_sid, user, rnd.randint(1, 4), n_items, price * n_items,
                           (price * Decimal("0.4")).quantize(Decimal("0.01")) * n_items))
            for _ in range(n_items):
                items.append((item_id, oc, order_id, rnd.randint(1, 4) if rnd.random() > 0.02 else None))
                for _ in range(rnd.choice([0, 0, 0, 1, 2])):
                    refunds.append((item_id, rnd.choice([order_id, order_id, None])))
                item_id += 1
            order_id += 1
    return {
        "website_sessions": sessions,
        "website_pageviews": views,
        "orders": orders,
        "order_items": items,
        "order_item_refunds": refunds,
    }


DUCK_NAMES = {"orders": "m_orders"}


def with_repeats(rows, seed: int):
    """Sessions and orders stored several times: exact copies, and rows of the
    same id with another time, source, session, price or product."""
    rnd = random.Random(seed)
    sessions, orders = rows["website_sessions"], rows["orders"]
    later = lambda t: t + dt.timedelta(seconds=rnd.randrange(60 * 86400))
    more = [rnd.choice(sessions) for _ in range(len(sessions) // 4)]
    more += [(s[0], later(s[1]), s[2], 1 - s[3], rnd.choice(SOURCES), rnd.choice(CAMPAIGNS), *s[6:]) for s in more[::3]]
    again = [rnd.choice(orders) for _ in range(len(orders) // 4)]
    again += [(o[0], later(o[1]), rnd.choice(sessions)[0], o[3], rnd.randint(1, 4), o[5], o[6] + 1, o[7]) for o in again[::3]]
    again += [(o[0], o[1], o[2], o[3], o[4], o[5], o[6] + 2, o[7]) for o in again[1::5]]
    return rows | {"website_sessions": sessions + more, "orders": orders + again}


@pytest.fixture(scope="module", params=["keys-7", "keys-11", "declared-7", "repeats-7", "repeats-13"])
def data(request, spark):
    kind, seed = request.param.split("-")
    rows = random_rows(int(seed))
    if kind == "repeats":
        rows = with_repeats(rows, int(seed))
    tables = Tables(**{n: spark.createDataFrame(r, TABLE_SCHEMAS[n]) for n, r in rows.items()})
    if kind == "declared":
        tables = tables.declare_unique()
    con = duckdb.connect()
    for name, r in rows.items():
        cols = [f.name for f in TABLE_SCHEMAS[name].fields]
        pdf = pd.DataFrame(r, columns=cols)
        con.register(f"_{name}", pdf)
        casts = []
        for f in TABLE_SCHEMAS[name].fields:
            typ = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}.get(
                f.dataType.simpleString(), f.dataType.simpleString().upper()
            )
            casts.append(f"CAST({f.name} AS {typ}) AS {f.name}")
        con.execute(f"CREATE TABLE {DUCK_NAMES.get(name, name)} AS SELECT {', '.join(casts)} FROM _{name}")
    return tables, con


NON_EMPTY: dict[str, int] = {}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_random_tables_match_relational_sql(data, name):
    tables, con = data
    df = OPERATORS[name](tables)
    srows = [tuple(r) for r in df.collect()]
    if any(v is not None for r in srows for v in r):
        NON_EMPTY[name] = NON_EMPTY.get(name, 0) + 1
    res = con.execute(table_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, res.fetchall())


def test_random_data_reaches_every_analysis():
    # runs after the parametrised cases (pytest keeps file order)
    assert sorted(NON_EMPTY) == sorted(OPERATORS)
