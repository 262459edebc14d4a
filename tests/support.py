"""Paths and small row builders shared by the tests."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def session_row(sid, created, user=1, repeat=0, source="gsearch", campaign="nonbrand", device="desktop",
                referer="https://www.gsearch.com"):
    return (sid, ts(created), user, repeat, source, campaign, device, referer)


def pv_row(pvid, created, sid, url):
    return (pvid, ts(created), sid, url)


def order_row(oid, created, sid, user=1, product=1, items=1, price="50.00", cogs="20.00"):
    return (oid, ts(created), sid, user, product, items, Decimal(price), Decimal(cogs))
