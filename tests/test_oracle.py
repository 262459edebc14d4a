"""Every registered query against its DuckDB oracle on the driver's data."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

from support import ROOT, SF_MID, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as E  # noqa: E402
from compare import TABLES, duck_type, rows_of  # noqa: E402

from shoplens.operators import OPERATORS  # noqa: E402


def _duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.fixture(scope="module")
def duck_small():
    return _duck(SF_SMALL)


def test_every_analysis_has_a_query_and_an_oracle():
    assert len(OPERATORS) == 34
    assert set(OPERATORS) <= set(E.queries()) and set(OPERATORS) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def _check(spark, con, sf_dir, name):
    df = E.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    dtypes = sorted(zip(dcols, [duck_type(d[1]) for d in res.description]))
    stypes = sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    assert stypes == dtypes
    assert rows_of(df.columns, srows) == rows_of(dcols, res.fetchall())


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_matches_oracle_sf0001(spark, duck_small, name):
    _check(spark, duck_small, SF_SMALL, name)


@pytest.fixture(scope="module")
def duck_mid():
    return _duck(SF_MID)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_matches_oracle_sf001(spark, duck_mid, name):
    _check(spark, duck_mid, SF_MID, name)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["utm_source", "utm_campaign", "http_referer", "sessions", "orders", "conv_rate"]
    assert df.count() > 0
