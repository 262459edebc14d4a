from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from shoplens.model import TABLE_SCHEMAS, Tables  # noqa: E402
from shoplens.session import checkpoint_dir, get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark(
        "local[4]",
        app="shoplens-tests",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="shoplens-test-wh-"),
        },
    )
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="shoplens-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def make_tables(spark):
    """Build a Tables object from small lists of tuples (missing tables are empty)."""

    def build(**rows) -> Tables:
        dfs = {}
        for name, schema in TABLE_SCHEMAS.items():
            dfs[name] = spark.createDataFrame(rows.get(name, []), schema)
        return Tables(**dfs)

    return build
