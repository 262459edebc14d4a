"""The explicit semi-join reducer: equal results, few rows left before the exchange."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from support import SF_MID, SF_SMALL

from shoplens.operators import OPERATORS
from shoplens.plans.reducer import Reducer
from shoplens.sources import from_driver_dir


@pytest.fixture(scope="module")
def tables(spark):
    t = from_driver_dir(spark, SF_SMALL)
    return replace(t, **{name: df.cache() for name, df in t.as_dict().items()})


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_results_are_equal(tables, name):
    got, want = OPERATORS[name](replace(tables, reducer=Reducer())).collect(), OPERATORS[name](tables).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_few_rows_of_other_sessions_are_left(spark):
    """The rows that go on to the exchange: all of the window's sessions, and about two in a hundred of the others."""
    p = from_driver_dir(spark, SF_MID).P.cache()
    some = p.filter("website_session_id % 50 = 0").select("website_session_id").distinct()
    left = Reducer().reduce(p, some)
    assert left.columns == p.columns
    wanted = p.join(some, "website_session_id", "left_semi").count()
    others = left.count() - wanted
    assert left.join(some, "website_session_id", "left_semi").count() == wanted
    assert 0 <= others < 0.05 * p.count()
    plan = left.groupBy("website_session_id").count()._jdf.queryExecution().executedPlan().toString()
    facts = plan.split("Exchange hashpartitioning(website_session_id")[1]
    assert "BroadcastHashJoin" in facts and "Python" not in plan


def test_too_many_ids_build_no_filter(spark):
    facts = spark.range(1000).withColumnRenamed("id", "website_session_id")
    assert Reducer(max_keys=999).reduce(facts, facts) is facts
    assert Reducer(max_keys=1000).reduce(facts, facts).count() == 1000


def test_null_negative_and_no_ids(spark):
    facts = spark.createDataFrame([(None,), (-1,), (-(2**63),), (2**63 - 1,), (0,)], "website_session_id long")
    assert Reducer().reduce(facts, facts).count() == 4
    assert Reducer().reduce(facts, facts.limit(0)).count() == 0
    assert Reducer().reduce(facts.limit(0), facts).count() == 0
    some = facts.filter(F.col("website_session_id") < 0)
    assert Reducer().reduce(some, some).count() == 2
