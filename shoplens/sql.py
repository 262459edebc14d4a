"""SQL access to the five tables.

``register_sql`` exposes a ``Tables`` object to Spark SQL: one temporary view
per table under its usual name, plus the date function of the original SQL
dialect that Spark lacks, so reports written as SQL run against the same
data as the DataFrame analyses.  The function is a SQL-bodied temporary
function; Catalyst inlines it, so it stays inside whole-stage codegen.

Dialect notes for SQL carried over from the original engine: Spark writes
temporary tables as ``CREATE TEMPORARY VIEW t AS SELECT ...``, comments as
``--``, and (in ANSI mode) raises on ``x / 0`` - use ``try_divide`` for the
NULL the original engine returned.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from shoplens.model import Tables

# week(ts): Sunday-first week of the year, 0..53, week 1 starting on the
# year's first Sunday (default mode of the original dialect); no year part.
WEEK_FUNCTION = """
CREATE OR REPLACE TEMPORARY FUNCTION week(ts TIMESTAMP_NTZ) RETURNS INT
RETURN CAST(floor((dayofyear(ts) + 7 - dayofweek(ts)) / 7) AS INT)
"""


def register_functions(spark: SparkSession) -> None:
    """Register the dialect functions Spark has no built-in for (``week``)."""
    spark.sql(WEEK_FUNCTION)


def register_sql(spark: SparkSession, tables: Tables) -> None:
    """Temporary views ``website_sessions``, ``website_pageviews``, ``orders``,
    ``order_items``, ``order_item_refunds`` and the dialect functions."""
    for name, df in tables.as_dict().items():
        df.createOrReplaceTempView(name)
    register_functions(spark)
