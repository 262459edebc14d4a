"""Columns for values that are found in the data."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Most columns a pivot may make: a plan with more is unlikely to be meant.
MAX_VALUES = 200


def found_values(df: DataFrame, column: str, limit: int = MAX_VALUES) -> list:
    """The distinct non-NULL values of ``column``, in order.

    Spark finds them with one partially aggregated pass and hands the driver at
    most ``limit`` + 1 of them; more than ``limit`` values raise, none is dropped."""
    values = df.select(column).filter(df[column].isNotNull()).distinct().orderBy(column).limit(limit + 1).collect()
    if len(values) > limit:
        raise ValueError(f"{column} has more than {limit} values: name those to make columns for")
    return [r[0] for r in values]
