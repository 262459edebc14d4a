"""shoplens: e-commerce clickstream analytics on Spark DataFrames."""

from shoplens.model import Tables  # noqa: F401
