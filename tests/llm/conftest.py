"""Spark session and small document tables for the corpus operators."""

from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark: SparkSession):
    def make(texts, extra: str = "", parts: int = 3):
        """Documents 0, 1, ... with the given texts; ``extra`` adds constant columns with clashing names."""
        rows = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, DOC_SCHEMA)
        for name in extra.split():
            df = df.selectExpr("*", f"'x' as `{name}`")
        return df.repartition(parts) if rows else df

    return make
