"""Funnel steps split by any tag of a session."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.model import Tables
from shoplens.plans.session_facts import SID, URL, url_counts

#: Number of tagged rows of a session: the joined rows that each of its views counts in.
WEIGHT = "weight"


def session_tags(rows: DataFrame, **tags: Column) -> DataFrame:
    """(session, tags, weight): how many of ``rows`` each session has of each
    combination of tags, as rows rather than a column per value, so any number
    of devices, sources or pages fits one plan."""
    return rows.groupBy(SID, *[c.alias(name) for name, c in tags.items()]).agg(F.count(F.lit(1)).alias(WEIGHT))


def session_steps(t: Tables, tagged: DataFrame, steps: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """``tagged`` (see ``session_tags``) with the views of all time of each step
    in its session, 0 without any."""
    counts = t.states.url_counts(steps) if t.states else url_counts(t.of_sessions(t.P, tagged), steps)
    return tagged.join(counts, SID, "left").select(*tagged.columns, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in steps])


def step_totals(steps: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Per tag combination: sessions, and each step's views summed over the
    joined rows (views times weight)."""
    totals = [F.sum(F.col(WEIGHT) * F.col(n)).cast("long").alias(n) for n in names]
    return steps.groupBy(*by).agg(F.count(SID).alias("sessions"), *totals)


def tag_of_url(pages: Mapping[str, str]) -> Column:
    """The name of a view's page, among ``{name: url}``; NULL for other pages."""
    out = F.lit(None).cast("string")
    for name, url in reversed(pages.items()):
        out = F.when(F.col(URL) == url, F.lit(name)).otherwise(out)
    return out
