"""Whole-history session facts from stored partial states.

Some facts of a session have no time bound: its number of pageviews (bounces)
and its views of each page (funnels).  Counting them from raw pageviews reads
the history again for every analysis.  Here they are kept as mergeable partial
states, one row per month and session:

* ``n_views``: pageviews (non-NULL ids), merged by sum;
* ``first_pv_id``, ``landing_page``: the lowest pageview id and its URL, merged
  by ``min_by``;
* ``url_views``: views by URL, a map, merged by key-wise sums.

The states are stored by month.  New pageviews are reduced to states of their
own and appended: an append writes files of its own months only, and reads
nothing.  Several states of a session, from any number of months and appends,
are merged when they are read, by one grouped aggregate of partial results; each
analysis reads only the columns it needs.

Sessions without an id have no state: they join with nothing.  Views without a
URL or without a time count in ``n_views``; views without a time have no month and lie in a
partition of their own.  A state holds the URLs of one session's views in one
append, so a state is bounded by the pages of the site.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.exprs import MONTH, in_range
from shoplens.plans.session_facts import PVID, SID, URL

SCHEMA = f"{SID} long, n_views long, first_pv_id long, landing_page string, url_views map<string, long>, {MONTH} int"


def session_states(pageviews: DataFrame) -> DataFrame:
    """One state per month and session of ``pageviews``.

    Two aggregates, both partial before their exchange: views per (month,
    session, URL), and then the states; a session with very many views is one
    row per URL and task."""
    month = (F.year("created_at") * 100 + F.month("created_at")).cast("int").alias(MONTH)
    per_url = (
        pageviews.filter(F.col(SID).isNotNull())
        .groupBy(month, SID, URL)
        .agg(F.count(PVID).alias("n_ids"), F.count(F.lit(1)).alias("n_rows"), F.min(PVID).alias("pv"))
    )
    named = F.when(F.col(URL).isNotNull(), F.struct(F.col(URL).alias("key"), F.col("n_rows").alias("value")))
    return per_url.groupBy(MONTH, SID).agg(
        F.sum("n_ids").alias("n_views"),
        F.min("pv").alias("first_pv_id"),
        F.min_by(URL, "pv").alias("landing_page"),
        F.map_from_entries(F.collect_list(named)).alias("url_views"),
    ).select(SID, "n_views", "first_pv_id", "landing_page", "url_views", MONTH)


def append_states(pageviews: DataFrame, path: str) -> None:
    """Add the states of new ``pageviews`` below ``path``: one more file set in each of their months, nothing else."""
    states = session_states(pageviews).hint("rebalance", MONTH).sortWithinPartitions(MONTH, SID)
    states.write.mode("append").partitionBy(MONTH).parquet(path)


def write_states(pageviews: DataFrame, path: str) -> None:
    """Store the states of all ``pageviews`` at a new ``path``."""
    states = session_states(pageviews).hint("rebalance", MONTH).sortWithinPartitions(MONTH, SID)
    states.write.mode("errorifexists").partitionBy(MONTH).parquet(path)


@dataclass(frozen=True)
class SessionStates:
    """Stored states, merged per session on reading."""

    states: DataFrame

    @staticmethod
    def read(spark: SparkSession, path: str) -> "SessionStates":
        return SessionStates(spark.read.schema(SCHEMA).parquet(path))

    @staticmethod
    def of(pageviews: DataFrame) -> "SessionStates":
        """States that are not stored, made when they are read."""
        return SessionStates(session_states(pageviews))

    def view_counts(self) -> DataFrame:
        """Per session: number of pageviews of all time."""
        return self.states.groupBy(SID).agg(F.sum("n_views").alias("n_views"))

    def url_counts(self, steps: Mapping[str, str | Sequence[str]]) -> DataFrame:
        """Per session: views of each step URL (or URL set) of all time; sessions without any may be absent."""
        def views(urls: str | Sequence[str]):
            each = [F.coalesce(F.element_at("url_views", u), F.lit(0)) for u in ([urls] if isinstance(urls, str) else dict.fromkeys(urls))]
            return sum(each[1:], each[0])

        counts = {name: views(urls) for name, urls in steps.items()}
        any_step = sum(list(counts.values())[1:], list(counts.values())[0]) > 0
        return self.states.filter(any_step).groupBy(SID).agg(*[F.sum(c).alias(name) for name, c in counts.items()])

    def first_views(self, pageviews: DataFrame, before: str) -> DataFrame:
        """Per session: first pageview id and landing page before ``before``.

        Whole months come from the states, only the month of the bound from raw
        ``pageviews``; a view without a time is before nothing."""
        edge = before[:7] + "-01"
        whole = self.states.filter(F.col(MONTH) < int(before[:4]) * 100 + int(before[5:7]))
        rest = pageviews.filter(in_range(pageviews, from_=edge, before=before))
        rows = whole.select(SID, "first_pv_id", "landing_page").unionByName(
            rest.filter(F.col(SID).isNotNull()).select(SID, F.col(PVID).alias("first_pv_id"), F.col(URL).alias("landing_page"))
        )
        return rows.groupBy(SID).agg(F.min("first_pv_id").alias("first_pv_id"), F.min_by("landing_page", "first_pv_id").alias("landing_page"))
