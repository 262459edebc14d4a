"""Reading and writing the five tables.

``read_tables`` opens an existing five-table layout (Parquet folders or
catalog tables).  ``from_driver_dir`` derives the tables from the driver's
``events``/``part`` Parquet files.  ``write_tables`` stores a layout for
repeated use; ``write_bucketed_tables`` buckets pageviews, sessions and
orders by ``website_session_id`` so that the session-keyed joins and
aggregations of the analyses read co-partitioned data without a shuffle.

Keys: the writers store which primary keys are declared unique
(``Tables.unique``) as metadata of the key column, and the readers restore it.
A reader can also be told which keys to check and declare.

URLs: the writers store the dictionary of the pageviews' URLs as a sixth table,
``pageview_urls``; the readers attach it where it exists.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.exprs import MONTH
from shoplens.model import PRIMARY_KEYS, TABLE_SCHEMAS, Tables
from shoplens.plans.session_facts import URL
from shoplens.plans.urls import SCHEMA as URLS_SCHEMA
from shoplens.plans.urls import check_dictionary, url_dictionary
from shoplens.sources.fixture import derive_tables

# bucket key per table: the session key for the web tables and orders, the
# item key for items and refunds (the only join those two take part in)
BUCKET_KEYS = {
    "website_sessions": "website_session_id",
    "website_pageviews": "website_session_id",
    "orders": "website_session_id",
    "order_items": "order_item_id",
    "order_item_refunds": "order_item_id",
}


_UNIQUE = "unique"


def _is_marked(df: DataFrame, name: str) -> bool:
    return name in PRIMARY_KEYS and bool(df.schema[PRIMARY_KEYS[name]].metadata.get(_UNIQUE))


def _marked(df: DataFrame, name: str, unique: Iterable[str]) -> DataFrame:
    """``df`` with its key's constraint in the column metadata, which Parquet and the catalog keep."""
    key = PRIMARY_KEYS.get(name)
    return df.withMetadata(key, {_UNIQUE: name in unique}) if key else df


def _as_tables(dfs: Mapping[str, DataFrame], unique: Iterable[str] | None) -> Tables:
    tables = Tables(**dfs).validate()
    if unique is not None:
        return tables.declare_unique(unique)
    return tables.declare_unique([n for n, df in dfs.items() if _is_marked(df, n)], check=False)


def _folder(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One stored table.  A table without rows that was stored by month has no file to tell its columns."""
    try:
        return spark.read.parquet(os.path.join(path, name))
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.read.schema(TABLE_SCHEMAS[name]).parquet(os.path.join(path, name))


#: Name of the stored URL dictionary.
URLS = "pageview_urls"


def _stored_urls(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(URLS_SCHEMA).parquet(os.path.join(path, URLS))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _write_urls(tables: Tables, path: str, mode: str, known: DataFrame | None = None) -> None:
    """Store the URLs of the pageviews, without those ``known`` already, and check the whole dictionary."""
    urls = url_dictionary(tables.P)
    if known is not None:
        urls = urls.join(known.select(URL), URL, "left_anti").select("url_key", URL)
    urls.write.mode(mode).parquet(os.path.join(path, URLS))
    check_dictionary(_stored_urls(tables.P.sparkSession, path))


def read_parquet_tables(spark: SparkSession, path: str, *, unique: Iterable[str] | None = None) -> Tables:
    """Five Parquet folders ``<path>/<table name>``.

    By default the keys that the writer declared are taken over.  ``unique``
    names the tables whose keys to check now and declare (none: an empty list);
    a key that does not hold raises ``ValueError``."""
    tables = _as_tables({name: _folder(spark, path, name) for name in TABLE_SCHEMAS}, unique)
    return replace(tables, urls=_stored_urls(spark, path))


def _qualified(spark: SparkSession, database: str | None, name: str) -> str:
    # always qualify: an unqualified name would resolve to a temporary view of
    # the same name first (see shoplens.sql.register_sql)
    return f"{database or spark.catalog.currentDatabase()}.{name}"


def read_catalog_tables(
    spark: SparkSession, database: str | None = None, *, unique: Iterable[str] | None = None
) -> Tables:
    """Five tables registered in the session catalog (current database by
    default); ``unique`` as for ``read_parquet_tables``."""
    tables = _as_tables({name: spark.table(_qualified(spark, database, name)) for name in TABLE_SCHEMAS}, unique)
    urls = _qualified(spark, database, URLS)
    return replace(tables, urls=spark.table(urls) if spark.catalog.tableExists(urls) else None)


def from_driver_dir(spark: SparkSession, sf_dir: str) -> Tables:
    """Derive the five tables from ``<sf_dir>/events.parquet`` and ``part.parquet``.

    Their keys are unique by construction: ids of events, one row per group of
    events, and one per slot of an order."""
    events = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    part = spark.read.parquet(os.path.join(sf_dir, "part.parquet"))
    return derive_tables(events, part).declare_unique(check=False)


def _month_of(ts: str) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def write_parquet_tables(tables: Tables, path: str, *, mode: str = "errorifexists", by_month: bool = True) -> None:
    """Plain Parquet layout.  Tables with a time are stored by month
    (``created_month=yyyymm`` folders), so that an analysis opens the files of
    its own months only; inside a file rows are sorted by time, so that min/max
    statistics prune row groups as well.

    Rows are rebalanced by month before the write: a large month is written by
    several tasks, and no task writes a file for every month.

    With ``mode="append"``, a key that the stored table declares must hold over
    old and new rows together: that is checked before anything is written."""
    unique = _appendable(tables, path) if mode == "append" else tables.unique
    known = _stored_urls(tables.P.sparkSession, path) if mode == "append" else None
    _write_urls(tables, path, mode, known)
    for name, df in tables.as_dict().items():
        df = _marked(df, name, unique)
        if not (by_month and "created_at" in df.columns):
            out = df.sortWithinPartitions("created_at") if "created_at" in df.columns else df
            out.write.mode(mode).parquet(os.path.join(path, name))
            continue
        out = df.withColumn(MONTH, _month_of("created_at")).hint("rebalance", MONTH).sortWithinPartitions(MONTH, "created_at")
        out.write.mode(mode).partitionBy(MONTH).parquet(os.path.join(path, name))


def _appendable(tables: Tables, path: str) -> set[str]:
    """The keys that stored and new rows declare, checked over both."""
    spark = tables.S.sparkSession
    both, declared = {}, set()
    for name, df in tables.as_dict().items():
        old = _folder(spark, path, name)
        both[name] = old.drop(MONTH).unionByName(df.drop(MONTH))
        if _is_marked(old, name):
            declared.add(name)
    Tables(**both).declare_unique(declared)
    return declared


def bucket_skew(df: DataFrame, key: str, buckets: int) -> tuple[float, int]:
    """How unevenly ``df`` would fill ``buckets`` buckets on ``key``:
    ``(largest bucket / mean bucket, rows of the largest bucket)``.

    The bucket id is the one Spark's bucketed writer uses
    (``pmod(murmur3(key), buckets)``).  Spark counts rows per bucket with a
    partially aggregated group-by; the driver receives one row."""
    per_bucket = df.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")).count()
    row = per_bucket.agg(F.max("count").alias("top"), F.sum("count").alias("total")).first()
    top, total = int(row["top"] or 0), int(row["total"] or 0)
    return (top * buckets / total if total else 0.0), top


def write_bucketed_tables(
    spark: SparkSession,
    tables: Tables,
    path: str,
    *,
    buckets: int,
    database: str | None = None,
    mode: str = "errorifexists",
    layout: Mapping[str, str] | None = None,
    by_month: bool = False,
) -> Tables:
    """Catalog tables at ``path``, bucketed with one bucket count: sessions,
    pageviews and orders by ``website_session_id``, items and refunds by
    ``order_item_id``, so the joins and groupings on those keys need no
    exchange.

    Rows are hash-partitioned on the bucket key first, so each bucket is
    written by one task as one file (no tasks x buckets small files), and each
    bucket file is sorted by ``created_at`` so Parquet min/max statistics still
    skip row groups outside an analysis' time window.

    A bucket is read by one task, so a hot session makes one task read its
    whole bucket.  ``bucket_skew`` measures that; where it matters, the caller
    states ``layout={"website_pageviews": "plain"}``.  A plain table's
    session-keyed aggregates run as on plain Parquet: partial aggregation per
    map task, then a shuffle of one row per session per task, whatever the
    session's size.  The layout never depends on the data.

    ``by_month`` stores tables with a time by month as well, with the buckets
    inside each month: a window opens the files of its own months only, and the
    session-keyed joins still need no exchange.  A bucket then is a file per
    month, so this is for tables whose months fill their buckets (at least a
    few MB a file: choose fewer buckets otherwise)."""
    layout = dict(layout or {})
    unknown = set(layout) - set(BUCKET_KEYS) | {v for v in layout.values() if v not in ("plain", "bucketed")}
    if unknown:
        raise ValueError(f"unknown table or layout: {sorted(unknown)}")
    for name, df in tables.as_dict().items():
        df = _marked(df.drop(MONTH), name, tables.unique)
        key = BUCKET_KEYS[name]
        months = by_month and "created_at" in df.columns
        if months:
            df = df.withColumn(MONTH, _month_of("created_at"))
        sort_col = "created_at" if "created_at" in df.columns else key
        if layout.get(name) == "plain":
            # rebalance: AQE cuts the rows into advisory-size files, splitting
            # any partition the input's own layout made skewed
            spread = df.hint("rebalance", MONTH) if months else df.hint("rebalance")
            w = spread.sortWithinPartitions(*[MONTH] * months, sort_col).write.mode(mode).format("parquet")
        else:
            w = (
                df.repartition(buckets, key)
                .write.mode(mode)
                .format("parquet")
                .bucketBy(buckets, key)
                .sortBy(sort_col)
            )
        w = w.partitionBy(MONTH) if months else w
        w.option("path", os.path.join(path, name)).saveAsTable(_qualified(spark, database, name))
    w = url_dictionary(tables.P).write.mode(mode).format("parquet").option("path", os.path.join(path, URLS))
    w.saveAsTable(_qualified(spark, database, URLS))
    check_dictionary(spark.table(_qualified(spark, database, URLS)))
    return read_catalog_tables(spark, database)
