"""Helpers shared by the corpus operators: shared storage, words and shingles.

Words are maximal runs of characters other than the six ASCII white-space
characters (space, tab to carriage return).  A text of at least five words has
one shingle per five consecutive words; a shorter non-empty text is one
shingle of all its words; a null or empty text has none.  Shingles are 64-bit
hashes; two different shingles of a corpus collide with a chance of 2^-64 per
pair.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
SIMILARITY = 0.8

#: Rows and bytes per Arrow batch between Spark and Python: whole texts can be long.
BATCH_ROWS, BATCH_BYTES = 10_000, 8 << 20

_MULT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path under the folder that driver and executors share (``spark.checkpoint.dir``).

    Only where that setting is absent, as in tests, a temporary folder is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs no recomputation of what is
    stored, and side results are computed once.  zstd, which keeps native
    buffers until the JVM happens to collect its garbage, is for large tables.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def small_batches(spark: SparkSession) -> None:
    """Prepare a session for Python stages: bounded Arrow batches, and this package on the executors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        to = Path(tempfile.mkdtemp(prefix="llm-ship-")) / f"{package.name}.zip"
        with zipfile.ZipFile(to, "w") as out:
            for f in sorted(package.rglob("*.py")):
                out.write(f, f.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(to))  # Spark's own file server hands it to every executor
        _shipped.add(app)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc32_of(col) -> F.Column:
    """CRC-32 of a value's text form; null counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def power(name: str, n: int) -> np.ndarray:
    """The first ``n`` powers modulo 2^64 of the hashes' base (up) or of its inverse (down), remembered within one Python worker."""
    have = _powers[name]
    if len(have) < n:
        steps = np.full(max(n, 1 << 16), _MULT if name == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        have = _powers[name] = np.multiply.accumulate(steps)
    return have[:n]


def word_hashes(text: str | None) -> np.ndarray:
    """uint64 hash of each word of ``text``, in order.

    A polynomial hash of a word's UTF-8 bytes modulo 2^64: with prefix sums
    over the text, all words are hashed at once.
    """
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = len(data)
    inside = np.zeros(n + 2, bool)
    np.logical_not(_SPACE[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[0::2], edges[1::2]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * power("up", n), out=sums[1:])
    return mix((sums[end] - sums[start]) * power("down", n + 1)[start] + (end - start).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random-looking number per byte value.
_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


def shingles(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """uint64 shingle hashes of ``text`` in order of position (repeats kept)."""
    h = word_hashes(text)
    if not len(h):
        return h
    w = min(words, len(h))
    n = len(h) - w + 1
    x = np.zeros(n, np.uint64)
    for k in range(w):
        x = x * _MULT + h[k : k + n]
    return mix(x + np.uint64(w))


def batches_of(rows: Iterator, size: int) -> Iterator[list]:
    """Lists of up to ``size`` items."""
    out: list = []
    for row in rows:
        out.append(row)
        if len(out) >= size:
            yield out
            out = []
    if out:
        yield out


def sorted_groups(batches: Iterator, key: int = 0) -> Iterator[list]:
    """Columns (as pyarrow arrays) of each run of equal values in integer column ``key``; a run may span batches."""
    import pyarrow as pa

    held: list = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(values[1:] != values[:-1]) + 1
        bounds = [0, *edges.tolist(), len(values)]
        for a, b in zip(bounds, bounds[1:]):
            if held and values[a] != last:
                yield _whole(pa, held)
                held = []
            held.append(batch.slice(a, b - a))
            last = values[a]
    if held:
        yield _whole(pa, held)


def _whole(pa, parts: list) -> list:
    if len(parts) == 1:
        return parts[0].columns
    return [c.combine_chunks() for c in pa.Table.from_batches(parts).columns]


def local_labels(links: np.ndarray) -> np.ndarray:
    """Connected components of a symmetric boolean matrix: the least index reachable from each index."""
    n = len(links)
    labels = np.full(n, -1)
    for start in range(n):
        if labels[start] >= 0:
            continue
        labels[start] = start
        front = np.array([start])
        while len(front):
            front = np.flatnonzero(links[front].any(axis=0) & (labels < 0))
            labels[front] = start
    return labels


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b): label is the least node of its component.

    Alternating large-star and small-star rounds until the edges no longer
    change.  Each round is stored; nodes and edges stay in Spark.  The least
    neighbours of the large-star step are stored as well: their join with the
    edges then shuffles both sides, so that Spark can split the edges of a node
    that has very many.
    """

    def ordered(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()

    now = stored(ordered(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), name)
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), f"{name}-large")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
        after = stored(ordered(small), name)
        new = _mark(after)
        now = after
        if new == mark:
            break
        mark = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _mark(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(F.xxhash64("u", "v"), 24)).alias("h")).first()
    return r.n, r.h or 0
