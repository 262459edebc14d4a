"""Chosen-path similarity join over word shingles.

Sets of five-word shingles with a Jaccard similarity of at least 0.8 are
linked.  Texts with equal sets count as one set.  A set's signature holds, for
each of 64 random orders, the shingle that comes first.

Chosen paths: in each run a set starts at the root and is passed on to the
children of the tokens that its node samples (one token, or two with a chance
that makes 1/0.8 on average); sets that share a sampled token meet in a child.
Children of at most ``LEAF`` sets are compared by brute force on signatures,
larger ones are split again on further sampled tokens, and what is still large
after ``DEPTH`` levels is compared in pairs of blocks, so that no task holds an
unbounded bucket.  Runs are repeated until a pair at the threshold is met with
probability ``RECALL``.

Signature matches (a similarity estimate of at least ``ESTIMATE``) only bring
sets together: within each connected component of matches every pair is
verified on whole shingle sets, in blocks, and links and classes come from
verified pairs alone.

Defined cases: null, empty and blank texts have no shingles, link to nothing
and are classes of their own; a text of fewer than five words is one shingle;
repeated rows and null ids are kept; an empty table gives no rows; further
columns are ignored.  A class's id is its least document id.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import SIMILARITY, components, local_labels, mix, shingles, small_batches, sorted_groups, stored

ORDERS = 64
RECALL = 0.999
LEAF = 256
DEPTH = 4
#: A pair at the threshold reaches this share of equal signature entries but for a chance of 4 in 10,000.
ESTIMATE = 0.64
#: Shingles and sets of a block of a component in verification.
BLOCK_SHINGLES, BLOCK_SETS = 1 << 18, 256
_SEEDS = mix(np.arange(1, ORDERS + 1, dtype=np.uint64))


def runs_needed(recall: float = RECALL, similarity: float = SIMILARITY, depth: int = DEPTH) -> int:
    """Runs until a pair at the threshold has met with the given probability, at the greatest depth."""
    extra, meet = 1 / similarity - 1, 1.0
    for _ in range(depth):
        miss = 1 - similarity * meet
        meet = 1 - miss * (1 - extra + extra * miss)
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def signature(tokens: np.ndarray) -> np.ndarray:
    """The first token of the set in each of the random orders, as 32-bit marks."""
    out = np.empty(ORDERS, np.uint64)
    for k, seed in enumerate(_SEEDS):
        # an odd multiplier and a xor-shift order the tokens anew
        x = (tokens ^ seed) * np.uint64(0xD6E8FEB86659FD93)
        out[k] = (x ^ (x >> np.uint64(32))).min()
    return (mix(out) >> np.uint64(32)).astype("<u4")


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, set_key, n, signature); without shingles the last three are null."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, marks = [], [], []
            for text in batch.column(2).to_pylist():
                tokens = np.unique(shingles(text))
                if len(tokens):
                    keys.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                    sizes.append(len(tokens))
                    marks.append(signature(tokens).tobytes())
                else:
                    keys.append(None)
                    sizes.append(None)
                    marks.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(marks, pa.binary())], ["doc_id", "text_key", "set_key", "n", "signature"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key binary, set_key binary, n int, signature binary")


def text_key(text) -> F.Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def _children(paths: np.ndarray, marks: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child path) of the tokens that each row's node samples."""
    draw = mix(paths)
    rows, out = [], []
    extra = np.uint64(int((1 / similarity - 1) * 2**32))
    for k in range(2):
        chosen = np.arange(len(paths)) if k == 0 else np.flatnonzero((draw >> np.uint64(32)) < extra)
        order = (mix(draw[chosen] + np.uint64(k)) % np.uint64(ORDERS)).astype(np.int64)
        token = marks[chosen, order].astype(np.uint64)
        rows.append(chosen)
        out.append(mix(mix(paths[chosen] + np.uint64(17 * k + 1)) ^ (token << np.uint64(8)) ^ order.astype(np.uint64)))
    return np.concatenate(rows), np.concatenate(out)


def _split(sets: DataFrame, similarity: float, runs: int | None = None) -> DataFrame:
    """(path, set_key): each set in the children of its node, or with ``runs`` in the first children of each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            marks = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(n, ORDERS)
            for r in range(runs or 1):
                nodes = np.full(n, mix(np.array([r + 1], np.uint64))[0]) if runs else batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
                rows, paths = _children(nodes, marks, similarity)
                yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), batch.column(0).take(pa.array(rows))], ["path", "set_key"])

    columns = ["set_key", "signature"] if runs else ["set_key", "signature", "path"]
    return sets.select(*columns).mapInArrow(run, "path long, set_key binary")


def buckets(sets: DataFrame, similarity: float = SIMILARITY, runs: int | None = None, leaf: int = LEAF, depth: int = DEPTH) -> DataFrame:
    """(bucket, set_key): the small buckets, and pairs of blocks of those that stayed large."""
    runs = runs or runs_needed(similarity=similarity, depth=depth)
    marks = sets.select("set_key", "signature")
    found, level = [], _split(sets, similarity, runs)
    for d in range(1, depth + 1):
        level = stored(level, f"paths-{d}")
        sizes = level.groupBy("path").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        met = stored(level.join(sizes, "path"), f"met-{d}")
        found.append(met.filter(F.col("size") <= leaf).select(F.col("path").alias("bucket"), "set_key"))
        large = met.filter(F.col("size") > leaf)
        if large.isEmpty():
            break
        if d < depth:
            level = _split(large.select("path", "set_key").join(marks, "set_key"), similarity)
            continue
        blocks = F.ceil(F.col("size") / leaf).cast("int")
        own = F.pmod(F.xxhash64("set_key"), blocks).cast("int")
        other = F.explode(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("own")))
        paired = large.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", other)
        found.append(paired.select(F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"), "set_key"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def matches(found: DataFrame, sets: DataFrame, estimate: float = ESTIMATE) -> DataFrame:
    """(a, b): enough pairs of matching signatures to connect what matches within each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, keys, marks in sorted_groups(batches):
            n = len(keys)
            if n < 2:
                continue
            m = np.frombuffer(b"".join(marks.to_pylist()), "<u4").reshape(n, ORDERS)
            links = np.zeros((n, n), bool)
            for i in range(n):
                links[i] = (m == m[i]).sum(axis=1) >= estimate * ORDERS
            labels = local_labels(links)
            rows = np.flatnonzero(labels != np.arange(n))
            if len(rows):
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(rows)), keys.take(pa.array(labels[rows]))], ["a", "b"])

    rows = found.join(sets.select("set_key", "signature"), "set_key").select("bucket", "set_key", "signature")
    rows = rows.repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(run, "a binary, b binary").distinct()


def similar(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Symmetric boolean matrix of the pairs whose exact Jaccard similarity reaches the threshold."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    if n <= 6:
        shared = np.zeros((n, n))
        for i in range(n):
            for j in range(i):
                shared[i, j] = shared[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        shared = np.zeros((n, n), np.float32)
        owner = np.repeat(np.arange(n), sizes)
        _, token, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        common = counts[token] > 1
        owner, token = owner[common], token[common]
        number = np.cumsum(counts > 1) - 1
        token = number[token]
        width = int((counts > 1).sum())
        order = np.argsort(token, kind="stable")
        owner, token = owner[order], token[order]
        for at in range(0, width, 4096):  # a slice of the tokens at a time
            a, b = np.searchsorted(token, [at, at + 4096])
            has = np.zeros((n, min(4096, width - at)), np.float32)
            has[owner[a:b], token[a:b] - at] = 1
            shared += has @ has.T
    union = sizes[:, None] + sizes[None, :] - shared
    out = shared >= similarity * union - 1e-6
    np.fill_diagonal(out, False)
    return out


def verified(candidates: DataFrame, sets: DataFrame, docs: DataFrame, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(a, b, links): per set and block pair its verified links, counted in texts, and a set that it is connected with."""
    members = components(candidates, "candidates").select(F.col("node").alias("set_key"), F.col("label").alias("part"))
    members = members.join(sets.drop("signature"), "set_key")
    load = members.groupBy("part").agg(F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_SETS)).cast("int").alias("blocks"))
    members = members.join(load, "part")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    first = (F.col("d.text_key") == F.col("m.text_key")) & F.col("d.doc_id").eqNullSafe(F.col("m.doc_id"))
    rows = texts.alias("d").join(members.alias("m"), first).select("set_key", "text", "n_texts", "part", "blocks")
    own = F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int")
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("own")))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(others))
    group = F.xxhash64("part", F.least("own", "other"), F.greatest("own", "other"))
    # pairs within a block are counted with the next block only
    counts = (F.col("other") == F.pmod(F.col("own") + 1, F.col("blocks"))).alias("counts")
    rows = rows.select(group.alias("g"), "set_key", "text", "n_texts", "own", counts)
    rows = rows.repartition("g").sortWithinPartitions("g", "set_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, keys, texts, weights, own, counts in sorted_groups(batches):
            names = keys.to_pylist()
            at = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]]  # repeated rows of one text
            take = pa.array(at)
            own = own.take(take).to_numpy()
            links = similar([np.unique(shingles(t)) for t in texts.take(take).to_pylist()], similarity)
            labels = local_labels(links)
            weight = weights.take(take).to_numpy()
            cross = own[:, None] != own[None, :]
            tally = links & (cross | counts.take(take).to_numpy(zero_copy_only=False)[:, None])
            sums = (tally * weight[None, :]).sum(axis=1)
            keys = keys.take(take)
            yield pa.RecordBatch.from_arrays([keys, keys.take(pa.array(labels)), pa.array(sums.astype(np.int64))], ["a", "b", "links"])

    return rows.mapInArrow(run, "a binary, b binary, links long")


def similarity_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, recall: float = RECALL, leaf: int = LEAF, depth: int = DEPTH) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies, text_key): one row per input row.

    ``n_links`` counts the other texts that the row's text is linked with,
    ``n_copies`` the rows of its shingle set, ``class_id`` the connected
    component of links, ``text_key`` the text's MD5.
    """
    rows = stored(signatures(docs, id_col, text_col), "signatures")
    texts = rows.filter("n is not null").groupBy("set_key", "text_key").agg(F.first("n").alias("n"), F.first("signature").alias("signature"), F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows"))
    one = F.min(F.struct("text_key", "doc_id"))
    sets = texts.groupBy("set_key").agg(F.first("n").alias("n"), F.first("signature").alias("signature"), one.alias("one"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n_texts"), F.sum("rows").alias("n_copies"))
    sets = stored(sets.select("set_key", "n", "signature", "one.text_key", "one.doc_id", "least_id", "n_texts", "n_copies"), "sets")
    found = buckets(sets, similarity, runs_needed(recall, similarity, depth), leaf, depth)
    pairs = stored(verified(matches(found, sets), sets, docs, similarity, id_col, text_col), "verified")
    links = pairs.groupBy("a").agg(F.sum("links").alias("links"))
    labels = components(pairs.select("a", "b"), "classes")
    classes = sets.select("set_key", "least_id", "n_texts", "n_copies").join(labels.withColumnRenamed("node", "set_key"), "set_key", "left").withColumn("label", F.coalesce("label", "set_key"))
    least = classes.groupBy("label").agg(F.min("least_id").alias("class_id"))
    classes = classes.join(least, "label").join(links.withColumnRenamed("a", "set_key"), "set_key", "left")
    classes = classes.select("set_key", "class_id", (F.coalesce("links", F.lit(0)) + F.col("n_texts") - 1).alias("n_links"), "n_copies")
    out = rows.select("doc_id", "text_key", "set_key").join(classes, "set_key", "left")
    return out.select("doc_id", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"), "text_key")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that are the least document of their class, as they are.

    Of repeated rows (equal id and text) one stays.  Rows without an id cannot
    be told apart by it: they stay but for equal texts, unless their class has
    a row with an id.
    """
    classes = similarity_join(docs, id_col, text_col, similarity)
    stay = classes.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    kept = docs.join(stay, F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (text_key(F.col(text_col)) == F.col("_key")), "left_semi")
    return kept.dropDuplicates([id_col, text_col])
