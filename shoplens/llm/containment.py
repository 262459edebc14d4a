"""Benchmark decontamination by size-partitioned MinHash containment search.

Short test items are searched inside long documents.  Plain MinHash fails
there, since the Jaccard similarity of an item and a long document is tiny, so
both sides are partitioned by size: items go to classes of up to ``U`` = 2, 4, 8,
16, ... shingles, and for each class a document is covered by windows of 1.5 U
shingles, half a U apart.  A copied item lies inside one window, where an item
of which 0.8 is contained has a similarity of at least 0.25, and one of
``ORDERS`` min-hashes agrees but for a chance of 1 in 10,000 (an item copied in
two separate halves, of 1 in 1,000).  A window's min-hashes are minima of chunk
minima, so all classes share one pass over the document.  Any agreement makes
a candidate, verified by the exact share of the item's shingles that the whole
document contains.

The index of the items is broadcast in blocks of at most ``BLOCK_BYTES`` of
item text, and every block is held against all documents: memory is bounded
whatever the size of the benchmark, and documents are never shuffled.

Defined cases: a null, empty or blank document or item matches nothing; an
item of fewer than five words is one shingle and matches documents of just
these words; repeated rows on either side give a row each; an empty benchmark
leaves every document clean; further columns are ignored or, in
``decontaminate``, kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import SIMILARITY, mix, shingles, small_batches

ORDERS = 32
#: Item text in one broadcast index; an index takes about 60 bytes per byte of text.
BLOCK_BYTES = 2 << 20
#: Shingles of a document that are looked at together; longer ones go in overlapping segments.
SEGMENT = 1 << 16

_SEEDS = mix(np.arange(101, 101 + ORDERS, dtype=np.uint64))[:, None]
_FILTER_BITS = 18


def _hashed(tokens: np.ndarray) -> np.ndarray:
    """(orders, tokens): the rank of each token in each random order."""
    x = (tokens[None, :] ^ _SEEDS) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Index:
    """Min-hashes of items by size class, and the items' shingles."""

    def __init__(self, items: list[tuple[int | None, str | None]], containment: float = SIMILARITY) -> None:
        self.containment = containment
        self.ids, self.sets = [], []
        for item_id, text in items:
            tokens = np.unique(shingles(text))
            if len(tokens):
                self.ids.append(item_id)
                self.sets.append(tokens)
        by_class: dict[int, list[int]] = {}
        for i, tokens in enumerate(self.sets):
            size = 2
            while size < len(tokens):
                size *= 2
            by_class.setdefault(size, []).append(i)
        self.classes = []
        for size, members in sorted(by_class.items()):
            keys = np.concatenate([_hashed(self.sets[i]).min(axis=1) for i in members])
            owner = np.repeat(np.array(members), ORDERS)
            order = np.argsort(keys, kind="stable")
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[keys & np.uint64((1 << _FILTER_BITS) - 1)] = True
            self.classes.append((size, keys[order], owner[order], seen))

    def candidates(self, tokens: np.ndarray) -> set[int]:
        """Items that share a min-hash with some window of their class."""
        overlap = 2 * self.classes[-1][0]
        found: set[int] = set()
        for at in range(0, max(1, len(tokens) - overlap), SEGMENT):
            found |= self._segment(tokens[at : at + SEGMENT + overlap])
        return found

    def _segment(self, tokens: np.ndarray) -> set[int]:
        found: set[int] = set()
        chunk, low = 1, _hashed(tokens)
        for size, keys, owner, seen in self.classes:
            if (grow := size // 2 // chunk) > 1:
                low = np.minimum.reduceat(low, np.arange(0, low.shape[1], grow), axis=1)
                chunk *= grow
            window = low.copy()
            for k in (1, 2):  # three neighbouring chunks
                np.minimum(window[:, :-k], low[:, k:], out=window[:, :-k])
            values = window[seen[window & np.uint64((1 << _FILTER_BITS) - 1)]]
            if len(values):
                values = np.unique(values)
                first, last = np.searchsorted(keys, values), np.searchsorted(keys, values, side="right")
                for a, b in zip(first[last > first], last[last > first]):
                    found.update(owner[a:b].tolist())
        return found

    def contained(self, text: str | None) -> list[tuple[int, int]]:
        """(item, shared shingles) of the items that ``text`` contains."""
        tokens = shingles(text)
        if not len(tokens) or not self.sets:
            return []
        out, own = [], None
        for i in sorted(self.candidates(tokens)):
            own = np.unique(tokens) if own is None else own
            item = self.sets[i]
            at = np.minimum(np.searchsorted(own, item), len(own) - 1)
            shared = int((own[at] == item).sum())
            if shared >= self.containment * len(item) - 1e-9:
                out.append((i, shared))
        return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items in lists of about BLOCK_BYTES of text."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    for b in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield [(r.item_id, r.text) for r in part.collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", containment: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment): the items that each document contains; clean documents have no row."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for block in _blocks(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(Index(block, containment))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                found: list[tuple] = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for i, n in index.contained(text):
                        size = len(index.sets[i])
                        found.append((doc_id, index.ids[i], n, size, n / size))
                if found:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], ["doc_id", "item_id", "n_shared", "n_item", "containment"])

        part = rows.mapInArrow(run, "doc_id long, item_id long, n_shared long, n_item long, containment double")
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", containment: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that contain no item, as they are."""
    spark = docs.sparkSession
    small_batches(spark)
    at = docs.columns.index(text_col)
    for block in _blocks(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(Index(block, containment))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not shared.value.contained(t) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
