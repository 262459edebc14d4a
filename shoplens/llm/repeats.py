"""Substring de-duplication by sorting suffixes, exact to the byte.

Texts are UTF-8 bytes.  A byte goes if it lies in a string of ``length`` bytes
(a window) that also starts anywhere else, in the same text or another one.

Not every suffix is shipped.  Each window has a leading token: the string of
``length / 4`` bytes in it with the least hash, the leftmost of equal ones.
Equal windows have equal leading tokens at equal places, so only windows with a
common leading token need comparing.  Consecutive windows that share one token
occurrence form a stretch, which is shipped as one row:

1. One pass over the documents lists the stretches: token hash, a 128-bit digest
   of the bytes, and the place.  Equal stretches of a batch of texts are one row.
2. Stretches whose token occurs once in the corpus are done: nothing repeats.
   Stretches whose digest occurs twice are repeated as a whole.
3. Of the tokens with several different stretches, one example of each stretch
   fetches its bytes.  Sampled splitters (Spark's range partitioning) deal them by
   token; a bucket sorts the suffixes that start in them, up to ``length``
   bytes, by multikey quicksort: suffixes that are still tied go by the next
   eight bytes in which their group differs.  Suffixes tied to the end repeat.
4. The repeated places are brought back to their texts, united and cut out.

Splitters fall between tokens, and suffixes of different tokens are different, so
neighbours on two sides of a bucket's boundary never tie.  Only a token with
more than ``HOT`` different stretches (a phrase in millions of contexts) must be
split across buckets: its windows are dealt by their own 128-bit digests, and
counting these compares them across all buckets.

Hot groups: copies of a text are listed once a task, counted by their hash, and
joined from stored tables whose sides Spark may split; repeated stretches are
counted from partial counts.  The driver gets nothing.

Two texts, or two stretches, are taken for equal if their 128-bit digests agree.

Defined cases: a null text is empty; texts shorter than ``length`` keep
everything; a text that occurs twice loses all its bytes if it is long enough;
null or repeated ids are rows like others; an empty table gives no rows; further
columns are ignored, whatever their names.  What is kept may end within a
character, so it is binary.  Long texts are read in pieces of ``CHUNK`` windows;
memory grows with the longest single text, which is one value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import _BYTES, mix, power, small_batches, stored

LENGTH = 400
#: Windows whose tokens are looked for at a time.
CHUNK = 1 << 19
#: Different stretches of a token that one bucket sorts together.
HOT = 8192
#: Bytes of stretches that a bucket sorts at a time.
SORT_BYTES = 2 << 20

_PLACE_BITS = np.uint64(21)
_PLACE = np.uint64((1 << 21) - 1)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and the bounds of its values in them."""
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values: running minima from both ends of blocks."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def stretches(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(at, low, high, token) of texts that lie in ``data``, piece by piece: windows low..high have their leading token at ``at``."""
    size = max(1, length // 4)
    long = ends - starts >= length
    starts, stops = starts[long], ends[long] - length + 1
    for c0 in range(0, max(0, len(data) - length + 1), CHUNK):
        c1 = min(c0 + CHUNK, len(data) - length + 1)
        a, b = np.clip(starts, c0, c1) - c0, np.clip(stops, c0, c1) - c0
        edge = np.zeros(c1 - c0 + 1, np.int8)
        some = a < b
        edge[a[some]] += 1
        edge[b[some]] -= 1
        windows = np.flatnonzero(np.cumsum(edge[:-1], dtype=np.int8))
        if not len(windows):
            continue
        part = data[c0 : c1 - 1 + length]
        n = len(part)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[part] * power("up", n), out=sums[1:])
        hashes = mix((sums[size:] - sums[:-size]) * power("down", n - size + 1))
        ranked = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        at = (_least(ranked, length - size + 1)[windows] & _PLACE).astype(np.int64)
        edges = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]]))
        first, last = edges[:-1], edges[1:] - 1
        yield at[first] + c0, windows[first] + c0, windows[last] + c0, hashes[at[first]].view(np.int64)


def union_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch, united."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_PLACES = "t1 long, t2 long, token long, s1 long, s2 long, at int, low int, high int, n int"


def _places(texts: DataFrame, length: int) -> DataFrame:
    """The stretches of (t1, t2, text).  Rows without a token are spans low to high that repeat within a batch."""

    def listed(t1: np.ndarray, t2: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        view = memoryview(data)
        for at, low, high, token in stretches(data, starts, ends, length):
            number: dict[bytes, int] = {}
            first = np.empty(len(at), np.int64)
            for k, (a, b, c) in enumerate(zip(low.tolist(), high.tolist(), at.tolist())):
                digest = hashlib.blake2b(view[a : b + length], digest_size=16, salt=(c - a).to_bytes(8, "little")).digest()
                first[k] = number.setdefault(digest, len(number))
            text = np.searchsorted(starts, low, "right") - 1
            count = np.bincount(first)
            _, own = np.unique(first, return_index=True)
            s = np.frombuffer(b"".join(number), np.int64).reshape(-1, 2)
            base = starts[text[own]]
            spans: list[tuple[int, int, int]] = []
            again = np.flatnonzero(count[first] > 1)
            for t, a, b in zip(text[again].tolist(), low[again].tolist(), (high[again] + length).tolist()):
                if spans and spans[-1][0] == t and a <= spans[-1][2]:
                    spans[-1] = (t, spans[-1][1], max(b, spans[-1][2]))
                else:
                    spans.append((t, a, b))
            of, begin, end = (np.array(x, np.int64) for x in (zip(*spans) if spans else ((), (), ())))
            none = pa.nulls(len(of), pa.int64())
            small = lambda x, y: pa.array(np.concatenate([x, y]).astype(np.int32))
            key = lambda x: pa.concat_arrays([pa.array(x), none])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([t1[text[own]], t1[of]])),
                    pa.array(np.concatenate([t2[text[own]], t2[of]])),
                    key(token[own]),
                    key(np.ascontiguousarray(s[:, 0])),
                    key(np.ascontiguousarray(s[:, 1])),
                    small(at[own] - base, np.zeros(len(of))),
                    small(low[own] - base, begin - starts[of]),
                    small(high[own] - base, end - starts[of]),
                    small(count, np.zeros(len(of))),
                ],
                ["t1", "t2", "token", "s1", "s2", "at", "low", "high", "n"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int]] = set()  # copies of a text are listed once a task
        for batch in batches:
            if not batch.num_rows:
                continue
            t1, t2 = (batch.column(i).to_numpy() for i in (0, 1))
            new = np.zeros(len(t1), bool)
            for i, key in enumerate(zip(t1.tolist(), t2.tolist())):
                if key not in met:
                    met.add(key)
                    new[i] = True
            data, bounds = _bytes_of(batch.column(2))
            starts, ends = bounds[:-1], bounds[1:]
            yield from listed(t1[new], t2[new], data, starts[new], ends[new])

    return texts.select("t1", "t2", "text").mapInArrow(run, _PLACES)


_STRETCH = "token long, hot boolean, s1 long, s2 long, place int, bytes binary"


def _fetched(texts: DataFrame, needed: DataFrame, length: int) -> DataFrame:
    """The bytes of the needed stretches, cut from one copy of their text a task."""
    per_text = needed.groupBy("t1", "t2").agg(F.collect_list(F.struct("token", "hot", "s1", "s2", "at", "low", "high")).alias("need"))
    per_text = stored(per_text, "repeats-need")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int]] = set()
        for batch in batches:
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if key in met:
                    continue
                met.add(key)
                text, need = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                rows = [(x["token"], x["hot"], x["s1"], x["s2"], x["at"] - x["low"], text[x["low"] : x["high"] + length]) for x in need]
                kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["token", "hot", "s1", "s2", "place", "bytes"])

    return texts.join(per_text, ["t1", "t2"]).select("t1", "t2", "text", "need").mapInArrow(run, _STRETCH)


def tied_suffixes(data: np.ndarray, pos: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which suffixes (at ``pos`` in ``data``) share their first ``length`` bytes with another one of their group.

    Multikey quicksort by words of eight bytes: the suffixes of a group that are
    not all tied are sorted by the first word in which neighbours differ, and
    each run of equal words is a group again.
    """
    columns = np.unique(np.append(np.arange(0, length - 7, 8), length - 8))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.zeros(len(data) + 1, np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | padded[k : k + len(words)]
    tied = np.zeros(len(pos), bool)
    order = np.argsort(group, kind="stable")
    group = group[order]
    while len(order):
        start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.append(start, len(group)))
        keep = np.repeat(size > 1, size)
        order, group = order[keep], group[keep]
        if not len(order):
            break
        size = size[size > 1]
        start = np.cumsum(size) - size
        differ = np.full(len(order), len(columns))  # first column in which a suffix differs from the one before
        for a in range(0, len(order), 1 << 14):
            b = min(len(order), a + (1 << 14))
            rows = words[pos[order[max(0, a - 1) : b], None] + columns]
            unequal = rows[1:] != rows[:-1]
            differ[max(1, a) : b] = np.where(unequal.any(axis=1), unequal.argmax(axis=1), len(columns))
        differ[start] = len(columns)
        least = np.minimum.reduceat(differ, start)
        whole = np.repeat(least == len(columns), size)
        tied[order[whole]] = True
        order, group, at = order[~whole], group[~whole], np.repeat(least, size)[~whole]
        word = words[pos[order] + columns[at]] if len(order) else np.zeros(0, np.uint64)
        now = np.lexsort((word, group))
        order, group, word = order[now], group[now], word[now]
        group = np.cumsum(np.concatenate([[False], (group[1:] != group[:-1]) | (word[1:] != word[:-1])])) if len(order) else group
    return tied


_RUNS = "s1 long, s2 long, first int, last int"


def _runs_batch(s1: np.ndarray, s2: np.ndarray, row: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Runs of consecutive windows ``place`` of stretches ``row``, both in order."""
    edges = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1), [True]])) if len(row) else np.zeros(1, np.int64)
    a, b = edges[:-1], edges[1:] - 1
    return pa.RecordBatch.from_arrays([pa.array(s1[row[a]]), pa.array(s2[row[a]]), pa.array(place[a].astype(np.int32)), pa.array(place[b].astype(np.int32))], ["s1", "s2", "first", "last"])


def _sorted_bucket(rows: pa.Table, length: int) -> pa.RecordBatch:
    """The repeated windows of whole groups of stretches."""
    token, s1, s2, place = (rows.column(c).to_numpy() for c in ("token", "s1", "s2", "place"))
    order = np.lexsort((s2, s1, token))
    fresh = np.concatenate([[True], (np.diff(token[order]) != 0) | (np.diff(s1[order]) != 0) | (np.diff(s2[order]) != 0)])
    order = order[fresh]  # a stretch fetched by several tasks counts once
    data, bounds = _bytes_of(rows.column("bytes").combine_chunks())
    count = (bounds[1:] - bounds[:-1])[order] - length + 1
    row = np.repeat(order, count)
    q = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    _, rank = np.unique(token, return_inverse=True)
    group = rank[row] * (length + 1) + place[row] - q  # of one token, windows at equal places before it
    tied = tied_suffixes(data, bounds[row] + q, group, length)
    return _runs_batch(s1, s2, row[tied], q[tied])


def _bucket_runs(cold: DataFrame, length: int) -> DataFrame:
    """(s1, s2, first, last): repeated windows of stretches, found by sorting suffixes in range-partitioned buckets."""
    names = ["token", "s1", "s2", "place", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size >= SORT_BYTES:
                table = pa.Table.from_batches(held)
                token = table.column(0).to_numpy()
                cut = int(np.searchsorted(token, token[-1]))  # the last token may go on in the next batch
                if cut:
                    yield _sorted_bucket(table.slice(0, cut).combine_chunks(), length)
                    held = table.slice(cut).combine_chunks().to_batches()
                size = sum(x.nbytes for x in held)
        if held:
            yield _sorted_bucket(pa.Table.from_batches(held).combine_chunks(), length)

    return cold.select(*names).repartitionByRange("token").sortWithinPartitions("token").mapInArrow(run, _RUNS)


def _hot_runs(hot: DataFrame, length: int) -> DataFrame:
    """(s1, s2, first, last) of tokens too common for a bucket: each window is dealt by its own digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s1, s2, data in zip(*(c.to_pylist() for c in batch.columns)):
                n = len(data) - length + 1
                w = np.frombuffer(b"".join(hashlib.blake2b(data[q : q + length], digest_size=16).digest() for q in range(n)), np.int64).reshape(-1, 2)
                columns = [np.ascontiguousarray(w[:, 0]), np.ascontiguousarray(w[:, 1]), np.full(n, s1), np.full(n, s2), np.arange(n, dtype=np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["w1", "w2", "s1", "s2", "place"])

    windows = stored(hot.select("s1", "s2", "bytes").mapInArrow(run, "w1 long, w2 long, s1 long, s2 long, place int"), "repeats-windows")
    twice = windows.groupBy("w1", "w2").agg(F.min("s1").alias("a"), F.max("s1").alias("b")).filter("a <> b").select("w1", "w2")
    found = windows.join(stored(twice, "repeats-twice"), ["w1", "w2"], "left_semi")
    return found.select("s1", "s2", F.col("place").alias("first"), F.col("place").alias("last")).distinct()


def repeated_spans(texts: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(t1, t2, spans): per text of (t1, t2, text) with repeats, the spans to remove, not yet united."""
    small_batches(texts.sparkSession)
    size = F.octet_length("text")
    places = stored(_places(texts.filter(size >= length), length), "repeats-places")
    listed = places.filter(F.col("token").isNotNull())
    shared = stored(listed.groupBy("token").agg(F.sum("n").alias("n")).filter("n > 1").select("token"), "repeats-tokens")
    live = stored(listed.join(shared, "token", "left_semi"), "repeats-live")

    example = [F.first(c).alias(c) for c in ("t1", "t2", "at", "low", "high")]
    kinds = stored(live.groupBy("token", "s1", "s2").agg(F.sum("n").alias("n"), *example), "repeats-kinds")
    several = stored(kinds.groupBy("token").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "repeats-several")
    needed = kinds.join(several, "token").withColumn("hot", F.col("kinds") > hot)
    cut = stored(_fetched(texts, needed, length), "repeats-bytes")

    whole = kinds.filter("n > 1").select("s1", "s2", F.lit(0).alias("first"), (F.col("high") - F.col("low")).alias("last"))
    runs = whole.unionByName(_bucket_runs(cut.filter(~F.col("hot")), length)).unionByName(_hot_runs(cut.filter("hot"), length))
    found = live.join(stored(runs, "repeats-runs"), ["s1", "s2"])
    spans = found.select("t1", "t2", (F.col("low") + F.col("first")).alias("start"), (F.col("low") + F.col("last") + length).alias("end"))
    within = places.filter(F.col("token").isNull()).select("t1", "t2", F.col("low").alias("start"), F.col("high").alias("end"))
    copies = texts.filter(size >= length).groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n"), F.max(size).alias("end")).filter("n > 1")
    every = spans.unionByName(within).unionByName(copies.select("t1", "t2", F.lit(0).alias("start"), "end"))
    return every.distinct().groupBy("t1", "t2").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(id, n_bytes, spans, kept): per document the removed spans, united, in bytes, and the remaining bytes."""
    if length < 8:
        raise ValueError("repeats are strings of eight bytes or more")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), text.cast("binary").alias("text"))
    spans = stored(repeated_spans(rows, length, hot), "repeats-spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            united, kept = [], []
            for text, found in zip(batch.column(1), batch.column(2).to_pylist()):
                text = text.as_buffer().to_pybytes()
                gone = union_spans([(x["start"], x["end"]) for x in found or ()])
                edges = [0, *(x for span in gone for x in span), len(text)]
                united.append([{"start": a, "end": b} for a, b in gone])
                kept.append(b"".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2])) if gone else text)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(united, kind), pa.array(kept, pa.binary())], ["id", "spans", "kept"])

    joined = rows.join(spans, ["t1", "t2"], "left").select("id", "text", "spans")
    out = joined.mapInArrow(run, "id long, spans array<struct<start: int, end: int>>, kept binary")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return out.select(F.col("id").alias(id_col), (F.octet_length("kept") + removed).alias("n_bytes"), removed.alias("n_removed"), "spans", "kept")
