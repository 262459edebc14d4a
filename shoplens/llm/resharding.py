"""Minimum-cost-flow resharding: move the fewest bytes from old shards to new capacities.

Rows have a position, a hash of their id, text and place in the input (so that
equal rows spread as well), cut into blocks and, within a block, cells.  One aggregation gives the bytes of every (old shard, block).
The transfers between shards are then a transportation problem: old shards
supply their bytes, new shards take up to their capacity, keeping a byte costs
nothing and moving it costs one.  A small successive-shortest-path solver finds
the cheapest flow (its graph has one edge per pair of shards, whatever the
data).  A flow is carried out as ranges of positions: whole blocks where it can
be, and the few blocks that a boundary cuts are measured again by cell.

Only files of affected shards are rewritten: a shard that keeps exactly its
rows stays as it is.  Sizes are UTF-8 bytes of the text plus 8.

Defined cases: a null text has size 8; null ids and repeated rows are placed
like others; a text of any length is one row of one shard; an empty table gives
empty shards; further columns travel with the rows.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import crc32_of, shared_dir

OLD_SHARDS, NEW_SHARDS = 16, 24
ROW_OVERHEAD = 8
#: Blocks per old shard and cells per block: the driver sees blocks * shards sums, and cells * cuts.
BLOCK_BITS, CELL_BITS = 9, 12
#: Bytes aimed at in a written file.
FILE_BYTES = 128 << 20


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_OVERHEAD


def position_of(id_col: Column, text: Column) -> Column:
    """0 to 2^21 - 1, spread evenly over rows, equal ones too.

    The row's place is its partition and number there, which stay the same whenever
    a stored table is read."""
    return F.shiftrightunsigned(F.xxhash64(id_col, text, F.monotonically_increasing_id()), 64 - BLOCK_BITS - CELL_BITS)


def min_cost_flow(supply: list[int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """Bytes from old shard i to new shard j; keeping (i = j) is free, moving costs 1 a byte.

    Successive shortest augmenting paths over the residual graph.
    """
    if sum(capacity) < sum(supply):
        raise ValueError("the capacities cannot hold the data")
    n, m = len(supply), len(capacity)
    source, sink = n + m, n + m + 1
    to: list[int] = []
    left: list[int] = []
    cost: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def edge(a: int, b: int, most: int, price: int) -> None:
        for x, y, c, p in ((a, b, most, price), (b, a, 0, -price)):
            out[x].append(len(to))
            to.append(y)
            left.append(c)
            cost.append(p)

    for i, s in enumerate(supply):
        edge(source, i, s, 0)
        for j in range(m):
            edge(i, n + j, s, int(i != j))
    for j, c in enumerate(capacity):
        edge(n + j, sink, c, 0)
    while True:
        far: list[float] = [float("inf")] * len(out)
        came, waiting, queued = [-1] * len(out), deque([source]), {source}
        far[source] = 0
        while waiting:
            x = waiting.popleft()
            queued.discard(x)
            for e in out[x]:
                if left[e] and far[x] + cost[e] < far[to[e]]:
                    far[to[e]], came[to[e]] = far[x] + cost[e], e
                    if to[e] not in queued:
                        queued.add(to[e])
                        waiting.append(to[e])
        if came[sink] < 0:
            break
        path, x = [], sink
        while x != source:
            path.append(came[x])
            x = to[came[x] ^ 1]
        amount = min(left[e] for e in path)
        for e in path:
            left[e] -= amount
            left[e ^ 1] += amount
    return {(to[e ^ 1], to[e] - n): left[e ^ 1] for e in range(0, len(to), 2) if to[e ^ 1] < n and left[e ^ 1]}


@dataclass(frozen=True)
class Plan:
    """``ranges[old]``: (first position beyond, new shard) in order of position; ``moved`` bytes leave their shard."""

    ranges: dict[int, list[tuple[int, int]]]
    moved: int
    affected: frozenset[int]

    def shard(self, old: Column, position: Column) -> Column:
        """The new shard of a row: a lookup in a literal of a few ranges per old shard."""
        if not self.ranges:
            return F.lit(0)
        entries = []
        for key, ranges in sorted(self.ranges.items()):
            entries += [F.lit(key), F.array(*(F.struct(F.lit(end).cast("long").alias("end"), F.lit(new).alias("shard")) for end, new in ranges))]
        own = F.element_at(F.create_map(*entries), old)
        return F.element_at(F.filter(own, lambda r: position < r.end), 1).shard


def plan_transfers(rows: DataFrame, old_shards: int, capacity: list[int] | None, new_shards: int = NEW_SHARDS) -> Plan:
    """``rows`` has ``old``, ``position`` and ``size``.  Without capacities the new shards get equal bytes."""
    blocks = {(r.old, r.block): r.bytes for r in rows.groupBy("old", F.shiftright("position", CELL_BITS).alias("block")).agg(F.sum("size").alias("bytes")).collect()}
    supply = [0] * old_shards
    for (old, _), n in blocks.items():
        supply[old] += n
    if capacity is None:
        total = sum(supply)
        capacity = [total // new_shards + (j < total % new_shards) for j in range(new_shards)]
    flow = min_cost_flow(supply, capacity)
    cuts: dict[tuple[int, int], list[tuple[int, int]]] = {}
    ranges: dict[int, list[tuple[int, int]]] = {}
    for old in range(old_shards):
        # bytes that stay come first, then the transfers in order of shard
        parts = sorted(((j, n) for (i, j), n in flow.items() if i == old), key=lambda x: (x[0] != old, x[0]))
        ends, at = [], 0
        for _, n in parts[:-1]:
            at += n
            ends.append(at)
        done, b = 0, 0
        order = sorted((block, n) for (i, block), n in blocks.items() if i == old)
        for k, end in enumerate(ends):
            while b < len(order) and done + order[b][1] <= end:
                done += order[b][1]
                b += 1
            block = order[b][0] if b < len(order) else 1 << BLOCK_BITS
            if b < len(order) and end > done:
                cuts.setdefault((old, block), []).append((k, end - done))
            ranges.setdefault(old, []).append((block << CELL_BITS, parts[k][0]))
        if parts:
            ranges.setdefault(old, []).append((1 << (BLOCK_BITS + CELL_BITS), parts[-1][0]))
    if cuts:
        keys = F.concat_ws(":", "old", F.shiftright("position", CELL_BITS))
        cells = rows.filter(keys.isin([f"{o}:{b}" for o, b in cuts])).groupBy("old", "position").agg(F.sum("size").alias("bytes"))
        of: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for r in cells.collect():  # at most 2^CELL_BITS sums for each cut block
            of.setdefault((r.old, r.position >> CELL_BITS), []).append((r.position, r.bytes))
        for key, wanted in cuts.items():
            at, cell = 0, 0
            own = sorted(of[key])
            for k, need in wanted:
                while cell < len(own) and at + own[cell][1] / 2 <= need:  # a cell goes to the nearer side
                    at += own[cell][1]
                    cell += 1
                end = own[cell][0] if cell < len(own) else own[-1][0] + 1
                ranges[key[0]][k] = (end, ranges[key[0]][k][1])
    moved = sum(n for (i, j), n in flow.items() if i != j)
    affected = {j for (i, j) in flow if i != j} | {i for (i, j) in flow if i != j}
    return Plan(ranges, moved, frozenset(affected))


def with_layout(docs: DataFrame, old: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds ``_old``, ``_position`` and ``_size``."""
    return docs.withColumns({"_old": old.cast("int"), "_position": position_of(F.col(id_col), F.col(text_col)), "_size": size_of(F.col(text_col))})


def reshard(docs: DataFrame, old: Column, old_shards: int, new_shards: int = NEW_SHARDS, capacity: list[int] | None = None, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, positions: bool = False) -> tuple[Plan, DataFrame, str]:
    """Solve the transfers and rewrite the affected shards under ``path`` as ``shard=<n>`` folders, with each row's ``_position`` where ``positions`` is set.

    Returns the plan, all rows with their ``shard`` (before writing) and the path.
    """
    laid = with_layout(docs, old, id_col, text_col)
    plan = plan_transfers(laid.select(F.col("_old").alias("old"), F.col("_position").alias("position"), F.col("_size").alias("size")), old_shards, capacity, new_shards)
    placed = laid.withColumn("shard", plan.shard(F.col("_old"), F.col("_position")))
    path = path or shared_dir(docs.sparkSession, "shards")
    total = placed.agg(F.sum("_size")).first()[0] or 0
    # a shard is written by several tasks: slices of its positions, a file of about FILE_BYTES each
    slices = max(2, -(-total // (FILE_BYTES * new_shards)))
    slice_of = F.pmod(F.xxhash64("_position"), F.lit(slices))
    changed = placed.filter(F.col("shard").isin(sorted(plan.affected))) if len(plan.affected) < new_shards else placed
    spread = changed.repartition(int(new_shards * slices), "shard", slice_of)
    spread.drop("_old", "_size", *["_position"] * (not positions)).write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return plan, placed, path


def with_slots(rows: DataFrame, shard_col: str = "shard", position_col: str = "position", by: tuple[str, ...] = ("doc_id", "size", "text_crc32")) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard, by position.

    Rows are numbered within a (shard, block) and offset by the counts of the
    shard's earlier blocks, so no task sorts a whole shard.
    """
    rows = rows.withColumn("_block", F.shiftright(position_col, CELL_BITS - 3))
    counts = rows.groupBy(shard_col, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(shard_col).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(shard_col, "_block", F.coalesce(before, F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy(shard_col, "_block").orderBy(position_col, *by))
    numbered = rows.withColumn("_number", number).join(offsets, [shard_col, "_block"])
    return numbered.withColumn("slot", F.col("_before") + F.col("_number") - 1).drop("_block", "_number", "_before")


def reshard_documents(docs: DataFrame, old_shards: int = OLD_SHARDS, new_shards: int = NEW_SHARDS) -> DataFrame:
    """Move documents from ``old_shards`` shards (CRC-32 of the id) to ``new_shards`` of equal bytes and describe the written rows."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    old = F.pmod(crc32_of(F.col("doc_id")), F.lit(old_shards))
    plan, placed, path = reshard(docs, old, old_shards, new_shards, positions=True)
    written = placed.filter("false") if not plan.affected else spark.read.schema("doc_id long, text string, _position long, shard int").parquet(path)
    kept = placed.filter(~F.col("shard").isin(sorted(plan.affected))) if len(plan.affected) < new_shards else None
    rows = written.select("doc_id", "text", "_position", "shard")
    if kept is not None:
        rows = rows.unionByName(kept.select("doc_id", "text", "_position", "shard"))
    slim = rows.select(
        "doc_id",
        size_of(F.col("text")).alias("size"),
        crc32_of(F.col("text")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        F.pmod(crc32_of(F.col("doc_id")), F.lit(old_shards)).cast("int").alias("old_shard"),
        F.col("_position").alias("position"),
    )
    return with_slots(slim).select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")
