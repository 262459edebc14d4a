"""Multi-party perspective rotation: every participant's view of a dialogue.

For each participant the dialogue is rendered with that speaker as
``assistant``, all others as users under their names, and system turns as they
are.  The mask spans cover what the assistant says, including the end mark.

A dialogue is one rendering, given in parts of ``PART_TURNS`` turns so that a
dialogue of any length is spread over tasks: the texts of its parts in order,
put together, are the whole rendering, ``start`` is where a part begins in it,
and masks count from its beginning.  A part that comes after the dialogue's
first system turn carries that turn's rendering in ``system_text``, so that it
can be used alone.

Turns are numbered by a range sort over dialogue and order (equal rows spread
too), with a running count over the ranges a dialogue crosses; then only the
turns of a part meet, and only lengths and counts are summed along a dialogue.
Only built-in functions are used.

Defined cases: a null role is a participant named ``unknown``; a null text is
empty; null turns come first; turns of equal number are ordered by name and
then by the MD5 of the text, repeated rows are rendered each; null dialogue ids
form one dialogue; a dialogue of system turns only has no participant and gives
no row; a very long text is rendered whole; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import stored

PART_TURNS = 64
#: Rows of one key that are summed in one task.
SUM_BLOCK = 4096
SYSTEM_ROLES = ("system",)
UNNAMED = "unknown"

# The rendered marks.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _head(name: Column, speaker: Column, system: Column) -> Column:
    own = F.when(system, F.lit("system")).when(name.eqNullSafe(speaker), F.lit("assistant")).otherwise(F.concat(F.lit("user name="), name))
    return F.concat(F.lit(OPEN), own, F.lit("\n"))


def _before(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of equal ``keys`` and lower ``order``.

    Sums of blocks first, then sums within a block, so that no task holds more than a block or one row per block of a key.
    """
    df = df.withColumn("_block", F.floor(F.col(order) / SUM_BLOCK))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = df.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
    blocks = blocks.withColumn("_base", F.coalesce(F.sum("_sum").over(earlier.partitionBy(*keys).orderBy("_block")), F.lit(0))).drop("_sum")
    inside = F.coalesce(F.sum(value).over(earlier.partitionBy(*keys, "_block").orderBy(order)), F.lit(0))
    return df.withColumn("_inside", inside).join(blocks, [*keys, "_block"]).withColumn(out, F.col("_inside") + F.col("_base")).drop("_block", "_inside", "_base")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``n``, the place of a turn in its dialogue from 0 on."""
    order = ["_key", F.col("turn").asc_nulls_first(), "name", F.md5("text")]
    ranges = rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    placed = stored(ranges.withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33)), "turns")
    counts = placed.groupBy("_key", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_count"))
    counts = _before(counts, ["_key"], "_range", "_count", "_earlier")
    return placed.join(counts, ["_key", "_range"]).withColumn("n", F.col("_earlier") + F.col("_at") - F.col("_first"))


def perspectives(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", system_roles: tuple[str, ...] = SYSTEM_ROLES, part_turns: int = PART_TURNS) -> DataFrame:
    """(id, speaker, part, start, n_turns, n_own_turns, system_text, text, masks): a row per dialogue, participant and part.

    ``masks`` is an array of (start, end) in code points of the whole rendering, end exclusive.
    """
    name = F.coalesce(F.col(role_col).cast("string"), F.lit(UNNAMED))
    # ids inside a struct: equal also where null, in joins and exchanges alike
    rows = turns.select(
        F.struct(F.col(id_col).alias("id")).alias("_key"),
        F.col(turn_col).cast("long").alias("turn"),
        name.alias("name"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = _numbered(rows).withColumn("part", F.floor(F.col("n") / part_turns))
    said = F.array_sort(F.collect_list(F.struct("n", "name", "text", F.col("name").isin(*system_roles).alias("system"))))
    parts = stored(rows.groupBy("_key", "part").agg(said.alias("said")), "parts")

    # lengths as seen by nobody in the dialogue, and what a speaker's own turns differ by
    seen = F.lit(None).cast("string")
    turn_length = lambda t: F.length(_head(t["name"], seen, t["system"])) + F.length(t["text"]) + len(CLOSE) + 1
    lengths = parts.select("_key", "part", F.aggregate(F.transform("said", turn_length), F.lit(0).cast("long"), lambda x, y: x + y).alias("length"))
    spoken = parts.select("_key", "part", F.explode("said").alias("t")).filter(~F.col("t.system")).groupBy("_key", "part", F.col("t.name").alias("speaker")).agg(F.count(F.lit(1)).alias("own"))
    speaker = F.col("speaker")
    gain = F.length(_head(speaker, speaker, F.lit(False))) - F.length(_head(speaker, seen, F.lit(False)))
    views = lengths.join(spoken.select("_key", "speaker").distinct(), "_key").join(spoken, ["_key", "part", "speaker"], "left")
    views = views.withColumn("length", F.col("length") + F.coalesce("own", F.lit(0)) * gain)
    views = _before(views, ["_key", "speaker"], "part", "length", "start").drop("length", "own")
    system = parts.withColumn("t", F.get(F.filter("said", lambda t: t["system"]), 0)).filter("t is not null")
    system = system.groupBy("_key").agg(F.min_by(F.struct(F.col("part").alias("of"), F.col("t.text").alias("text")), "part").alias("first"))
    carried = F.when(F.col("first.of") < F.col("part"), F.concat(F.lit(OPEN + "system\n"), F.col("first.text"), F.lit(CLOSE + "\n")))
    views = views.join(system, "_key", "left").withColumn("system_text", F.coalesce(carried, F.lit(""))).drop("first")
    views = parts.join(views, ["_key", "part"])

    heads = F.transform("said", lambda t: _head(t["name"], speaker, t["system"]))
    bodies = F.transform("said", lambda t: F.concat(t["text"], F.lit(CLOSE)))
    views = views.withColumns({"_heads": heads, "_bodies": bodies})
    pieces = F.zip_with("_heads", "_bodies", lambda h, b: F.concat(h, b, F.lit("\n")))
    views = views.withColumn("_pieces", pieces)
    # (where the next turn starts, spans so far): one pass over the part
    sizes = F.arrays_zip(F.transform("_heads", lambda h: F.length(h)).alias("h"), F.transform("_bodies", lambda b: F.length(b)).alias("b"), F.transform("said", lambda t: (t["name"] == speaker) & ~t["system"]).alias("own"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    spans = F.aggregate(
        sizes,
        F.struct(F.col("start").alias("at"), empty.alias("spans")),
        lambda a, s: F.struct(
            (a.at + s.h + s.b + 1).alias("at"),
            F.when(s.own, F.concat(a.spans, F.array(F.struct((a.at + s.h).alias("start"), (a.at + s.h + s.b).alias("end"))))).otherwise(a.spans).alias("spans"),
        ),
        lambda a: a.spans,
    )
    views = views.withColumn("masks", spans)
    return views.select(
        F.col("_key.id").alias(id_col),
        "speaker",
        "part",
        "start",
        F.size("said").cast("long").alias("n_turns"),
        F.size("masks").cast("long").alias("n_own_turns"),
        "system_text",
        F.array_join("_pieces", "").alias("text"),
        "masks",
    )


def mask_text(masks: Column) -> Column:
    """Spans as ``start:end``, comma-joined."""
    return F.array_join(F.transform(masks, lambda m: F.concat_ws(":", m.start.cast("string"), m.end.cast("string"))), ",")


#: The same rows by window functions over single turns of whole dialogues.
ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, 'unknown') AS name, coalesce(text, '') AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), md5(coalesce(text, ''))) - 1 AS n
  FROM conversations
), people AS (
  SELECT DISTINCT conv_id AS of_conv, name AS speaker FROM t WHERE name <> 'system'
), preface AS (
  SELECT conv_id AS in_conv, min(n) AS sys_n, arg_min(said, n) AS sys_said FROM t WHERE name = 'system' GROUP BY conv_id
), seen AS (
  SELECT t.*, speaker, name = speaker AS own,
         '<|im_start|>' || CASE WHEN name = 'system' THEN 'system' WHEN name = speaker THEN 'assistant' ELSE 'user name=' || name END || chr(10) AS head,
         said || '<|im_end|>' AS body
  FROM t JOIN people ON conv_id IS NOT DISTINCT FROM of_conv
), placed AS (
  SELECT *, n // 64 AS part, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, speaker ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS from_at
  FROM seen
)
SELECT conv_id, speaker, part, CAST(min(from_at) AS BIGINT) AS start, count(*) AS n_turns, count(*) FILTER (own) AS n_own_turns,
       CASE WHEN any_value(sys_n) // 64 < part THEN '<|im_start|>system' || chr(10) || any_value(sys_said) || '<|im_end|>' || chr(10) ELSE '' END AS system_text,
       string_agg(head || body || chr(10), '' ORDER BY n) AS text,
       coalesce(string_agg(CAST(from_at + length(head) AS BIGINT) || ':' || CAST(from_at + length(head) + length(body) AS BIGINT), ',' ORDER BY n) FILTER (own), '') AS mask_spans
FROM placed LEFT JOIN preface ON conv_id IS NOT DISTINCT FROM in_conv
GROUP BY conv_id, speaker, part
"""
