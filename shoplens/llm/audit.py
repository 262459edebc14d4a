"""Interaction audit of five document filters.

Which filter removes a document depends on the order in which the filters are
applied.  The audit reduces every document to the set of filters that it fails
(five bits), counts documents by part and bit combination, and reads all 120
orders off these counts: per part at most 32 rows, whatever the corpus.

Failure conditions (words are maximal runs of characters other than space, tab
to carriage return; upper and lower case differ):

* A: fewer than ``min_words`` words;
* B: the share of distinct words is below ``min_distinct`` percent;
* C: more than ``max_capitals`` percent of the code points are A to Z;
* D: the text holds one of ``# $ % & * |``;
* E: a document with a smaller id has the same text.

E is an existential self-join: a left-semi join of the documents with the least
id of each repeated text, on hash, exact text and smaller id.  The ids that it
finds are united with the failures of the other filters, and the bits of each
document are put together by one aggregation.

Hot groups: a text that a third of all documents share is one row a map task on
the aggregated side; that side is stored, so the semi-join's other side can be
split by Spark however many copies it holds.  Parts and bit combinations are
counted from partial counts.  Documents without an id are spread by their hash
in the join with the labels.

Defined cases: a null text is empty (fails A; B, C, D not; E if an empty text
has a smaller id); a null part is the empty string; a null id is smaller than
none and none is smaller than it, and it has no labels; rows of equal id and
text count each; of several labels of an id a 1 wins; an empty table gives no
rows; further columns are ignored, whatever their names.  Texts of any length
are read whole, each within one row.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import stored

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]

MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 2

_GAP = r"[\x20\x09-\x0D]+"
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def own_failures(text: Column, min_words: int = MIN_WORDS, min_distinct: int = MIN_DISTINCT, max_capitals: int = MAX_CAPITALS) -> Column:
    """Bits of the filters A to D that a text fails; each reads this text only."""
    words = F.array_remove(F.split(text, _GAP), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    fails = {
        "A": n < min_words,
        "B": F.lit(100) * distinct < F.lit(min_distinct) * n,
        "C": F.lit(100) * capitals > F.lit(max_capitals) * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }
    bits = [F.when(cond, _bit(letter)).otherwise(0) for letter, cond in fails.items()]
    return sum(bits[1:], bits[0])


def repeated(rows: DataFrame) -> DataFrame:
    """The rows of (doc_id, hash, text, ...) whose text a row with a smaller id has: the existential self-join."""
    first = rows.groupBy("hash", "text").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).filter("first_id < last_id")
    first = stored(first.select(F.col("hash").alias("f_hash"), F.col("text").alias("f_text"), "first_id"), "audit-first")
    same = (F.col("hash") == F.col("f_hash")) & (F.col("text") == F.col("f_text")) & (F.col("first_id") < F.col("doc_id"))
    return rows.join(first, same, "left_semi")


def failures(docs: DataFrame, part_col: str = "source", **limits: int) -> DataFrame:
    """(part, doc_id, hash, mask, n): the filters that documents of one id and text fail, as bits, and the number of such rows."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    own = rows.select("part", "doc_id", "hash", own_failures(F.col("text"), **limits).alias("bits"), F.lit(1).alias("n"))
    copies = repeated(rows).select("part", "doc_id", "hash", F.lit(_bit("E")).alias("bits"), F.lit(0).alias("n"))
    return own.unionByName(copies).groupBy("part", "doc_id", "hash").agg(F.bit_or("bits").alias("mask"), F.sum("n").alias("n"))


def combinations(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part and bit combination, and those labelled good or toxic among them."""
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    # rows without an id have no labels; the second key spreads them over the tasks of the join
    masks = masks.withColumn("salt", F.when(F.col("doc_id").isNull(), F.pmod("hash", F.lit(1024))).otherwise(F.lit(0)).cast("int"))
    marks = marks.filter(F.col("l_id").isNotNull()).withColumn("l_salt", F.lit(0))
    rows = masks.join(marks, (F.col("doc_id") == F.col("l_id")) & (F.col("salt") == F.col("l_salt")), "left")
    weigh = lambda c: F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0)))
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), weigh("good").alias("good"), weigh("toxic").alias("toxic"))


def _steps() -> Column:
    """All orders and steps as one constant: order, step, the step's bit, and the bits of the steps before it."""
    rows = [
        {"filter_order": order, "step": k + 1, "bit": _bit(letter), "earlier": sum(map(_bit, order[:k]))}
        for order in ORDERS
        for k, letter in enumerate(order)
    ]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order: string, step: int, bit: int, earlier: int>>")


def every_order(combos: DataFrame) -> DataFrame:
    """The counts of each part, order and step, from at most 32 combinations a part."""
    per_part = combos.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("combos"))
    rows = per_part.select("part", "combos", F.inline(_steps()))
    bit, earlier = F.col("bit"), F.col("earlier")

    def total(cond, value="n"):
        zero = F.lit(0).cast("long")
        return F.aggregate("combos", zero, lambda s, c: s + F.when(cond(c["mask"]), value(c) if callable(value) else c[value]).otherwise(zero))

    fails = lambda m: m.bitwiseAND(bit) != 0
    gone = lambda m: m.bitwiseAND(earlier) != 0
    removed = lambda m: fails(m) & ~gone(m)
    # of the 120 orders, a document that fails k filters is removed by each of them in 120 / k
    share = lambda c: c["n"] * (F.lit(len(ORDERS)) / F.bit_count(c["mask"])).cast("long")
    return rows.select(
        "part",
        "filter_order",
        "step",
        total(lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total(removed).alias("removed"),
        total(lambda m: fails(m) & gone(m)).alias("redundant"),
        total(lambda m: m == bit).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, part_col: str = "source", **limits: int) -> DataFrame:
    """Per part, order of the filters and step: what the step keeps, removes, and what it costs."""
    return every_order(combinations(failures(docs, part_col, **limits), labels))


#: The same counts in DuckDB, each order walked through filter by filter.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d
), f AS (
  SELECT w.doc_id, part,
    len(words) < 200 AS a,
    100 * len(list_distinct(words)) < 50 * len(words) AS b,
    100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(min(w.doc_id) OVER (PARTITION BY text) < w.doc_id, false) AS e
  FROM w
), l AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, [a, b, c, d, e] AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM f LEFT JOIN l USING (doc_id)
), g AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM m GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), walk AS (
  SELECT part, filter_order, step, n, good, toxic,
    substr(filter_order, step, 1) AS letter,
    fails[ascii(substr(filter_order, step, 1)) - 64] AS failing,
    step > 1 AND fails[ascii(substr(filter_order, 1, 1)) - 64]
      OR step > 2 AND fails[ascii(substr(filter_order, 2, 1)) - 64]
      OR step > 3 AND fails[ascii(substr(filter_order, 3, 1)) - 64]
      OR step > 4 AND fails[ascii(substr(filter_order, 4, 1)) - 64] AS gone,
    list_sum(CAST(fails AS INTEGER[])) = 1 AS once
  FROM g, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), counts AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (NOT failing AND NOT gone), 0) AS kept,
    coalesce(sum(n) FILTER (failing AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (failing AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (failing AND once), 0) AS unique_fails,
    coalesce(sum(good) FILTER (failing AND NOT gone), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (failing AND NOT gone), 0) AS toxic_lost
  FROM walk GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counts
"""
