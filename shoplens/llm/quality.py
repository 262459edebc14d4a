"""Quality rules: hashed n-gram log-likelihood ratio between trusted and raw text.

Words and word pairs are hashed into ``buckets`` buckets.  Two smoothed
multinomials are counted over the buckets: one over every document of the raw
corpus, one over trusted target documents.  A document's score is the sum of
its n-grams' log ratios (target over raw) divided by its number of n-grams.
Log ratios are rounded to 2^-20 and summed as integers, so a score does not
depend on the order of summation and the threshold decides every document the
same way in every run.

Everything runs as built-in DataFrame functions.  Scoring is row-local: the
table of log ratios is one array of ``buckets`` numbers, read as a scalar
subquery, so documents are neither exploded nor shuffled for it.

Defined cases: a null, empty or blank text has no words, scores null and is
not kept; a document of one word has one n-gram; repeated rows are scored
each; without target documents every ratio is 0, so only the base rules
decide; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import stored

BUCKETS = 10_000
#: Least length-normalised log ratio of a kept document.
THRESHOLD = -0.06
SCALE = 1 << 20

# The base rules' white space, symbols, window and limits.
SPACE = r"[\x20\x09-\x0D]+"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
REPEAT_WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _pair_hashes(words: Column) -> Column:
    """A hash per pair of neighbouring words."""
    left, right = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, F.lit(2), F.size(words))
    return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))


def _windows(ones: Column, twos: Column) -> Column:
    """A hash per window of five consecutive words, from the hashes of its first two pairs and its last word."""
    steps = F.when(F.size(ones) >= REPEAT_WINDOW, F.sequence(F.lit(0), F.size(ones) - REPEAT_WINDOW)).otherwise(F.array().cast("array<int>"))
    return F.transform(steps, lambda i: F.xxhash64(F.get(twos, i), F.get(twos, i + 2), F.get(ones, i + 4)))


def _repeat_words(starts: Column) -> Column:
    """Words inside the windows that start at ``starts``, which rise: each adds the words that the one before has not covered."""
    step = F.aggregate(
        starts,
        F.struct(F.lit(-REPEAT_WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a.n + F.least(F.lit(REPEAT_WINDOW), i - a.last)).alias("n")),
    )
    return step.getField("n").cast("long")


def with_base_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the hashes of words and of pairs (``_ones``, ``_twos``), the base counts and verdict."""
    text = F.col(text_col)
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda s: F.rlike(s, F.lit(WORD_CHARACTER)))
    out = docs.withColumn("_words", words_of(text)).withColumn("_lines", lines)
    out = out.withColumns({"_ones": _word_hashes(F.col("_words")), "_twos": _pair_hashes(F.col("_words"))})
    out = out.withColumn("_windows", _windows(F.col("_ones"), F.col("_twos")))
    # most texts repeat no window: sorting is left to those that do.  Equal windows are neighbours once sorted.
    some = F.size("_windows") > F.size(F.array_distinct("_windows"))
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    out = out.withColumn("_sorted", F.when(some, F.sort_array(placed)).otherwise(F.array().cast("array<struct<h: bigint, i: int>>")))
    same = lambda x, j: F.coalesce(x["h"] == F.get(F.col("_sorted"), j).getField("h"), F.lit(False))
    again = F.filter("_sorted", lambda x, j: same(x, j - 1) | same(x, j + 1))
    out = out.withColumn("_again", F.sort_array(F.transform(again, lambda x: x["i"])))
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": _repeat_words(F.col("_again")),
        }
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("_words", "_lines", "_windows", "_sorted", "_again")


def _bucket(hash_: Column, buckets: int) -> Column:
    return F.pmod(hash_, F.lit(buckets)).cast("int")


def ngram_buckets(words: Column, buckets: int = BUCKETS) -> Column:
    """Bucket numbers of all words and all pairs of neighbouring words."""
    return F.transform(F.concat(_word_hashes(words), _pair_hashes(words)), lambda h: _bucket(h, buckets))


def trusted_ids(labels: DataFrame, max_target: int | None = None) -> DataFrame:
    """Ids of good, non-toxic labelled documents: all, or, where a caller asks for it, about ``max_target`` of them chosen by hash."""
    good = labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    if max_target is None:
        return good
    total = good.count()
    if total > max_target:
        good = good.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit((max_target << 20) // total))
    return good


def _with_trust(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds ``trusted`` (0 or 1) to rows with ``_id``.

    64 neighbouring ids are one row with a bit each.  The rows are stored, so that Spark sees their size: it broadcasts
    them while they are small, and joins by shuffle beyond that.
    """
    place = lambda c: (F.shiftright(c, 6), c.bitwiseAND(F.lit(63)).cast("int"))
    block, bit = place(F.col("doc_id").cast("long"))
    masks = targets.select(block.alias("_block"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
    masks = stored(masks.groupBy("_block").agg(F.bit_or("bit").alias("_mask")), "trusted")
    block, bit = place(F.col("_id"))
    flag = F.call_function("shiftright", F.col("_mask"), bit).bitwiseAND(F.lit(1))
    joined = docs.withColumn("_block", block).join(masks, "_block", "left")
    return joined.withColumn("trusted", F.coalesce(flag, F.lit(0)).cast("long")).drop("_block", "_mask")


def log_ratios(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, ratio): scaled log ratio of each of the ``buckets`` buckets, over every document."""
    rows = _with_trust(docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")), targets)
    rows = rows.select("trusted", words_of(F.col("_text")).alias("_words"))
    # the n-grams of ``ngram_buckets``, a word and the next one (null after the last) in a row: hashed by compiled code
    rows = rows.select("trusted", F.inline(F.arrays_zip(F.col("_words"), F.slice("_words", F.lit(2), F.size("_words"))))).toDF("trusted", "_word", "_next")
    one, two = F.xxhash64("_word"), F.xxhash64("_word", "_next")
    grams = rows.select("trusted", F.explode(F.when(F.col("_next").isNull(), F.array(one)).otherwise(F.array(one, two))).alias("hash"))
    grams = grams.select("trusted", _bucket(F.col("hash"), buckets).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("trusted").alias("target"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    counts = every.join(counts, "bucket", "left").na.fill(0, ["raw", "target"])
    counts = stored(counts, "ngrams")  # as many rows as buckets; read three times below
    all_raw = counts.agg(F.sum("raw")).scalar()
    all_target = counts.agg(F.sum("target")).scalar()
    p = F.log((F.col("target") + 1) / (all_target + buckets))
    q = F.log((F.col("raw") + 1) / (all_raw + buckets))
    ratio = F.when(all_target > 0, F.round((p - q) * SCALE).cast("long")).otherwise(F.lit(0).cast("long"))
    return counts.select("bucket", ratio.alias("ratio"))


def quality(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """Base counts, ``base_failed``, ``n_ngrams``, ``score`` and ``kept`` of every document."""
    table = log_ratios(docs, targets, id_col, text_col, buckets).agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "ratio"))), lambda x: x.ratio).alias("t"))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    rows = with_base_rules(slim, "_text").withColumn("_ratios", table.scalar())
    total = lambda hashes: F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a + F.get(F.col("_ratios"), _bucket(h, buckets)))
    rows = rows.withColumns({"n_ngrams": (F.size("_ones") + F.size("_twos")).cast("long"), "_total": total("_ones") + total("_twos")})
    rows = rows.withColumn("score", F.when(F.col("n_ngrams") > 0, F.col("_total") / F.col("n_ngrams") / SCALE))
    kept = ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False))
    return rows.withColumn("kept", kept).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_ngrams", "score")
