"""Explicit semi-join reduction of whole-history tables by the window's sessions.

An analysis joins the sessions of its window with facts of all time (orders,
pageview counts).  The join needs only the facts of those sessions, but the
facts are shuffled before it.  A reducer is a Bloom filter of the window's
session ids, built by Spark as a small table and broadcast: it drops almost
all other facts in the task that scans them, before any exchange.

The filter is a table of 64-bit words.  An id sets ``BITS`` bits of one word
(a blocked Bloom filter), so building it is one grouped ``bit_or`` and asking it
one broadcast lookup, all in built-in functions.  Ids that it lets through by
chance (about two in a hundred) meet nothing in the join that follows, so results never change.

Size: a word stands for ``KEYS_PER_WORD`` ids, about eight bytes an id on each
executor.  The ids are counted first; above ``max_keys`` no filter is built and
the facts stay as they are, for the shuffled join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS_PER_WORD = 5
BITS = 4


def _word(key: str, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _mask(key: str) -> Column:
    """The bits that an id sets, from six bits each of a second hash."""
    h = F.xxhash64(F.lit(1), key)
    places = [F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(BITS)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
    return reduce(Column.bitwiseOR, bits)


@dataclass(frozen=True)
class Reducer:
    """How large a set of ids may be for a filter to be built from it."""

    max_keys: int = 4_000_000

    def reduce(self, facts: DataFrame, sessions: DataFrame, key: str = "website_session_id") -> DataFrame:
        """``facts`` without most rows whose ``key`` is not among ``sessions``;
        rows without a key go too, since they join with nothing."""
        ids = sessions.select(key).filter(F.col(key).isNotNull())
        n = ids.count()
        if n > self.max_keys:
            return facts
        words = n // KEYS_PER_WORD + 1
        bloom = ids.groupBy(_word(key, words).alias("_word")).agg(F.bit_or(_mask(key)).alias("_bits"))
        kept = facts.filter(F.col(key).isNotNull()).withColumn("_word", _word(key, words))
        kept = kept.join(F.broadcast(bloom), "_word").filter(F.col("_bits").bitwiseAND(_mask(key)) == _mask(key))
        return kept.select(*facts.columns)
