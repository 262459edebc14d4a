"""Periods: any number of them, cut from a window by points in time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoplens.functions.exprs import col


@dataclass(frozen=True)
class Periods:
    """``labels``, one more than the ``splits`` between them.

    A time at a split belongs to the later period, or with ``until`` to the
    earlier one."""

    splits: tuple[str, ...]
    labels: tuple[str, ...]
    until: bool = False

    @staticmethod
    def of(splits: str | Sequence[str], labels: Sequence[str] | None, default: Sequence[str], until: bool = False) -> "Periods":
        """One split or several, with labels of their own or the ``default``
        ones of two periods; more periods are numbered where no label is given."""
        points = (splits,) if isinstance(splits, str) else tuple(splits)
        if list(points) != sorted(set(points)):
            raise ValueError(f"splits must rise: {list(points)}")
        if labels is None:
            labels = default if len(points) == 1 else [f"period_{i + 1}" for i in range(len(points) + 1)]
        if len(labels) != len(points) + 1 or len(set(labels)) != len(labels):
            raise ValueError(f"{len(points)} splits need {len(points) + 1} different labels, not {list(labels)}")
        return Periods(points, tuple(labels), until)

    def index(self, ts: str | Column) -> Column:
        """Number of the period (from 0) that a time lies in: a binary search of
        the splits as nested conditions, NULL for no time."""
        c = col(ts)

        def within(first: int, last: int) -> Column:
            if first == last:
                return F.lit(first)
            middle = (first + last) // 2
            split = F.lit(self.splits[middle]).cast("timestamp_ntz")
            later = c > split if self.until else c >= split
            return F.when(later, within(middle + 1, last)).otherwise(within(first, middle))

        return F.when(c.isNotNull(), within(0, len(self.splits)))

    def counts(self, ts: str | Column, **fields: Column) -> list[Column]:
        """Per period and field, a count of the rows in the period that fulfil
        the field's condition; aggregates for a grouping by session alone, which
        keeps the session's partitioning.  See ``columns`` for their names."""
        period = self.index(ts)
        return [
            F.count(F.when((period == i) & cond, 1)).alias(name)
            for i, names in enumerate(self.columns(*fields).values())
            for name, cond in zip(names, fields.values())
        ]

    def columns(self, *fields: str) -> dict[str, list[str]]:
        """label -> the columns of ``counts``, as ``explode_periods`` takes them."""
        return {label: [f"{f}_{i}" for f in fields] for i, label in enumerate(self.labels)}
