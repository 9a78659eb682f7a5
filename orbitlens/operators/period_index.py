"""A static index over disjoint periods: two sorted arrays that answer any number of rows by one search each.

The index is built from at most ``MAX_INDEXED`` periods, whose number is checked before they are
fetched; its two arrays (8 bytes an end) are broadcast. Rows are looked up in Arrow batches where
they are, batch or stream, so marking rows moves none of them, however long or nested the periods.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.functions.scalars import micros, to_micros

#: periods held by one index: 16 MB
MAX_INDEXED = 1 << 20


@dataclass(frozen=True)
class PeriodIndex:
    """Ascending disjoint periods in microseconds; ``closed`` periods hold their end."""

    starts: np.ndarray
    ends: np.ndarray
    closed: bool

    def inside(self, stamps: np.ndarray) -> np.ndarray:
        """1 for stamps inside a period, else 0."""
        if not len(self.starts):
            return np.zeros(len(stamps), np.int32)
        at = np.searchsorted(self.starts, stamps, "right") - 1
        end = self.ends[np.maximum(at, 0)]
        return ((at >= 0) & ((stamps <= end) if self.closed else (stamps < end))).astype(np.int32)

    def widened(self, width: timedelta) -> PeriodIndex:
        """Closed periods that begin earlier and end later by ``width``."""
        return PeriodIndex(self.starts - to_micros(width), self.ends + to_micros(width), True)

    def column(self, spark: SparkSession, ts: Column | str) -> Column:
        """The index as a column over a timestamp; null timestamps are outside."""
        shared = spark.sparkContext.broadcast(self)

        @F.arrow_udf("int")
        def mark(stamps: pa.Array) -> pa.Array:
            known = stamps.is_valid().to_numpy(zero_copy_only=False)
            return pa.array(shared.value.inside(pc.fill_null(stamps, 0).to_numpy(zero_copy_only=False)) * known)

        return mark(micros(ts))


def merged(starts: np.ndarray, ends: np.ndarray, gap: timedelta, closed: bool) -> PeriodIndex:
    """Periods that overlap, touch or lie at most ``gap`` apart become one; empty ones are dropped."""
    full = starts <= ends if closed else starts < ends
    starts, ends = starts[full], ends[full]
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    opening = np.ones(len(starts), bool)
    opening[1:] = starts[1:] - reach[:-1] > to_micros(gap)
    last = np.append(np.flatnonzero(opening)[1:], len(starts)) - 1
    return PeriodIndex(starts[opening], reach[last] if len(starts) else reach, closed)


def build(periods: DataFrame, gap: timedelta = timedelta(0), closed: bool = False, limit: int = MAX_INDEXED
          ) -> PeriodIndex | None:
    """The index over ``(start, end)`` rows, or None where there are more than ``limit``.

    Periods with a null end cover nothing. One job fetches ``limit + 1`` rows at most.
    """
    both = periods.select(micros("start").alias("start"), micros("end").alias("end")).dropna()
    rows = both.limit(limit + 1).toArrow()
    if len(rows) > limit:
        return None
    return merged(rows["start"].to_numpy(), rows["end"].to_numpy(), gap, closed)


def stretches(rows: DataFrame, ts: str, width: timedelta) -> DataFrame:
    """First and last ``ts`` of all rows in each cell of twice ``width``, as ``(start, end)``.

    Rows of one cell lie at most that far apart, so windows of ``width`` around them make one. Counted
    within tasks first, what moves and remains grows with the time range, not with the rows.
    """
    cell = F.floor(micros(ts) / max(1, 2 * to_micros(width)))
    return (rows.where(F.col(ts).isNotNull()).groupBy(cell.alias("cell"))
            .agg(F.min(ts).alias("start"), F.max(ts).alias("end")).select("start", "end"))
