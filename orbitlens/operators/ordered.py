"""Operators on a global order without a one-task window.

A window with no ``partitionBy`` sends every row to one task. Here the order is cut into
buckets at explicit bounds taken from a small sample. A bucket number is then a plain
function of the row, so it stays the same in every plan, retry and re-read. Windows run
per bucket, and what a bucket needs from the ones before it (a running total, the row
before its first row, the last rows of its predecessors) comes from one small row per
bucket. Bounds cover all order columns, so a single hot value is split by the next column.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orbitlens.functions.scalars import micros

BUCKET = "__bucket"
HALO = "__halo"

ROWS_PER_BUCKET = 250_000
MAX_BUCKETS = 65_536
SAMPLES_PER_BUCKET = 10


@dataclass(frozen=True)
class OrderedFrame:
    """A frame with a bucket column that follows the order of ``order``."""

    df: DataFrame
    order: tuple[str, ...]
    n_buckets: int

    def ascending(self):
        return Window.partitionBy(BUCKET).orderBy(*self.order)

    def descending(self):
        return Window.partitionBy(BUCKET).orderBy(*[F.col(c).desc() for c in self.order])


def _sort_key(df: DataFrame, name: str) -> tuple[Column, str]:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return micros(name), "bigint"
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return F.col(name).cast("bigint"), "bigint"
    if isinstance(kind, T.StringType):
        return F.col(name), "string"
    return F.col(name).cast("double"), "double"


class Cuts:
    """Ascending cut tuples as one array per key column, searched for many rows at once."""

    def __init__(self, cuts: list[tuple]):
        self.columns = [np.array(c, dtype=object if isinstance(c[0], str) else None) for c in zip(*cuts)]
        self.count = len(cuts)

    def not_above(self, keys: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """How many cuts are <= each row; keys are (values, which are null) per column, nulls come first and NaN last."""
        out = np.zeros(len(keys[0][0]), np.int32)
        todo = [(np.arange(len(out)), 0, self.count, 0)]
        while todo:
            rows, low, high, depth = todo.pop()
            column, (values, null) = self.columns[depth][low:high], keys[depth]
            values, null = values[rows], null[rows]
            below = low + np.searchsorted(column, values, "left")
            upto = low + np.searchsorted(column, values, "right")
            last = values != values
            below[last], upto[last] = high, high
            below[null], upto[null] = low, low
            out[rows] = upto
            tied = np.flatnonzero(below < upto)
            if depth + 1 < len(self.columns):
                # rows whose value some cuts share go by the next column, among these cuts
                for start in np.unique(below[tied]):
                    mine = tied[below[tied] == start]
                    todo.append((rows[mine], int(start), int(upto[mine[0]]), depth + 1))
        return out


def _bucket_of(keys: list[tuple[Column, str]], cuts: list[tuple]) -> Column:
    """How many of the ascending cut tuples are <= the row's key; nulls come first.

    The cuts (at most MAX_BUCKETS) are broadcast once and searched in Arrow batches.
    """
    shared = SparkSession.active().sparkContext.broadcast(Cuts(cuts))
    fills = ["" if kind == "string" else 0 for _, kind in keys]

    @F.arrow_udf("int")
    def place(*columns: pa.Array) -> pa.Array:
        rows = [(pc.fill_null(c, fill).to_numpy(zero_copy_only=False), c.is_null().to_numpy(zero_copy_only=False))
                for c, fill in zip(columns, fills)]
        return pa.array(shared.value.not_above(rows))

    return place(*[x.cast(kind) for x, kind in keys])


def order_frame(
    df: DataFrame,
    order: list[str] | tuple[str, ...],
    n_buckets: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    max_buckets: int = MAX_BUCKETS,
) -> OrderedFrame:
    """Give each row the number of its bucket in the global order.

    Runs a count and, beyond one bucket, a sample of about 10 order keys per bucket. The
    bounds only steer balance: any bounds give the same results.
    """
    order = tuple(order)
    if n_buckets == 1:
        return OrderedFrame(df.withColumn(BUCKET, F.lit(0)), order, 1)
    rows = df.count()
    if n_buckets is None:
        n_buckets = max(1, min(max_buckets, math.ceil(rows / rows_per_bucket)))
    cuts: list[tuple] = []
    keys = [_sort_key(df, c) for c in order]
    if n_buckets > 1 and rows:
        fraction = min(1.0, SAMPLES_PER_BUCKET * n_buckets / rows)
        sample = df.select(*[k.alias(f"k{i}") for i, (k, _) in enumerate(keys)]).sample(fraction, seed=11)
        drawn = sorted(
            tuple(math.inf if v != v else v for v in r) for r in sample.collect() if all(v is not None for v in r)
        )
        n_cuts = min(n_buckets - 1, len(drawn))
        cuts = [drawn[(i + 1) * len(drawn) // (n_cuts + 1)] for i in range(n_cuts)]
    if not cuts:
        return OrderedFrame(df.withColumn(BUCKET, F.lit(0)), order, 1)
    return OrderedFrame(df.withColumn(BUCKET, _bucket_of(keys, cuts)), order, len(cuts) + 1)


def scan(frame: OrderedFrame, **wanted: tuple[str, Column]) -> DataFrame:
    """Running values over the global order, one output column per keyword.

    Kinds: ``max`` (running, with the row), ``max_before`` (without the row), ``sum``
    (running, with the row), ``lag``, ``lead``.
    """
    first, here, prior = Window.unboundedPreceding, Window.currentRow, -1
    up = frame.ascending()
    over_buckets = Window.orderBy(BUCKET)
    place = F.struct(*frame.order)

    local: dict[str, Column] = {}
    part: dict[str, Column] = {}
    carried: dict[str, Column] = {}
    for name, (kind, col) in wanted.items():
        at = F.col(name)
        if kind in ("max", "max_before"):
            local[name] = F.max(col).over(up.rowsBetween(first, here if kind == "max" else prior))
            part[name] = F.max(col)
            carried[name] = F.max(at).over(over_buckets.rowsBetween(first, prior))
        elif kind == "sum":
            local[name] = F.coalesce(F.sum(col).over(up.rowsBetween(first, here)), F.lit(0))
            part[name] = F.sum(col)
            carried[name] = F.coalesce(F.sum(at).over(over_buckets.rowsBetween(first, prior)), F.lit(0))
        elif kind == "lag":
            local[name] = F.lag(F.struct(col.alias("v"))).over(up)
            part[name] = F.max_by(F.struct(col.alias("v")), place)
            carried[name] = F.lag(at).over(over_buckets)
        elif kind == "lead":
            local[name] = F.lead(F.struct(col.alias("v"))).over(up)
            part[name] = F.min_by(F.struct(col.alias("v")), place)
            carried[name] = F.lead(at).over(over_buckets)
        else:
            raise ValueError(f"unknown running value {kind!r}")

    out = frame.df.select("*", *[c.alias(n) for n, c in local.items()])
    if frame.n_buckets > 1:
        parts = frame.df.groupBy(BUCKET).agg(*[c.alias(n) for n, c in part.items()])
        carry = parts.select(BUCKET, *[c.alias(f"__carry_{n}") for n, c in carried.items()])
        # one row per bucket, at most MAX_BUCKETS
        out = out.join(F.broadcast(carry), BUCKET, "left")

    final: list[Column] = []
    for name, (kind, _) in wanted.items():
        value = F.col(name)
        if frame.n_buckets > 1:
            extra = F.col(f"__carry_{name}")
            if kind in ("max", "max_before"):
                value = F.greatest(value, extra)
            elif kind == "sum":
                value = value + F.coalesce(extra, F.lit(0))
            else:
                value = F.coalesce(value, extra)
        if kind in ("lag", "lead"):
            value = value["v"]
        final.append(value.alias(name))
    kept = [F.col(c) for c in frame.df.columns if c != BUCKET]
    return out.select(*kept, *final)


def with_row_number(df: DataFrame, order: list[str], name: str = "row_number", **options) -> DataFrame:
    """Global row number, 1-based, over a total order."""
    return scan(order_frame(df, order, **options), **{name: ("sum", F.lit(1).cast("bigint"))})


def number_within(df: DataFrame, by: list[str], order: list[str], name: str, **options) -> DataFrame:
    """Row number within each ``by`` group, 1-based; a large group may span several buckets.

    Rows are numbered per bucket and group. Only the first group of a bucket can have rows
    in earlier buckets; how many is chained up over the buckets' first and last groups.
    """
    frame = order_frame(df, [*by, *order], **options)
    window = Window.partitionBy(BUCKET, *by).orderBy(*order)
    numbered = frame.df.withColumn(name, F.row_number().over(window).cast("bigint"))
    if frame.n_buckets == 1:
        return numbered.drop(BUCKET)
    group = F.struct(*by)
    edges = (
        frame.df.groupBy(BUCKET, *by)
        .agg(F.count("*").alias("n"))
        .groupBy(BUCKET)
        .agg(F.min(group).alias("first"), F.max(group).alias("last"), F.max_by("n", group).alias("n_last"))
        .orderBy(BUCKET)
        .collect()
    )
    offsets, open_group, so_far = [], None, 0
    for e in edges:
        before = so_far if e["first"] == open_group else 0
        if before:
            offsets.append((e[BUCKET], *e["first"], before))
        so_far = e["n_last"] + (before if e["first"] == e["last"] else 0)
        open_group = e["last"]
    schema = T.StructType([
        T.StructField(BUCKET, T.IntegerType()),
        *[T.StructField(f"__{c}", df.schema[c].dataType) for c in by],
        T.StructField("__offset", T.LongType()),
    ])
    spill = df.sparkSession.createDataFrame(offsets, schema).withColumnRenamed(BUCKET, "__b")
    same = F.col(BUCKET) == F.col("__b")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    # at most one row per bucket
    joined = numbered.join(F.broadcast(spill), same, "left")
    return joined.select(*df.columns, (F.col(name) + F.coalesce("__offset", F.lit(0))).alias(name))


def batch_numbers(df: DataFrame, order: list[str], batch_size: int, name: str = "batch", **options) -> DataFrame:
    """Number consecutive batches of ``batch_size`` rows, starting at 0."""
    numbered = with_row_number(df, order, "__row", **options)
    return numbered.withColumn(name, F.floor((F.col("__row") - 1) / batch_size)).drop("__row")


def _halo_rows(frame: OrderedFrame, size: int, columns: list[str]) -> DataFrame:
    """The last ``size`` rows before each bucket, tagged with the bucket that needs them.

    Small buckets may need rows of several predecessors, so the reach is worked out from
    the row counts of all buckets (one row per bucket).
    """
    spark = frame.df.sparkSession
    counts = sorted((r[BUCKET], r["count"]) for r in frame.df.groupBy(BUCKET).count().collect())
    starts = list(accumulate((n for _, n in counts), initial=0))
    reach = []
    for i, (bucket, n) in enumerate(counts):
        last = starts[i] + n
        for later in range(i + 1, len(counts)):
            if starts[later] > last + size - 1:
                break
            reach.append((bucket, last, counts[later][0], starts[later]))
    names = [BUCKET, "last", "target", "target_start"]
    targets = spark.createDataFrame(pa.table({n: pa.array([r[i] for r in reach], pa.int64()) for i, n in enumerate(names)}))
    tail = (
        frame.df.select(*columns, BUCKET, F.row_number().over(frame.descending()).alias("__from_end"))
        .filter(F.col("__from_end") <= size)
    )
    number = F.col("last") - F.col("__from_end") + 1
    return (
        tail.join(F.broadcast(targets), BUCKET)
        .filter(F.col("target_start") <= number + size - 1)
        .select(*columns, F.col("target").cast("int").alias(BUCKET))
    )


def _changes(column: pa.Array) -> np.ndarray:
    """True where a value differs from the one before it (nulls are equal to each other)."""
    head, tail = column.slice(0, len(column) - 1), column.slice(1)
    same = pc.or_(pc.fill_null(pc.equal(head, tail), False), pc.and_(head.is_null(), tail.is_null()))
    return ~same.to_numpy(zero_copy_only=False)


def _rolling_median_batches(groups: list[str], value: str, window: int, min_periods: int, kept: list[str], out: str):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, carried_group = np.empty(0), None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            change = np.zeros(batch.num_rows, dtype=bool)
            for g in groups:
                change[1:] |= _changes(batch.column(g))
            group_of = lambda i: tuple(batch.column(g)[i].as_py() for g in groups)
            if group_of(0) != carried_group:
                carried = np.empty(0)
            values = batch.column(value).cast(pa.float64()).to_numpy(zero_copy_only=False)
            series = pd.Series(np.concatenate([carried, values]))
            segment = np.concatenate([np.zeros(len(carried), dtype=np.int64), np.cumsum(change)])
            if segment[-1] == 0:
                rolled = series.rolling(window, min_periods=min_periods).median()
            else:
                rolled = series.groupby(segment).rolling(window, min_periods=min_periods).median()
            medians = rolled.to_numpy()[len(carried):]
            tail = series.to_numpy()[segment == segment[-1]]
            carried, carried_group = tail[max(0, len(tail) - window + 1):], group_of(batch.num_rows - 1)

            own = pa.array(~batch.column(HALO).to_numpy(zero_copy_only=False))
            result = pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(medians, type=pa.float64(), from_pandas=True)],
                names=[*kept, out],
            )
            yield result.filter(own)

    return apply


def rolling_median(
    df: DataFrame,
    value: str,
    order: list[str],
    window: int = 100,
    min_periods: int = 1,
    by: list[str] | tuple[str, ...] = (),
    out: str = "rolling_median",
    **options,
) -> DataFrame:
    """Median over the last ``window`` rows of the global order, or per ``by`` group.

    NaN and NULL are skipped. Buckets are sorted by Spark and stream through pandas' rolling
    median in Arrow batches, carrying ``window - 1`` values from batch to batch, so neither a
    large bucket nor a large group is ever held in memory. Spark's framed ``percentile``
    gives the same values but rebuilds each frame, an order of magnitude slower.
    """
    frame = order_frame(df, [*by, *order], **options)
    rows = frame.df.withColumn(HALO, F.lit(False))
    if frame.n_buckets > 1 and window > 1:
        halo = _halo_rows(frame, window - 1, list(dict.fromkeys([*frame.order, value])))
        rows = rows.unionByName(halo.withColumn(HALO, F.lit(True)), allowMissingColumns=True)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])
    spread = rows.repartition(BUCKET).sortWithinPartitions(BUCKET, *frame.order)
    return spread.mapInArrow(
        _rolling_median_batches([BUCKET, *by], value, window, min_periods, df.columns, out),
        schema,
    )
