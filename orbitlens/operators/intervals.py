"""Interval operators: merge periods, mark rows inside periods, find runs, spread hits."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orbitlens.functions.scalars import micros, plus
from orbitlens.operators import period_index
from orbitlens.operators.ordered import order_frame, scan
from orbitlens.session import materialize

def merge_periods(
    periods: DataFrame,
    start: str = "start",
    end: str = "end",
    gap: timedelta = timedelta(0),
    closed: bool = False,
    **options,
) -> DataFrame:
    """Disjoint periods covering the same instants as the input, as ``(start, end)``.

    Periods that overlap, touch, or lie at most ``gap`` apart become one. Null ends, and for
    half-open periods empty ones, cover nothing and are dropped.
    """
    nonempty = F.col("start") <= F.col("end") if closed else F.col("start") < F.col("end")
    rows = periods.select(F.col(start).alias("start"), F.col(end).alias("end")).filter(nonempty)
    # equal periods say nothing new: one of each keeps a hot start out of a single bucket
    frame = order_frame(rows.distinct(), ["start", "end"], **options)
    reach = scan(frame, before=("max_before", F.col("end")))
    opening = reach.filter(F.col("before").isNull() | (F.col("start") > plus("before", gap)))
    if frame.n_buckets == 1:
        last = rows.agg(F.max("end").alias("last"))
        tail = Window.orderBy("start")
        closing = opening.select("start", F.lead("before").over(tail).alias("end"))
    else:
        opening = materialize(opening.select("start", "before"), "merged")
        last = rows.agg(F.max("end").alias("last"))
        following = scan(order_frame(opening, ["start"], **options), end=("lead", F.col("before")))
        closing = following.select("start", "end")
    final = F.lit(last.first()["last"]).cast(rows.schema["end"].dataType)
    return closing.select("start", F.coalesce("end", final).alias("end"))


def windows_around(rows: DataFrame, ts: str, width: timedelta, **options) -> DataFrame:
    """Disjoint closed windows ``[t - width, t + width]`` around every ``ts`` of ``rows``."""
    merged = merge_periods(period_index.stretches(rows, ts, width), gap=2 * width, closed=True, **options)
    return merged.select(plus("start", -width).alias("start"), plus("end", width).alias("end"))


def mark_inside(
    df: DataFrame,
    ts: str,
    periods: DataFrame,
    out: str,
    closed: bool = False,
    disjoint: bool = False,
    method: str = "index",
    key: list[str] | tuple[str, ...] = (),
    **options,
) -> DataFrame:
    """1 for rows inside any period (half-open, or closed), else 0.

    ``index``: up to a million periods are broadcast as sorted arrays and searched in Arrow batches,
    without moving a row; more of them go by ``scan``, or for a stream by ``cells``.
    ``scan``: one ordered pass over rows and period starts, with one exchange of the rows; a row is
    inside when the largest end seen so far lies beyond it. ``key`` splits rows that share one
    timestamp in that pass.
    ``cells``: a disjoint period of length l gets the least level k with 2**k >= l and touches at
    most two of the cells of width 2**k. Rows are joined on their cell once for each level in use.
    """
    if method == "index":
        index = period_index.build(periods, closed=closed)
        if index is not None:
            return _mark_by_index(df, ts, index, out)
        method = "cells" if df.isStreaming else "scan"
    if method not in ("cells", "scan"):
        raise ValueError(f"unknown method {method!r}")
    if method == "scan":
        return _mark_by_scan(df, ts, periods, out, closed, key, **options)
    if not disjoint:
        periods = materialize(merge_periods(periods, closed=closed, **options), "periods")
    return _mark_by_cells(df, ts, periods, out, closed)


def _mark_by_index(df: DataFrame, ts: str, index: period_index.PeriodIndex, out: str) -> DataFrame:
    return df.select(*[F.col(c) for c in df.columns if c != out], index.column(df.sparkSession, ts).alias(out))


def _mark_by_cells(df: DataFrame, ts: str, periods: DataFrame, out: str, closed: bool) -> DataFrame:
    start, end = micros("start"), micros("end")
    last = end if closed else end - 1
    # bits of length - 1: the least k with 2**k >= length
    level = F.length(F.bin(last - start)) - F.when(last == start, 1).otherwise(0)
    cells = F.array_distinct(F.array(F.expr("shiftright(s, level)"), F.expr("shiftright(last, level)")))
    entries = (
        periods.where(start <= last).select(start.alias("s"), last.alias("last"), level.cast("int").alias("level"))
        .select("s", "last", "level", F.explode(cells).alias("cell"))
    )
    levels = [r["level"] for r in entries.select("level").distinct().orderBy("level").collect()]
    marked = df.withColumn("__us", micros(ts))
    for k in levels:
        part = entries.where(F.col("level") == k).select(
            F.col("cell").alias(f"__cell{k}"), F.col("s").alias(f"__s{k}"), F.col("last").alias(f"__last{k}"))
        inside = F.col("__us").between(F.col(f"__s{k}"), F.col(f"__last{k}"))
        marked = marked.join(part, (F.shiftright("__us", k) == F.col(f"__cell{k}")) & inside, "left")
    hit = F.coalesce(*[F.col(f"__s{k}") for k in levels]).isNotNull() if levels else F.lit(False)
    return marked.select(*[F.col(c) for c in df.columns if c != out], hit.cast("int").alias(out))


def _mark_by_scan(df, ts, periods, out, closed, key, **options) -> DataFrame:
    kind = df.schema[ts].dataType
    nonempty = F.col("start") <= F.col("end") if closed else F.col("start") < F.col("end")
    # of several periods with one start only the longest matters
    opens = (
        periods.filter(nonempty)
        .groupBy(F.col("start").cast(kind).alias(ts))
        .agg(F.max(F.col("end").cast(kind)).alias("__end"))
        .withColumn("__row", F.lit(0))
    )
    rows = df.withColumn("__row", F.lit(1)).unionByName(opens, allowMissingColumns=True)
    seen = scan(order_frame(rows, [ts, "__row", *key], **options), __reach=("max", F.col("__end")))
    inside = F.col(ts) <= F.col("__reach") if closed else F.col(ts) < F.col("__reach")
    kept = [F.col(c) for c in df.columns if c != out]
    return seen.filter(F.col("__row") == 1).select(*kept, F.coalesce(inside, F.lit(False)).cast("int").alias(out))


def label_rows(
    df: DataFrame, ts: str, periods: DataFrame, label: str, start: str = "start", end: str = "end", **options
) -> DataFrame:
    """Label rows 1 when ``start <= ts < end`` for any period, else 0."""
    named = periods.select(F.col(start).alias("start"), F.col(end).alias("end"))
    return mark_inside(df, ts, named, label, **options)


def mark_near(
    df: DataFrame, ts: str, positive: Column, width: timedelta, out: str = "is_test",
    key: list[str] | tuple[str, ...] = (), method: str = "index", **options
) -> DataFrame:
    """1 for rows at most ``width`` away from a row where ``positive`` holds (both ends in)."""
    rows = df.filter(positive)
    if method == "index":
        index = period_index.build(period_index.stretches(rows, ts, width), gap=2 * width, closed=True)
        if index is not None:
            return _mark_by_index(df, ts, index.widened(width), out)
        method = "scan"
    windows = materialize(windows_around(rows, ts, width, **options), "windows")
    return mark_inside(df, ts, windows, out, closed=True, disjoint=True, method=method, key=key, **options)


def runs(df: DataFrame, ts: str, key: list[str], condition: Column, **options) -> DataFrame:
    """Runs of consecutive rows (by ``ts, key``) where ``condition`` holds, as ``(start, end)``.

    The end is the timestamp of the first row after the run, or the last timestamp of all
    for a run that is still open.
    """
    slim = df.select(ts, *key, F.coalesce(condition, F.lit(False)).alias("__on"))
    order = [ts, *key]
    seen = scan(
        order_frame(slim, order, **options),
        __prev=("lag", F.col("__on")),
        __next=("lead", F.struct(F.col("__on").alias("on"), F.col(ts).alias("ts"))),
    )
    opens = ~F.coalesce(F.col("__prev"), F.lit(False))
    closes = ~F.coalesce(F.col("__next")["on"], F.lit(False))
    edges = materialize(
        seen.filter(F.col("__on") & (opens | closes)).select(
            *order,
            opens.alias("opens"),
            F.when(closes, F.coalesce(F.col("__next")["ts"], F.col(ts))).alias("end"),
        ),
        "runs",
    )
    paired = scan(order_frame(edges, order, **options), following=("lead", F.col("end")))
    return paired.filter("opens").select(F.col(ts).alias("start"), F.coalesce("end", "following").alias("end"))


def event_stamps(df: DataFrame, ts: str, key: list[str], label: str, rank: Column, **options) -> DataFrame:
    """One row per timestamp with the events that cover it.

    An event is a run of rows with label 1; as a closed range of timestamps it covers all
    rows from its first row to the first row after it. Rows are first reduced to one per
    timestamp, so a timestamp shared by many rows costs one row from there on.

    Columns: ``ts``, ``own`` (smallest rank at this timestamp, NULL ranks never count),
    ``positives`` (rows with label 1), ``covered``, and ``prev_event`` / ``next_event``:
    the event entered before this timestamp and the one that opens on it. Events overlap
    at their ends at most, so there are no others; an event inside one single timestamp
    adds nothing beyond ``own`` and gets no number.
    """
    on = F.coalesce(F.col(label) == 1, F.lit(False))
    # a single key column keeps the aggregate hash-based; a struct of keys has it sorted
    place = F.col(key[0]) if len(key) == 1 else F.struct(*key)
    slim = df.select(F.col(ts).alias("ts"), place.alias("place"), on.alias("on"), rank.alias("rank"))
    stamps = slim.groupBy("ts").agg(
        F.min("rank").alias("own"),
        F.sum(F.col("on").cast("bigint")).alias("positives"),
        (~F.min("on")).alias("has_off"),
        F.max_by("on", "place").alias("last_on"),
    )
    frame = order_frame(materialize(stamps, "stamps"), ["ts"], **options)
    seen = scan(frame, before=("lag", F.col("last_on")), after=("lead", F.col("ts")))
    enters = F.coalesce(F.col("before"), F.lit(False))
    is_last = F.col("after").isNull()
    opening = F.col("last_on") & ~is_last & (F.col("has_off") | ~enters)
    flagged = seen.select(
        "ts",
        "own",
        "positives",
        ((F.col("positives") > 0) | enters).alias("covered"),
        enters.alias("enters"),
        opening.cast("bigint").alias("opening"),
    )
    if frame.n_buckets > 1:
        flagged = materialize(flagged, "stamps")
    numbered = scan(
        order_frame(flagged, ["ts"], **{**options, "n_buckets": frame.n_buckets}), number=("sum", F.col("opening"))
    )
    return numbered.select(
        "ts",
        "own",
        "positives",
        "covered",
        F.when(F.col("enters"), F.col("number") - F.col("opening")).alias("prev_event"),
        F.when(F.col("opening") == 1, F.col("number")).alias("next_event"),
    )


def event_ranks(stamps: DataFrame) -> DataFrame:
    """Smallest rank inside each numbered event, as ``(event, rank)``; events without any are left out."""
    return (
        stamps.filter(F.col("own").isNotNull())
        .select(F.explode(F.array_compact(F.array("prev_event", "next_event"))).alias("event"), "own")
        .groupBy("event")
        .agg(F.min("own").alias("rank"))
    )


def with_event_rank(stamps: DataFrame, ranks: DataFrame) -> DataFrame:
    """Add ``best``: the smallest rank of the events a timestamp belongs to, ``own`` included.

    Most rows lack one of the two events. Their join key is a negative number that matches
    nothing, drawn from the row, so that they do not all meet in one partition.
    """
    apart = -1 - F.pmod(F.xxhash64(*stamps.columns), F.lit(1 << 20))
    keyed = stamps.withColumn("__a", F.coalesce("prev_event", apart)).withColumn("__b", F.coalesce("next_event", apart))
    prev = ranks.select(F.col("event").alias("__a"), F.col("rank").alias("__prev"))
    following = ranks.select(F.col("event").alias("__b"), F.col("rank").alias("__next"))
    joined = keyed.join(prev, "__a", "left").join(following, "__b", "left")
    return joined.select(*stamps.columns, F.least("own", "__prev", "__next").alias("best"))


def event_totals(stamps: DataFrame) -> DataFrame:
    """Stamps reduced to one row per event (or pair of touching events).

    Timestamps outside any numbered event are kept apart by their own rank (``lone``).
    """
    alone = F.col("prev_event").isNull() & F.col("next_event").isNull()
    return stamps.groupBy("prev_event", "next_event", F.when(alone, F.col("own")).alias("lone")).agg(
        F.sum("positives").alias("positives"), F.min("own").alias("own")
    )


def mark_reached(df: DataFrame, ts: str, stamps: DataFrame, ranks: DataFrame, upto: int, hit: str, out: str):
    """Spread ``hit`` over every event whose smallest rank is at most ``upto``."""
    reached = with_event_rank(stamps, ranks).filter(F.col("covered") & (F.col("best") <= upto))
    joined = df.join(reached.select(F.col("ts").alias(ts), F.lit(1).alias("__reached")), ts, "left")
    flag = F.greatest(F.coalesce(F.col("__reached"), F.lit(0)), F.col(hit)).cast("int")
    return joined.select(*[F.col(c) for c in df.columns if c != out], flag.alias(out))


def spread_hits(df: DataFrame, ts: str, key: list[str], label: str, hit: str, out: str, **options) -> DataFrame:
    """Mark every row of an event once any of its rows is hit; other rows keep their own hit."""
    stamps = event_stamps(df, ts, key, label, F.when(F.col(hit) == 1, 0), **options)
    return mark_reached(df, ts, stamps, event_ranks(stamps), 0, hit, out)
