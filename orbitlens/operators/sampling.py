"""Sampling and splitting by hashed keys: the same rows under every partitioning."""

from __future__ import annotations

import itertools
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.functions.scalars import HASH_RANGE, hash_draw
from orbitlens.operators.intervals import mark_near

TRAIN, VALIDATION, TEST = "train", "validation", "test"
_CUT_BINS = 65_536


def chosen(keys: list[Column | str], fraction: float, seed: int = 42) -> Column:
    """True for about ``fraction`` of all keys."""
    return hash_draw(keys, seed) < F.lit(fraction * HASH_RANGE)


def sample_rows(df: DataFrame, keys: list[str], fraction: float, seed: int = 42) -> DataFrame:
    return df.filter(chosen(keys, fraction, seed))


def _exact_cut(df: DataFrame, keys: list[str], fraction: float, seed: int) -> Column:
    """True for exactly ``round(fraction * n)`` rows (halves to even), smallest draws first.

    Two histograms, over the upper and then the lower half of the draw, find the draw of the
    last wanted row. Only the rows sharing that very draw are ranked, by key, and the cut
    becomes a row-wise predicate.
    """
    draw = hash_draw(keys, seed)
    upper, lower = F.floor(draw / _CUT_BINS), draw % _CUT_BINS

    def histogram(rows: DataFrame, part: Column) -> list:
        return rows.groupBy(part.alias("bin")).count().orderBy("bin").collect()

    def bin_of(bins: list, wanted: int) -> tuple[int, int]:
        """The bin the ``wanted``-th row falls in, and its rank there."""
        for r in bins:
            if wanted <= r["count"]:
                return r["bin"], wanted
            wanted -= r["count"]
        raise ValueError("rank beyond the last row")

    bins = histogram(df, upper)
    wanted = round(fraction * sum(r["count"] for r in bins))
    if wanted == 0:
        return F.lit(False)
    high, wanted = bin_of(bins, wanted)
    low, wanted = bin_of(histogram(df.filter(upper == high), lower), wanted)
    ties = df.filter(draw == high * _CUT_BINS + low).select(draw.alias("__draw"), *keys)
    last = ties.orderBy(*keys).offset(wanted - 1).first()
    bound = F.struct(*[F.lit(last[c]).cast(ties.schema[c].dataType).alias(c) for c in ["__draw", *keys]])
    return F.struct(draw.alias("__draw"), *keys) <= bound


def split_rows(
    df: DataFrame,
    ts: str,
    keys: list[str],
    label: str,
    window: timedelta,
    train_fraction: float = 0.8,
    seed: int = 42,
    exact: bool = False,
    out: str = "split",
    **options,
) -> DataFrame:
    """Add the split: rows near a labelled row are ``test``, the rest ``train`` / ``validation``.

    By default each remaining row draws for itself by its unique key, with no shuffle.
    ``exact`` takes exactly the rounded share of the remaining rows.
    """
    near = mark_near(df, ts, F.col(label) == 1, window, "__near", **{"key": keys, **options})
    is_train = (
        _exact_cut(near.filter("__near = 0"), keys, train_fraction, seed)
        if exact
        else chosen(keys, train_fraction, seed)
    )
    name = F.when(F.col("__near") == 1, TEST).when(is_train, TRAIN).otherwise(VALIDATION)
    return near.withColumn(out, name).drop("__near")


def split_frames(split: DataFrame, features: list[str], ts: str, keys: list[str], label: str, out: str = "split"):
    """The three frames: train and validation hold features only, test also the label."""
    slim = [ts, *keys, *features]
    return (
        split.filter(F.col(out) == TRAIN).select(*slim),
        split.filter(F.col(out) == VALIDATION).select(*slim),
        split.filter(F.col(out) == TEST).select(*slim, label),
    )


def drop_by_timestamp(rows: DataFrame, train: DataFrame, ts: str) -> DataFrame:
    """Rows whose timestamp no train row has: dropping by index value, duplicates included."""
    return rows.join(train.select(ts).distinct(), ts, "left_anti")


def draw_trials(spark: SparkSession, choices: dict[str, list[float]], max_trials: int, seed: int = 42) -> DataFrame:
    """Random search: ``max_trials`` combinations of the listed values without replacement.

    Values listed twice count twice. One column per parameter plus ``trial``, from 0.
    """
    names = list(choices)
    grid = [(i, *map(float, values)) for i, values in enumerate(itertools.product(*choices.values()))]
    schema = ", ".join(["combination int", *[f"`{n}` double" for n in names]])
    drawn = (
        spark.createDataFrame(grid, schema)
        .orderBy(hash_draw(["combination"], seed), "combination")
        .limit(max_trials)
        .collect()
    )
    return spark.createDataFrame(
        [(i, *[r[n] for n in names]) for i, r in enumerate(drawn)],
        ", ".join(["trial int", *[f"`{n}` double" for n in names]]),
    )
