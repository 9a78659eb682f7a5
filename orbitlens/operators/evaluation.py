"""Smoothed scores, predictions, and metrics over all thresholds in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orbitlens.functions.scalars import threshold_grid, threshold_value
from orbitlens.operators.intervals import (
    event_ranks,
    event_stamps,
    event_totals,
    mark_reached,
    spread_hits,
    with_event_rank,
)
from orbitlens.operators.ordered import rolling_median
from orbitlens.session import materialize

NLL, SMOOTHED = "neg_log_likelihood", "smoothed_neg_log_likelihood"
SMOOTHING_ROWS = 100


def latent_columns(df: DataFrame, n: int, arrays: tuple[str, ...] = ("mean_z", "log_var_z")) -> DataFrame:
    """Array elements as scalar columns ``mean_z_0``, ``log_var_z_0``, ..."""
    flat = [F.get(a, F.lit(i)).alias(f"{a}_{i}") for i in range(n) for a in arrays]
    return df.select(*[c for c in df.columns if c not in arrays], *flat)


def result_frame(
    test: DataFrame, validation: DataFrame, ts: str, key: list[str], label: str, latent: int = 0, **options
) -> DataFrame:
    """Scored test and validation rows in one frame, smoothed over their common time order.

    Both frames carry ``neg_log_likelihood``; validation rows get label 0.
    """
    tagged = [
        test.withColumn("dataset", F.lit("test")),
        validation.withColumn("dataset", F.lit("validation")).withColumn(label, F.lit(0)),
    ]
    arrays = ["mean_z", "log_var_z"] if latent else []
    columns = [ts, *key, NLL, "dataset", label, *arrays]
    both = tagged[0].select(*columns).unionByName(tagged[1].select(*columns))
    if latent:
        both = latent_columns(both, latent)
    return rolling_median(both, NLL, [ts, *key], SMOOTHING_ROWS, out=SMOOTHED, **options)


def _score(smoothed: str) -> Column:
    return -F.nanvl(F.col(smoothed), F.lit(None).cast("double"))


def predict_points(df: DataFrame, threshold: float, smoothed: str = SMOOTHED, out: str = "prediction_point"):
    """1 where the smoothed log-likelihood lies strictly below the threshold."""
    return df.withColumn(out, F.coalesce((_score(smoothed) < threshold).cast("int"), F.lit(0)))


def predict_events(df: DataFrame, ts: str, key: list[str], label: str, **options) -> DataFrame:
    """Add ``prediction_event``: one predicted row marks its entire event."""
    return spread_hits(df, ts, key, label, "prediction_point", "prediction_event", **options)


def with_threshold_rank(df: DataFrame, smoothed: str, low: float, high: float, n: int, out: str = "j") -> DataFrame:
    """Add the index of the first threshold strictly above the score, ``n`` when there is none.

    An arithmetic guess, corrected against the very threshold values of the grid. Score and
    guess are columns of their own so that each is worked out once per row.
    """
    step = (float(high) - float(low)) / (n - 1) if n > 1 else 1.0
    guess = F.floor((F.col("__score") - low) / (step or 1.0))
    staged = df.withColumn("__score", _score(smoothed)).withColumn(
        "__guess", F.least(F.greatest(guess, F.lit(-2)), F.lit(n)).cast("int")
    )
    found = F.lit(n)
    for offset in (2, 1, 0, -1):
        j = F.col("__guess") + offset
        found = F.when(j.between(0, n - 1) & (threshold_value(j, low, high, n) > F.col("__score")), j).otherwise(found)
    return staged.withColumn(out, found).drop("__score", "__guess")


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


@dataclass(frozen=True)
class Sweep:
    """What one pass leaves behind: metrics per threshold, and the events to predict from."""

    metrics: DataFrame
    stamps: DataFrame
    ranks: DataFrame


def sweep_events(
    df: DataFrame,
    ts: str,
    key: list[str],
    label: str,
    low: float,
    high: float,
    n: int,
    smoothed: str = SMOOTHED,
    **options,
) -> Sweep:
    """:func:`threshold_sweep` together with the events behind it."""
    positive = F.coalesce(F.col(label) == 1, F.lit(False)).cast("bigint")
    slim = with_threshold_rank(df.select(ts, *key, label, smoothed), smoothed, low, high, n).drop(smoothed)
    zero = F.lit(0).cast("bigint")

    points = slim.groupBy("j").agg(F.count("*").alias("predicted"), F.sum(positive).alias("hits"))
    stamps = event_stamps(slim, ts, key, label, F.when(F.col("j") < n, F.col("j")), **options)
    events = materialize(event_totals(stamps), "events")
    ranks = event_ranks(events)
    found = with_event_rank(events.filter("positives > 0"), ranks).filter("best is not null")

    tallies = (
        threshold_grid(df.sparkSession, low, high, n)
        .select("j", zero.alias("predicted"), zero.alias("hits"), zero.alias("found"))
        .unionByName(points.select("j", "predicted", "hits", zero.alias("found")))
        .unionByName(found.select(F.col("best").alias("j"), zero.alias("predicted"), zero.alias("hits"),
                                  F.col("positives").alias("found")))
        .groupBy("j")
        .agg(*[F.sum(c).alias(c) for c in ("predicted", "hits", "found")])
    )
    # at most n + 1 rows from here on
    upto = Window.orderBy("j").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("j").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = tallies.select(
        "j",
        *[F.sum(c).over(upto).alias(c) for c in ("predicted", "hits", "found")],
        F.sum("hits").over(everything).alias("positives"),
    ).filter(F.col("j") < n)
    precision, recall = _ratio(F.col("hits"), F.col("predicted")), _ratio(F.col("found"), F.col("positives"))
    metrics = running.select(
        threshold_value(F.col("j"), low, high, n).alias("threshold"),
        precision.alias("point_precision"),
        recall.alias("event_recall"),
    ).withColumn("composite_f1", f1(F.col("point_precision"), F.col("event_recall")))
    return Sweep(metrics, stamps, ranks)


def threshold_sweep(
    df: DataFrame, ts: str, key: list[str], label: str, low: float, high: float, n: int, smoothed: str = SMOOTHED,
    **options,
) -> DataFrame:
    """Point precision, event recall and composite F1 at each of ``n`` ascending thresholds.

    A row is predicted from the first threshold above its score on, an event from the
    smallest such index among its rows on. Counting rows by that index and summing up over
    the grid replaces one evaluation of the whole frame per threshold. ``df`` is read twice.
    """
    return sweep_events(df, ts, key, label, low, high, n, smoothed, **options).metrics


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The metrics record: highest F1, lowest threshold among equals; zeros when nothing is found."""
    zeroed = [F.when(F.col("composite_f1") > 0, F.col(c)).otherwise(0.0).alias(c)
              for c in ("point_precision", "event_recall")]
    return (
        sweep.orderBy(F.desc("composite_f1"), "threshold")
        .limit(1)
        .select(*zeroed, "composite_f1", F.col("threshold").alias("best_threshold"))
    )


def metrics_at_threshold(df: DataFrame, ts: str, key: list[str], label: str, threshold: float, **options):
    """Metrics at one threshold, as a one-row frame."""
    return threshold_sweep(df, ts, key, label, threshold, threshold, 1, **options).drop("threshold")


def evaluate(
    results: DataFrame,
    ts: str,
    key: list[str],
    label: str,
    low: float = -1500,
    high: float = 0,
    n: int = 500,
    predict_at: str = "last",
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Results with predictions, and the metrics record at the best threshold.

    ``results`` (from :func:`result_frame`) is written once and read back. Predictions are
    those at the last threshold of the grid, or with ``predict_at='best'`` at the best one.
    """
    if predict_at not in ("last", "best"):
        raise ValueError("predict_at is 'last' or 'best'")
    stored = materialize(results, "results")
    sweep = sweep_events(stored, ts, key, label, low, high, n, **options)
    metrics = best_threshold(sweep.metrics)
    at, upto = (float(high) if n > 1 else float(low)), n - 1
    if predict_at == "best":
        at = metrics.first()["best_threshold"]
        upto = threshold_grid(results.sparkSession, low, high, n).filter(F.col("threshold") == at).first()["j"]
    points = predict_points(stored, at)
    return mark_reached(points, ts, sweep.stamps, sweep.ranks, upto, "prediction_point", "prediction_event"), metrics
