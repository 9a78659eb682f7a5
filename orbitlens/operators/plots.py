"""Data behind the plots: sampled points and the bands to shade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitlens.operators.evaluation import NLL, SMOOTHED
from orbitlens.operators.intervals import runs
from orbitlens.operators.sampling import sample_rows


def _points(df: DataFrame, series: str, ts: str, y: Column) -> DataFrame:
    return df.select(F.lit(series).alias("series"), F.col(ts).alias("ts"), y.cast("double").alias("y"))


def split_plot(train: DataFrame, test: DataFrame, ts: str, keys: list[str], column: str, label: str,
               fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Sampled train and test series and the anomaly line, as ``(series, ts, y)`` by time."""
    train, test = (sample_rows(f, keys, fraction, seed) for f in (train, test))
    return (
        _points(train, "train", ts, F.col(column))
        .unionByName(_points(test, "test", ts, F.col(column)))
        .unionByName(_points(test, "anomalies", ts, F.col(label)))
        .orderBy("ts", "series")
    )


def result_points(results: DataFrame, ts: str, keys: list[str], fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Sampled log-likelihood and its smoothed line, as ``(series, ts, y)`` by time."""
    drawn = sample_rows(results, keys, fraction, seed)
    return (
        _points(drawn, "log_likelihood", ts, -F.col(NLL))
        .unionByName(_points(drawn, "log_likelihood_smoothed", ts, -F.col(SMOOTHED)))
        .orderBy("ts", "series")
    )


def result_bands(results: DataFrame, ts: str, keys: list[str], label: str, **options) -> DataFrame:
    """Test stretches and anomalies over the whole results, as ``(kind, start, end)``."""
    test = runs(results, ts, keys, F.col("dataset") == "test", **options).withColumn("kind", F.lit("test"))
    anomaly = runs(results, ts, keys, F.col(label) == 1, **options).withColumn("kind", F.lit("anomaly"))
    return test.unionByName(anomaly).select("kind", "start", "end")
