"""Preprocessing job: scan, keep float columns, sample, sort, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.operators.sampling import sample_rows
from orbitlens.operators.scaling import select_features
from orbitlens.sources.readers import uri

ROW_KEY = "row_key"


def keyed_telemetry(spark: SparkSession, paths: str | list[str], ts: str) -> DataFrame:
    """Telemetry with a unique ``row_key``: the file and the position of the row in it."""
    paths = [paths] if isinstance(paths, str) else paths
    raw = spark.read.parquet(*[uri(p) for p in paths])
    position = F.format_string("%s:%012d", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return select_features(raw.withColumn(ROW_KEY, position), ts, [ROW_KEY])


def preprocess(telemetry: DataFrame, ts: str, keys: list[str], fraction: float, seed: int = 42) -> DataFrame:
    """A sample of the float columns in time order; the sort is a distributed range sort."""
    sampled = sample_rows(select_features(telemetry, ts, keys), keys, fraction, seed)
    return sampled.orderBy(ts, *keys)


def run_preprocessing(spark: SparkSession, paths: str | list[str], ts: str, fraction: float, target: str,
                      seed: int = 42) -> DataFrame:
    """Sample the archives below ``paths`` into one sorted Parquet table and read it back."""
    frame = preprocess(keyed_telemetry(spark, paths, ts), ts, [ROW_KEY], fraction, seed)
    frame.write.parquet(target)
    return spark.read.parquet(target)
