"""Scalar column functions: time, paths, names, hashing."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Formats and prefixes of the input data.
DAY_OF_YEAR_FORMAT = "yyyy/D/HH:mm:ss"
ISO_MILLIS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
OBJECT_STORE_PREFIX = "^(minio://|/minio/|minio/)"
CHUNK_FILE_FORMAT = "row_groups_%05d_to_%05d.parquet"

HASH_RANGE = 2**32


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch as BIGINT (session time zone UTC)."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def to_micros(delta: timedelta) -> int:
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def parse_day_of_year(text: Column | str) -> Column:
    """``2021/045/10:11:12`` (or ``2021/45/..``) to TIMESTAMP; NULL when malformed."""
    return F.try_to_timestamp(_c(text), F.lit(DAY_OF_YEAR_FORMAT))


def path_year(path: Column | str) -> Column:
    """First run of four digits in a path, NULL when there is none."""
    year = F.regexp_extract(_c(path), r"\d{4}", 0)
    return F.when(year != "", year.cast("int"))


def normalize_path(path: Column | str, scheme: str = "s3a://") -> Column:
    """Object-store path prefixes to one URI scheme; only the prefix is touched."""
    return F.regexp_replace(_c(path), OBJECT_STORE_PREFIX, scheme)


def last_part(text: Column | str, separator: str = "-") -> Column:
    return F.element_at(F.split(_c(text), separator), -1)


def chunk_file_name(first: Column | str, last: Column | str) -> Column:
    return F.format_string(CHUNK_FILE_FORMAT, _c(first), _c(last))


def plus(ts: Column | str, delta: timedelta) -> Column:
    """``ts + delta``, keeping the timestamp type of ``ts``."""
    us = to_micros(delta)
    seconds = F.lit(us).cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(18,0)")
    return _c(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def iso_millis(ts: Column | str) -> Column:
    return F.date_format(_c(ts), ISO_MILLIS_FORMAT)


def unique_run_name(prefix: str) -> Column:
    """``prefix-yyyymmdd-hhmmss-xxxxxxxx`` with eight hex digits of a random UUID."""
    stamp = F.date_format(F.current_timestamp(), "yyyyMMdd-HHmmss")
    return F.concat_ws("-", F.lit(prefix), stamp, F.substring(F.uuid(), 1, 8))


def hash_draw(keys: list[Column | str], seed: int) -> Column:
    """A uniform draw in ``[0, 2^32)`` per key, the same under every partitioning."""
    text = F.concat_ws(":", F.lit(str(seed)), *[_c(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def threshold_value(j: Column, low: float, high: float, n: int) -> Column:
    """The j-th of ``n`` evenly spaced thresholds, both ends exact."""
    low, high = float(low), float(high)
    step = (high - low) / (n - 1) if n > 1 else 0.0
    inner = j.cast("double") * F.lit(step) + F.lit(low)
    return F.when(j == n - 1, F.lit(high if n > 1 else low)).otherwise(inner)


def threshold_grid(spark: SparkSession, low: float, high: float, n: int) -> DataFrame:
    """The grid as a frame ``(j, threshold)``."""
    j = F.col("id").cast("int")
    return spark.range(0, n, 1, 1).select(j.alias("j"), threshold_value(j, low, high, n).alias("threshold"))
