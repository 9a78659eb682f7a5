"""Readers: telemetry, archives, periods, parameters, scoring requests."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.functions.scalars import OBJECT_STORE_PREFIX, parse_day_of_year, path_year
from orbitlens.operators.scaling import select_features

REQUEST_SCHEMA = "instances array<map<string,double>>"


def uri(path: str, scheme: str = "s3a://") -> str:
    """The object-store prefixes of a path argument as one URI scheme."""
    return re.sub(OBJECT_STORE_PREFIX, scheme, path)


def read_frame(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(uri(path))


def read_telemetry(spark: SparkSession, paths: str | list[str], ts: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Telemetry of one or more paths or globs: timestamp, keys and every float column."""
    paths = [paths] if isinstance(paths, str) else paths
    return select_features(spark.read.parquet(*[uri(p) for p in paths]), ts, keys)


def read_archives(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """All archive files below a directory with ``year`` and position in the file.

    Returns the rows whose path names a year, and the paths of the files that name none.
    The year is looked for below the directory: in folder and file names, but not in the
    ``part-`` names Spark gives to the files of one archive. Paths are taken apart once a file, from the
    listing, and each year is a scan of its own: doing it for every row costs more than reading the row.
    """
    rows = spark.read.option("recursiveFileLookup", "true").parquet(uri(directory))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(uri(directory))
    below = F.element_at(F.split("archive", re.escape(uri(directory).rstrip("/")) + "/"), -1)
    year = path_year(F.regexp_replace(below, "(^|/)part-[^/]*$", "")).alias("year")
    listed = files.select("path", F.col("_metadata.file_path").alias("archive")).select("path", "archive", year).collect()
    found = None
    for at in sorted({f["year"] for f in listed if f["year"] is not None}):
        # the names are no patterns
        paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", f["path"]) for f in listed if f["year"] == at]
        part = spark.read.schema(rows.schema).parquet(*paths).select(
            "*", F.col("_metadata.file_path").alias("archive"), F.col("_metadata.row_index").alias("row_index"), F.lit(at).alias("year"))
        found = part if found is None else found.union(part)
    if found is None:
        found = rows.limit(0).select("*", *[F.lit(None).cast(k).alias(n) for n, k in (("archive", "string"), ("row_index", "long"), ("year", "int"))])
    return found, spark.createDataFrame([(f["archive"],) for f in listed if f["year"] is None], "archive string")


def read_periods(spark: SparkSession, path: str, start: str, end: str, format: str = "csv") -> DataFrame:
    """Anomaly periods with day-of-year texts as ``start`` and ``end``; other columns pass through.

    CSV and JSON are read as texts (no inference pass over the data).
    """
    if format == "csv":
        raw = spark.read.option("header", "true").csv(uri(path))
    else:
        raw = spark.read.format(format).load(uri(path))
    rest = [F.col(f"`{c}`") for c in raw.columns if c not in (start, end)]
    return raw.select(
        parse_day_of_year(F.col(f"`{start}`")).alias("start"), parse_day_of_year(F.col(f"`{end}`")).alias("end"), *rest
    )


def parse_requests(requests: DataFrame, body: str, id_column: str) -> tuple[DataFrame, DataFrame]:
    """Request bodies as rows ``(id, position, instance)``, and rejected bodies.

    A body must hold ``{"instances": [{feature: number, ...}, ...]}``.
    """
    parsed = requests.withColumn("__rows", F.from_json(body, REQUEST_SCHEMA)["instances"])
    rows = parsed.select(id_column, F.posexplode("__rows").alias("position", "instance"))
    return rows, parsed.filter(F.col("__rows").isNull()).select(id_column, body)


def instance_columns(rows: DataFrame, features: list[str], *kept: str) -> DataFrame:
    """Instance maps as feature columns; missing features become NULL, unknown ones are ignored."""
    return rows.select(*kept, *[F.col("instance")[f].alias(f) for f in features])
