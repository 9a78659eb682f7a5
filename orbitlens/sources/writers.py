"""Writers: frames, re-chunked archives, parameters, metrics, responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitlens.functions.scalars import chunk_file_name, last_part
from orbitlens.sources import row_groups


def write_frame(df: DataFrame, path: str, mode: str = "error", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def chunk_column(row_index: Column | str, rows_per_group: int, groups_per_chunk: int) -> Column:
    """First row group of the chunk a row belongs to."""
    index = F.col(row_index) if isinstance(row_index, str) else row_index
    group = F.floor(index / rows_per_group)
    return (group - group % groups_per_chunk).cast("int")


def chunk_rows(rows: DataFrame, rows_per_group: int, groups_per_chunk: int = 10, group_limit: int | None = None):
    """Add ``chunk`` from ``row_index``; rows beyond the group limit are left out as asked."""
    if group_limit is not None:
        rows = rows.filter(F.col("row_index") < group_limit * rows_per_group)
    return rows.withColumn("chunk", chunk_column("row_index", rows_per_group, groups_per_chunk))


def archive_name(path: Column | str) -> Column:
    """A folder-safe name of an archive: its file name and eight digits of the path's hash."""
    path = F.col(path) if isinstance(path, str) else path
    return F.concat_ws("-", F.regexp_replace(last_part(path, "/"), "[^A-Za-z0-9_.-]", "_"), F.substring(F.md5(path), 1, 8))


def list_chunks(chunks: DataFrame, ts: str, rows_per_group: int, groups_per_chunk: int = 10,
                *by: str) -> DataFrame:
    """One row per chunk: its file name, time range and row count."""
    last_group = F.floor(F.max("row_index") / rows_per_group).cast("int") + 1
    return (
        chunks.groupBy(*by, "year", "chunk")
        .agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("rows"), last_group.alias("stop"))
        .withColumn("file_name", chunk_file_name("chunk", "stop"))
        .drop("stop")
    )


def write_archive_chunks(
    rows: DataFrame,
    target: str,
    ts: str,
    rows_per_group: int,
    groups_per_chunk: int = 10,
    group_limit: int | None = None,
    mode: str = "error",
) -> DataFrame:
    """Write archives as ``year=/archive=/chunk=`` folders and return the list of chunks.

    The archive is part of a chunk's identity: two archives of one year keep their chunks apart.

    ``rows`` comes from :func:`orbitlens.sources.readers.read_archives`. Each chunk is one
    run of rows of one file, so rows go straight from the scan to the writer, without a
    shuffle; a file holds at most one chunk of rows. Chunks are small and many, so what counts
    is the price of a file: they are written by ``row_groups`` and listed from their footers.
    """
    target = target.rstrip("/")
    chunks, spark = chunk_rows(rows, rows_per_group, groups_per_chunk, group_limit), rows.sparkSession
    if mode not in ("error", "errorifexists", "append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    if row_groups.exists(target):
        if mode.startswith("error"):
            raise ValueError(f"{target} exists")
        if mode == "overwrite":
            row_groups.remove(target)
    row_groups.register(spark)
    names = rows.select("archive").distinct().withColumn("__name", archive_name("archive"))
    folder = F.concat(F.lit("year="), "year", F.lit("/archive="), "__name", F.lit("/chunk="), "chunk", F.lit("/"))
    placed = chunks.join(F.broadcast(names), "archive").withColumn("file_name", folder).drop("row_index", "__name")
    placed.write.format("chunk_files").mode("append").save(target)
    place = r"/year=(-?\d+)/archive=([^/]+)/chunk=(\d+)/[^/]+$"
    part = [F.regexp_extract("path", place, i + 1).cast(kind).alias(name)
            for i, (name, kind) in enumerate((("year", "int"), ("archive", "string"), ("chunk", "int")))]
    of = rows.schema[ts].dataType
    written = (
        row_groups.list_files(spark, target, ts)
        .groupBy(*part)
        .agg(F.min("start").cast(of).alias("start"), F.max("end").cast(of).alias("end"), F.sum("rows").alias("rows"))
    )
    stop = F.col("chunk") + F.ceil(F.col("rows") / rows_per_group).cast("int")
    return written.withColumn("file_name", chunk_file_name("chunk", stop))


def write_metrics(metrics: DataFrame, path: str, mode: str = "error") -> None:
    """The one-row metrics record as JSON."""
    metrics.coalesce(1).write.mode(mode).json(path)


def metric_rows(metrics: DataFrame) -> DataFrame:
    """The metrics record as ``(metric, value)`` rows."""
    return metrics.select(*[F.col(c).cast("double") for c in metrics.columns]).unpivot(
        [], metrics.columns, "metric", "value"
    )


def write_scaler(params: DataFrame, path: str, mode: str = "error") -> None:
    params.coalesce(1).write.mode(mode).parquet(path)


def write_weights(table: DataFrame, run_id: str, path: str, mode: str = "append") -> None:
    table.withColumn("run_id", F.lit(run_id)).coalesce(1).write.mode(mode).partitionBy("run_id").parquet(path)


def responses(scored: DataFrame, id_column: str, position: str = "position", score: str = "nll") -> DataFrame:
    """One JSON body per request: ``{"predictions": [...]}`` in request order.

    A group is one request, so it is no larger than the body it came from.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(score).alias("s"))))
    body = F.to_json(F.struct(F.transform(ordered, lambda e: e["s"]).alias("predictions")))
    return scored.groupBy(id_column).agg(body.alias("response"))


def instances_json(features: list[str]) -> Column:
    """Feature columns as one JSON object per row."""
    return F.to_json(F.struct(*features))
