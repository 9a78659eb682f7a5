"""Streaming: score JSON requests, label live telemetry. Stateless, so no watermark is needed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orbitlens.functions.likelihood import array_sum, log_density
from orbitlens.operators.intervals import mark_inside
from orbitlens.operators.model import Weights, infer_rows, nll_column
from orbitlens.operators.scaling import feature_vector
from orbitlens.sources.readers import REQUEST_SCHEMA

REQUESTS = "request_id bigint, body string"


def read_request_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of JSON-lines files holding ``request_id`` and ``body``."""
    reader = spark.readStream.schema(REQUESTS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def gaussian_score(features: list[str]) -> Column:
    """Closed-form score: the negative log-likelihood of scaled features under N(0, 1)."""
    return -array_sum(F.array(*[log_density(F.col(f), F.lit(0.0), F.lit(1.0)) for f in features]))


def score_requests(requests: DataFrame, features: list[str], scaler: dict[str, tuple[float, float]],
                   weights: Weights | None = None) -> DataFrame:
    """``(request_id, response, error)`` for a batch or a stream of requests.

    All rows of a request stay in one row as an array: they are scaled and scored element by
    element, so a stream needs no grouping. With ``weights`` the model scores, otherwise the
    closed form. Features missing in an instance make its score NULL; a malformed body gives
    an error instead of a response.
    """
    spark = requests.sparkSession
    rows = F.from_json("body", REQUEST_SCHEMA)["instances"]

    def scaled(instance: Column) -> Column:
        return F.array(*[(instance[f] - F.lit(scaler[f][0])) / F.lit(scaler[f][1]) for f in features])

    parsed = requests.select("request_id", F.transform(rows, scaled).alias("vectors"))
    if weights is None:
        parsed = parsed.withColumn(
            "predictions",
            F.transform("vectors", lambda v: -array_sum(F.transform(v, lambda x: log_density(x, F.lit(0.0), F.lit(1.0))))),
        )
    else:
        parsed = parsed.withColumn("predictions", _score_lists(spark, weights)(F.col("vectors")))
    good = F.col("predictions").isNotNull()
    return parsed.select(
        "request_id",
        F.when(good, F.to_json(F.struct("predictions"))).alias("response"),
        F.when(~good, F.lit("malformed request")).alias("error"),
    )


def _score_lists(spark: SparkSession, weights: Weights):
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("array<double>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for requests in batches:
            vectors = requests.flatten()
            flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            nll = infer_rows(shared.value, flat.reshape(len(vectors), -1))[-1] if len(vectors) else np.empty(0)
            counts = pc.fill_null(pc.list_value_length(requests), 0).to_numpy()
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            yield pa.ListArray.from_arrays(offsets, pa.array(nll, pa.float64(), from_pandas=True), mask=requests.is_null())

    return score


def score_vectors(df: DataFrame, features: list[str], scaler: dict[str, tuple[float, float]], weights: Weights,
                  out: str = "nll", dtype: str = "float32") -> DataFrame:
    """Scaled model score of feature columns, batch or stream."""
    scaled = [((F.col(f) - F.lit(scaler[f][0])) / F.lit(scaler[f][1])).alias(f) for f in features]
    kept = [c for c in df.columns if c not in features]
    vectors = df.select(*kept, *scaled).withColumn(
        "__v", feature_vector(features, "double" if dtype == "float64" else "float")
    )
    return vectors.withColumn(out, nll_column(df.sparkSession, F.col("__v"), weights, dtype)).drop("__v")


def label_stream(telemetry: DataFrame, ts: str, periods: DataFrame, label: str) -> DataFrame:
    """Label a stream against the static periods (half-open), as the batch operator does."""
    return mark_inside(telemetry, ts, periods, label)


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all input available now to a Parquet table, and wait for it."""
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


__all__ = ["gaussian_score", "label_stream", "read_request_stream", "run_to_table", "score_requests", "score_vectors"]
