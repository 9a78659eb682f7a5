"""Likelihood model: weights as a table, scoring in Arrow batches.

The network has two hidden ReLU layers on each side: an encoder from the features to the
mean and log-variance of the latent vector, a decoder back to the features, and one learned
log-variance per feature. Weights are a plain mapping of numpy arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitlens.functions.likelihood import LOG_SQRT_2PI
from orbitlens.operators.scaling import valid_width

Weights = dict[str, np.ndarray]

SIDES = ("encoder", "decoder")
WEIGHT_SCHEMA = "layer string, shape array<int>, data array<double>"


def layer_sizes(input_dim: int, hidden: int, latent: int) -> dict[str, tuple[int, ...]]:
    return {"encoder": (input_dim, hidden, hidden, 2 * latent), "decoder": (latent, hidden, hidden, input_dim)}


def init_weights(input_dim: int, hidden: int, latent: int, seed: int = 42) -> Weights:
    """Uniform in ``+-1/sqrt(fan_in)`` for weights and biases, log-variances 0."""
    rng = np.random.default_rng(seed)
    weights: Weights = {}
    for side, sizes in layer_sizes(input_dim, hidden, latent).items():
        for i, (fan_in, fan_out) in enumerate(zip(sizes, sizes[1:])):
            bound = 1 / np.sqrt(fan_in)
            weights[f"{side}.{i}.weight"] = rng.uniform(-bound, bound, (fan_in, fan_out))
            weights[f"{side}.{i}.bias"] = rng.uniform(-bound, bound, fan_out)
    weights["log_var_x"] = np.zeros(input_dim)
    return weights


def input_dim(weights: Weights) -> int:
    return len(weights["log_var_x"])


def latent_dim(weights: Weights) -> int:
    return weights["decoder.0.weight"].shape[0]


def weight_table(spark: SparkSession, weights: Weights) -> DataFrame:
    """Weights as rows ``(layer, shape, data)``."""
    rows = [(n, list(w.shape), w.astype(float).ravel().tolist()) for n, w in weights.items()]
    return spark.createDataFrame(rows, WEIGHT_SCHEMA)


def weights_from(table: DataFrame) -> Weights:
    """Weights back from their table (a handful of rows, bounded by the model size)."""
    return {r["layer"]: np.array(r["data"]).reshape(r["shape"]) for r in table.collect()}


def dense_pass(weights: Weights, side: str, x: np.ndarray) -> list[np.ndarray]:
    """Activations of one side, input first; the last layer is linear."""
    layers = [x]
    for i in range(3):
        x = x @ weights[f"{side}.{i}.weight"] + weights[f"{side}.{i}.bias"]
        if i < 2:
            x = np.maximum(x, 0)
        layers.append(x)
    return layers


def infer_rows(weights: Weights, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``mean_z, log_var_z, mean_x, nll`` of each row, with the latent mean as the draw."""
    code = dense_pass(weights, "encoder", x)[-1]
    latent = code.shape[1] // 2
    mean_z, log_var_z = code[:, :latent], code[:, latent:]
    mean_x = dense_pass(weights, "decoder", mean_z)[-1]
    log_var_x = weights["log_var_x"]
    terms = 0.5 * (x - mean_x) ** 2 * np.exp(-log_var_x) + 0.5 * log_var_x
    return mean_z, log_var_z, mean_x, terms.sum(axis=1) + x.shape[1] * LOG_SQRT_2PI


def matrix(column: pa.Array, width: int, dtype=np.float64) -> np.ndarray:
    """An Arrow list column as a matrix; every list must have ``width`` elements."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)


def _lists(values: np.ndarray, unknown: np.ndarray) -> pa.Array:
    """Rows as lists, with null elements in unknown ones."""
    flat = pa.array(np.ascontiguousarray(values, dtype=np.float64).ravel(), mask=np.repeat(unknown, values.shape[1]))
    offsets = pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, flat)


def infer(df: DataFrame, weights: Weights, features: str = "features", dtype: str = "float32") -> DataFrame:
    """Add ``mean_z``, ``log_var_z``, ``mean_x`` and ``neg_log_likelihood`` to each row.

    Rows must hold vectors of the model's width, see :func:`split_by_width`; what depends on a
    null element is null. The weights are broadcast: their size is fixed by the model, not by the data.
    """
    shared = df.sparkSession.sparkContext.broadcast({n: w.astype(dtype) for n, w in weights.items()})
    width, columns = input_dim(weights), df.columns
    added = [T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("mean_z", "log_var_z", "mean_x")]
    schema = T.StructType([*df.schema.fields, *added, T.StructField("neg_log_likelihood", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            *vectors, nll = infer_rows(shared.value, matrix(batch.column(features), width, dtype))
            missing = batch.column(features).flatten().is_null().to_numpy(zero_copy_only=False)
            unknown = missing.reshape(-1, width).any(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[_lists(v, unknown) for v in vectors], pa.array(nll.astype(np.float64), mask=unknown)],
                names=[*columns, "mean_z", "log_var_z", "mean_x", "neg_log_likelihood"],
            )

    return df.mapInArrow(run, schema)


def nll_column(spark: SparkSession, features: Column | str, weights: Weights, dtype: str = "float32") -> Column:
    """The negative log-likelihood only, as a column over an array of features."""
    shared = spark.sparkContext.broadcast({n: w.astype(dtype) for n, w in weights.items()})

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            x = np.stack(vectors.to_numpy()).astype(dtype) if len(vectors) else None
            yield pd.Series(infer_rows(shared.value, x)[-1] if x is not None else [], dtype="float64")

    return score(features)


def split_by_width(df: DataFrame, n: int, features: str = "features") -> tuple[DataFrame, DataFrame]:
    """Rows the model can take, and rejected rows (wrong width or missing elements)."""
    ok = valid_width(features, n)
    return df.filter(ok), df.filter(~ok)
