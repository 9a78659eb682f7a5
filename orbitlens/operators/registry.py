"""Run registry, training history and promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.operators.ordered import order_frame, scan

RUN_SCHEMA = (
    "run_id string, run_name string, model_uri string, status string, "
    "hyperparameters map<string,double>, start_time timestamp"
)


def run_record(spark: SparkSession, run_id: str, run_name: str, hyperparameters: dict[str, float],
               status: str = "success") -> DataFrame:
    """One run as a registry row."""
    row = (run_id, run_name, f"runs:/{run_id}/model", status, {k: float(v) for k, v in hyperparameters.items()}, None)
    return spark.createDataFrame([row], RUN_SCHEMA).withColumn("start_time", F.current_timestamp())


def append_run(record: DataFrame, path: str) -> None:
    """Add one row to the registry table."""
    record.coalesce(1).write.mode("append").parquet(path)


def latest_run(registry: DataFrame, run_name: str, *tie_break: str) -> DataFrame:
    """The most recent run of that name, as one row."""
    return registry.filter(F.col("run_name") == run_name).orderBy(F.desc("start_time"), *[F.desc(c) for c in tie_break]).limit(1)


def require_run(registry: DataFrame, run_name: str) -> DataFrame:
    """:func:`latest_run`, refusing names nobody registered."""
    run = latest_run(registry, run_name)
    if run.isEmpty():
        raise ValueError(f"no run named {run_name!r}")
    return run


def latest_runs(registry: DataFrame, *tie_break: str) -> DataFrame:
    """The most recent run of every name.

    ``max_by`` combines on the map side, so a name with very many runs is no hot group.
    """
    place = F.struct("start_time", *tie_break)
    names = registry.columns
    return (
        registry.groupBy("run_name")
        .agg(F.max_by(F.struct(*names), place).alias("r"))
        .select(*[F.col(f"r.{c}") for c in names])
    )


def weights_of(weights: DataFrame, run: DataFrame) -> DataFrame:
    """The weight rows of a one-row run frame."""
    return weights.join(F.broadcast(run.select("run_id")), "run_id", "left_semi").drop("run_id")


def promoted(runs: DataFrame, metric: str = "composite_f1", threshold: float = 0.7) -> DataFrame:
    """Runs strictly better than the threshold."""
    return runs.filter(F.col(metric) > threshold)


def hyperparameter(name: str, column: str = "hyperparameters") -> Column:
    return F.col(column)[name]


def pairs_to_map(column: Column | str) -> Column:
    """An array of ``(name, value)`` structs as a map."""
    return F.map_from_entries(column)


def best_epoch(history: DataFrame, by: list[str] | tuple[str, ...] = (), metric: str = "val_loss",
               epoch: str = "epoch") -> DataFrame:
    """The epoch with the lowest metric (the earliest of equals), per group or overall."""
    # NaN sorts above every number and NULL would win a minimum: neither can be best
    value = F.nanvl(F.col(metric).cast("double"), F.lit(None).cast("double"))
    place = F.min(F.when(value.isNotNull(), F.struct(value.alias("m"), F.col(epoch).alias("e")))).alias("best")
    found = history.groupBy(*by).agg(place)
    return found.select(*by, F.col("best.e").alias("best_epoch"), F.col("best.m").alias(f"best_{metric}"))


def best_trial(trials: DataFrame, params: list[str], metric: str = "val_loss", trial: str = "trial") -> DataFrame:
    """The trial that minimises the metric, lowest trial number among equals."""
    value = F.nanvl(F.col(metric).cast("double"), F.lit(None).cast("double"))
    row = F.struct(value.alias(metric), F.col(trial).alias(trial), *params)
    best = trials.filter(value.isNotNull()).agg(F.min(row).alias("b"))
    return best.select(*[F.col(f"b.{c}").alias(c) for c in (trial, *params, metric)]).filter(F.col(trial).isNotNull())


def stop_epoch(history: DataFrame, patience: int, by: list[str] | tuple[str, ...] = (), metric: str = "val_loss",
               epoch: str = "epoch", **options) -> DataFrame:
    """Where early stopping ends each group: the first epoch ``patience`` after its last new minimum.

    Returns ``by, stop_epoch, best_epoch``; a group that never runs out of patience stops at
    its last epoch. One ordered scan serves all groups: in the order (group, epoch) the
    running maximum of (group, -metric, -epoch) is the earliest best epoch of the current
    group, so a group with very many epochs may span several buckets.
    """
    value = F.nanvl(F.col(metric).cast("double"), F.lit(None).cast("double"))
    best = F.struct(*by, (-value).alias("m"), (-F.col(epoch)).alias("e"))
    seen = scan(order_frame(history, [*by, epoch], **options), __best=("max", best))
    at = -F.col("__best.e")
    place = F.struct(F.col(epoch).alias("e"), at.alias("b"))
    first_done = F.min(F.when(F.col(epoch) - at >= patience, place))
    return (
        seen.groupBy(*by)
        .agg(F.coalesce(first_done, F.max(place)).alias("s"))
        .select(*by, F.col("s.e").alias("stop_epoch"), F.col("s.b").alias("best_epoch"))
    )
