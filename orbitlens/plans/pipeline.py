"""The whole analysis: label, split, scale, score, evaluate, decide on promotion."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.functions.likelihood import log_density
from orbitlens.operators.evaluation import NLL, evaluate, result_frame
from orbitlens.operators.intervals import label_rows
from orbitlens.operators.model import Weights, infer, input_dim, latent_dim, weight_table, weights_from
from orbitlens.operators.registry import append_run, best_trial, promoted, require_run, run_record, weights_of
from orbitlens.operators.sampling import TEST, TRAIN, VALIDATION, draw_trials, split_rows
from orbitlens.operators.scaling import STANDARD, feature_vector, fit_scaler, scale_columns, scaler_values
from orbitlens.operators.training import FitResult, FitSettings, fit, random_search
from orbitlens.plans.stage_cache import StageCache, digest
from orbitlens.session import materialize
from orbitlens.sources.writers import write_weights


@dataclass
class PipelineResult:
    split: DataFrame
    scaler: DataFrame
    results: DataFrame
    metrics: DataFrame
    promoted: DataFrame
    model: FitResult | None = None
    trials: DataFrame | None = None


def register_fit(spark: SparkSession, model: FitResult, run_name: str, registry: str, weights: str) -> str:
    """Store the weights and add the run to the registry; returns the run id."""
    run_id = uuid.uuid4().hex
    s = model.settings
    write_weights(weight_table(spark, model.weights), run_id, weights)
    shape = {"input_dim": input_dim(model.weights), "latent_dim": latent_dim(model.weights)}
    tuned = {"batch_size": s.batch_size, "learning_rate": s.lr, "beta": s.beta}
    append_run(run_record(spark, run_id, run_name, {**tuned, **shape}), registry)
    return run_id


def load_model(spark: SparkSession, run_name: str, registry: str, weights: str) -> Weights:
    """The weights of the latest run of that name."""
    run = require_run(spark.read.parquet(registry), run_name)
    return weights_from(weights_of(spark.read.parquet(weights), run))


def _text(weights: Weights | None) -> str:
    return "" if weights is None else digest(*[(n, w.tolist()) for n, w in sorted(weights.items())])


def closed_form_score(df: DataFrame, features: list[str]) -> DataFrame:
    """Negative log-likelihood of scaled features under independent standard Normals."""
    terms = [log_density(F.col(f), F.lit(0.0), F.lit(1.0)) for f in features]
    return df.withColumn(NLL, -sum(terms[1:], terms[0]))


def run_pipeline(
    telemetry: DataFrame,
    periods: DataFrame,
    ts: str,
    keys: list[str],
    features: list[str],
    label: str = "Anomaly",
    window: timedelta = timedelta(hours=250),
    train_fraction: float = 0.8,
    scaler: str = STANDARD,
    low: float = -200,
    high: float = -100,
    n_thresholds: int = 100,
    promote_above: float = 0.7,
    fit_settings: FitSettings | None = None,
    choices: dict[str, list[float]] | None = None,
    max_trials: int = 5,
    search_settings: FitSettings | None = None,
    initial: Weights | None = None,
    dtype: str = "float32",
    cache: StageCache | None = None,
    source: str = "",
    **options,
) -> PipelineResult:
    """All steps on one frame with a ``split`` column.

    The split frame is written once, since the scaler, the fit and the scoring read it. With
    ``fit_settings`` the likelihood model is trained and scores; otherwise the closed form.
    With ``choices`` (lists for ``lr``, ``batch_size`` and ``beta``) a random search picks
    these three first, on ``search_settings`` where given; without train or validation rows, which leave the trials
    without losses, ``fit_settings`` stay as they are. Where all rows are near an anomaly there is nothing to fit:
    scores are null, nothing is predicted, and the metrics are zeros.

    With a ``cache``, stages of an earlier run with the same settings and the same ``source`` (a digest
    of the inputs, see ``stage_cache.digest_files``) are read instead of made, and a broken fit goes on where it stopped.
    """
    if cache and not source:
        raise ValueError("a cache needs the digest of the inputs")
    last = source

    def keep(name: str, settings: object, build: Callable[[], DataFrame]) -> DataFrame:
        nonlocal last
        if not cache:
            return materialize(build(), name)
        rows, last = cache.stage(name, [last], settings, build)
        return rows

    def place(name: str, settings: object) -> str | None:
        return cache.place(name, [last], settings) if cache else None

    slim = telemetry.select(ts, *keys, *features)

    def divided() -> DataFrame:
        labelled = label_rows(slim, ts, periods, label, key=keys, **options)
        return split_rows(labelled, ts, keys, label, window, train_fraction, key=keys, **options)

    split = keep("split", (ts, keys, features, label, window, train_fraction), divided)
    params = keep("scaler", scaler, lambda: fit_scaler(split.filter(F.col("split") == TRAIN), features, scaler))
    fitted = scaler_values(params)
    scaled = scale_columns(split, fitted)
    model, trials, latent = None, None, 0
    if fit_settings:
        vectors = scaled.select(ts, *keys, label, "split", feature_vector(features, "double" if dtype == "float64" else "float").alias("features"))
        train, validation = (vectors.filter(F.col("split") == part) for part in (TRAIN, VALIDATION))
        if choices:
            drawn = draw_trials(split.sparkSession, choices, max_trials, fit_settings.seed)
            trials = random_search(
                train, validation, keys, "features", len(features), drawn, search_settings or fit_settings, initial=initial,
                checkpoint=place("search", (repr(search_settings or fit_settings), choices, max_trials, dtype, _text(initial))),
            )
            best = best_trial(trials, ["lr", "batch_size", "beta"]).first()
            if best:
                fit_settings = replace(
                    fit_settings, lr=best["lr"], batch_size=int(best["batch_size"]), beta=best["beta"]
                )
        # how long to go on is left to the fit's own checkpoints
        going = repr(replace(fit_settings, max_epochs=0, patience=0))
        model = fit(train, validation, keys, "features", len(features), fit_settings, place("fit", (going, dtype, _text(initial))), initial)
        # inference is dear and the evaluation reads its input several times
        scored = keep("scored", (repr(fit_settings), dtype, _text(initial)), lambda: infer(
            vectors.filter(F.col("split") != TRAIN), model.weights, dtype=dtype).drop("features", "mean_x"))
        latent = latent_dim(model.weights)
    else:
        scored = closed_form_score(scaled.filter(F.col("split") != TRAIN), features)
    made: list[tuple[DataFrame, DataFrame]] = []

    def evaluated(part: int) -> DataFrame:
        if not made:
            results = result_frame(
                scored.filter(F.col("split") == TEST), scored.filter(F.col("split") == VALIDATION), ts, keys, label, latent,
                **options,
            )
            made.append(evaluate(results, ts, keys, label, low, high, n_thresholds, **options))
        return made[0][part]

    if cache:
        bounds = (low, high, n_thresholds, fit_settings is None)
        metrics = keep("metrics", bounds, lambda: evaluated(1))
        results = keep("results", bounds, lambda: evaluated(0))
    else:
        results, metrics = evaluated(0), evaluated(1)
    return PipelineResult(split, params, results, metrics, promoted(metrics, threshold=promote_above), model, trials)
