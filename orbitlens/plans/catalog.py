"""Registered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.functions import likelihood as lk
from orbitlens.functions.scalars import (
    iso_millis,
    last_part,
    normalize_path,
    parse_day_of_year,
    path_year,
    plus,
)
from orbitlens.operators import evaluation as ev
from orbitlens.operators import intervals as iv
from orbitlens.operators import model as md
from orbitlens.operators import ordered, plots, registry, sampling, scaling, training
from orbitlens.plans.pipeline import run_pipeline
from orbitlens.plans.preprocess import preprocess
from orbitlens.session import materialize, scratch_path, ship_package
from orbitlens.sources import readers, writers
from orbitlens.streaming import scoring

Query = Callable[[SparkSession, str], DataFrame]

KEY = ["event_id"]
LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
WINDOW = timedelta(minutes=15)
PERIOD = timedelta(minutes=30)
VECTOR = 64
FEATURES = [f"f{i}" for i in range(VECTOR)]
LOW, HIGH, STEPS = -1.1, -0.92, 100
PIPELINE_LOW, PIPELINE_HIGH = -1.6, -0.95
SCORE_AT = -1.0

QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half an hour from each large error event on."""
    hits = events(spark, sf_dir).filter("event_type = 'error' and value > 200")
    return hits.select(F.col("ts").alias("start"), plus("ts", PERIOD).alias("end"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", "ts", "value")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.label_rows(telemetry(spark, sf_dir), "ts", periods(spark, sf_dir), "label", key=KEY)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows with a smoothed closed-form score of value / 100."""
    nll = -lk.log_density(F.col("value") / 100, F.lit(0.5), F.lit(1.0))
    rows = labelled(spark, sf_dir).withColumn(ev.NLL, nll).withColumn("dataset", F.lit("test"))
    smoothed = ev.rolling_median(rows, ev.NLL, ["ts", *KEY], ev.SMOOTHING_ROWS, out=ev.SMOOTHED)
    return materialize(smoothed, "scored")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("features"))


def vector_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = [F.get("features", F.lit(i)).cast("double").alias(n) for i, n in enumerate(FEATURES)]
    return vectors(spark, sf_dir).select("vec_id", *flat)


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# --- scans, projections, scalars -------------------------------------------------------


@query
def select_float_features(spark, sf_dir):
    return scaling.select_features(table(spark, sf_dir, "lineitem"), "l_shipdate", LINE_KEY)


@query
def hash_sample(spark, sf_dir):
    return sampling.sample_rows(telemetry(spark, sf_dir), KEY, 0.1)


@query
def preprocess_telemetry(spark, sf_dir):
    return preprocess(table(spark, sf_dir, "lineitem"), "l_shipdate", LINE_KEY, 0.05)


@query
def archive_chunks(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_shipdate", F.year("l_shipdate").alias("year"))
    placed = ordered.number_within(rows, ["year"], LINE_KEY, "n").withColumn("row_index", F.col("n") - 1)
    chunks = writers.chunk_rows(placed, rows_per_group=500, groups_per_chunk=4)
    return writers.list_chunks(chunks, "l_shipdate", 500)


@query
def parse_doy_periods(spark, sf_dir):
    text = lambda c: F.date_format(c, "yyyy/DDD/HH:mm:ss")
    raw = periods(spark, sf_dir).select(text("start").alias("start_text"), text("end").alias("end_text"))
    parsed = [parse_day_of_year(f"{c}_text").cast("timestamp_ntz").alias(c) for c in ("start", "end")]
    return raw.select("start_text", "end_text", *parsed)


@query
def normalize_paths(spark, sf_dir):
    prefix = F.element_at(F.array(*[F.lit(p) for p in ("minio://", "/minio/", "minio/", "s3://")]),
                          (F.col("page_id") % 4 + 1).cast("int"))
    rest = F.regexp_replace("url", "^https?://", "")
    path = F.concat(prefix, rest)
    return table(spark, sf_dir, "pages").select(
        "page_id",
        path.alias("path"),
        normalize_path(path).alias("uri"),
        last_part(path, "/").alias("name"),
        path_year(F.concat(path, F.lit("/"), F.col("page_id") + 1900)).alias("year"),
    )


@query
def event_timestamps_iso(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", iso_millis("ts").alias("logged_at"))


@query
def batch_numbers(spark, sf_dir):
    return ordered.batch_numbers(telemetry(spark, sf_dir), ["ts", *KEY], 512)


# --- intervals -------------------------------------------------------------------------


@query
def merge_periods(spark, sf_dir):
    return iv.merge_periods(periods(spark, sf_dir))


@query
def label_intervals(spark, sf_dir):
    return labelled(spark, sf_dir)


@query
def label_intervals_bucketed(spark, sf_dir):
    return iv.label_rows(
        telemetry(spark, sf_dir), "ts", periods(spark, sf_dir), "label", method="scan", key=KEY, n_buckets=16
    )


@query
def test_window_mask(spark, sf_dir):
    return iv.mark_near(labelled(spark, sf_dir), "ts", F.col("label") == 1, WINDOW)


@query
def anomaly_intervals(spark, sf_dir):
    return iv.runs(labelled(spark, sf_dir), "ts", KEY, F.col("label") == 1)


@query
def anomaly_intervals_bucketed(spark, sf_dir):
    return iv.runs(labelled(spark, sf_dir), "ts", KEY, F.col("label") == 1, n_buckets=16)


@query
def tied_value_runs(spark, sf_dir):
    """Runs over rows that share timestamps: lines with a high discount, by ship date."""
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_shipdate", "l_discount")
    return iv.runs(rows, "l_shipdate", LINE_KEY, F.col("l_discount") >= 0.08)


# --- splits ----------------------------------------------------------------------------


@query
def train_val_test_split(spark, sf_dir):
    return sampling.split_rows(labelled(spark, sf_dir), "ts", KEY, "label", WINDOW)


@query
def exact_train_split(spark, sf_dir):
    return sampling.split_rows(labelled(spark, sf_dir), "ts", KEY, "label", WINDOW, exact=True)


@query
def val_anti_join(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_shipdate", "l_quantity")
    return sampling.drop_by_timestamp(rows, sampling.sample_rows(rows, LINE_KEY, 0.02), "l_shipdate")


# --- scaling ---------------------------------------------------------------------------


def _fit(spark, sf_dir, kind):
    params = scaling.fit_scaler(table(spark, sf_dir, "lineitem"), LINE_FEATURES, kind)
    return params.select("feature", r6("center").alias("center"), r6("scale").alias("scale"))


@query
def fit_standard_scaler(spark, sf_dir):
    return _fit(spark, sf_dir, scaling.STANDARD)


@query
def fit_minmax_scaler(spark, sf_dir):
    return _fit(spark, sf_dir, scaling.MINMAX)


@query
def scale_frames(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*LINE_KEY, *LINE_FEATURES, "l_returnflag")
    params = scaling.fit_scaler(rows.filter(sampling.chosen(LINE_KEY, 0.8)), LINE_FEATURES)
    done = scaling.scale_columns(rows, params)
    return done.select(*LINE_KEY, *[r6(c).alias(c) for c in LINE_FEATURES], "l_returnflag")


# --- likelihood ------------------------------------------------------------------------


@query
def gaussian_nll(spark, sf_dir):
    mean = F.transform("features", lambda _, i: i * 0.01)
    log_var = F.transform("features", lambda _, i: i * -0.05)
    first_scale = lk.stddev(F.get(log_var, F.lit(1)))
    return vectors(spark, sf_dir).select(
        "vec_id",
        r6(lk.row_nll(F.col("features"), mean, log_var)).alias("nll"),
        r6(lk.entropy(first_scale)).alias("entropy"),
    )


@query
def elbo_terms(spark, sf_dir):
    half = VECTOR // 2
    mean, log_var = F.slice("features", 1, half), F.slice("features", half + 1, half)
    zero = F.transform(mean, lambda m: F.lit(0.0))
    rows = vectors(spark, sf_dir).select(
        lk.row_kl(mean, log_var).alias("kl"),
        lk.row_squared_error(log_var, mean).alias("squared"),
        (-lk.row_nll(log_var, mean, zero)).alias("log_density"),
    )
    sums = rows.agg(
        F.sum("kl").alias("kl"),
        (F.sum("squared") / (F.count("*") * half)).alias("mse"),
        F.avg("log_density").alias("mean_log_density"),
    )
    loss = lk.total_loss(F.col("mse"), F.col("mean_log_density"), F.col("kl"), mixing=0.01, beta=0.001)
    return sums.select(*[r6(c).alias(c) for c in sums.columns], r6(loss).alias("loss"))


# --- order and evaluation --------------------------------------------------------------


@query
def rolling_median_global(spark, sf_dir):
    done = ordered.rolling_median(telemetry(spark, sf_dir), "value", ["ts", *KEY])
    return done.withColumn("rolling_median", r6("rolling_median"))


@query
def rolling_median_bucketed(spark, sf_dir):
    done = ordered.rolling_median(telemetry(spark, sf_dir), "value", ["ts", *KEY], n_buckets=16)
    return done.withColumn("rolling_median", r6("rolling_median"))


@query
def rolling_median_user(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "ts", "user_id", "value")
    done = ordered.rolling_median(rows, "value", ["ts", *KEY], by=["user_id"])
    return done.withColumn("rolling_median", r6("rolling_median"))


@query
def smoothed_results(spark, sf_dir):
    rows = sampling.split_rows(labelled(spark, sf_dir), "ts", KEY, "label", WINDOW)
    rows = rows.withColumn(ev.NLL, F.col("value"))
    test, validation = (rows.filter(F.col("split") == s) for s in (sampling.TEST, sampling.VALIDATION))
    done = ev.result_frame(test, validation, "ts", KEY, "label")
    return done.withColumn(ev.SMOOTHED, r6(ev.SMOOTHED))


@query
def event_predictions(spark, sf_dir):
    rows = ev.predict_points(scored(spark, sf_dir), SCORE_AT)
    found = ev.predict_events(rows, "ts", KEY, "label")
    return found.select("event_id", "ts", "label", "prediction_point", "prediction_event")


@query
def metrics_at_threshold(spark, sf_dir):
    found = ev.metrics_at_threshold(scored(spark, sf_dir), "ts", KEY, "label", SCORE_AT)
    return found.select(*[r6(c).alias(c) for c in found.columns])


@query
def threshold_sweep(spark, sf_dir):
    found = ev.threshold_sweep(scored(spark, sf_dir), "ts", KEY, "label", LOW, HIGH, STEPS)
    return found.select(*[r6(c).alias(c) for c in found.columns])


@query
def tied_threshold_sweep(spark, sf_dir):
    """The sweep over rows that share timestamps: lines labelled by discount, scored by price."""
    rows = table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, "l_shipdate",
        (F.col("l_discount") >= 0.08).cast("int").alias("label"),
        (F.col("l_extendedprice") / 1000).alias(ev.SMOOTHED),
    )
    found = ev.threshold_sweep(rows, "l_shipdate", LINE_KEY, "label", -110.0, -60.0, 26)
    return found.select(*[r6(c).alias(c) for c in found.columns])


@query
def best_threshold(spark, sf_dir):
    sweep = ev.threshold_sweep(scored(spark, sf_dir), "ts", KEY, "label", LOW, HIGH, STEPS)
    found = ev.best_threshold(sweep)
    return found.select(*[r6(c).alias(c) for c in found.columns])


@query
def metric_rows(spark, sf_dir):
    found = ev.metrics_at_threshold(scored(spark, sf_dir), "ts", KEY, "label", SCORE_AT)
    return writers.metric_rows(found).select("metric", r6("value").alias("value"))


# --- model -----------------------------------------------------------------------------


def fixed_weights(width: int = VECTOR, hidden: int = 8, latent: int = 2) -> md.Weights:
    """Weights ``sin(7i + j) / 10``, biases ``sin(3j) / 10``, log-variances ``sin(j) / 10``."""
    out = {}
    for side, sizes in md.layer_sizes(width, hidden, latent).items():
        for n, (rows, columns) in enumerate(zip(sizes, sizes[1:])):
            i, j = np.indices((rows, columns))
            out[f"{side}.{n}.weight"] = np.sin(7.0 * i + j) / 10
            out[f"{side}.{n}.bias"] = np.sin(3.0 * np.arange(columns)) / 10
    out["log_var_x"] = np.sin(np.arange(float(width))) / 10
    return out


@query
def batch_infer(spark, sf_dir):
    valid, _ = md.split_by_width(vectors(spark, sf_dir), VECTOR)
    done = md.infer(valid, fixed_weights(), dtype="float64")
    flat = ev.latent_columns(done.drop("features", "mean_x"), 2)
    rounded = ["neg_log_likelihood", "mean_z_0", "mean_z_1", "log_var_z_0", "log_var_z_1"]
    return flat.select("vec_id", *[r6(c).alias(c) for c in rounded])


@query
def score_vectors(spark, sf_dir):
    """Scaled and scored in one projection, as a service would for each row."""
    rows = vector_columns(spark, sf_dir)
    params = scaling.scaler_values(scaling.fit_scaler(rows, FEATURES))
    done = scoring.score_vectors(rows, FEATURES, params, fixed_weights(), dtype="float64")
    return done.select("vec_id", r6("nll").alias("nll"))


def requests(spark, sf_dir) -> DataFrame:
    """One JSON body per ten vectors."""
    pairs = F.map_from_arrays(F.array(*[F.lit(n) for n in FEATURES]), F.transform("features", lambda v: v.cast("double")))
    rows = vectors(spark, sf_dir).select("vec_id", F.floor(F.col("vec_id") / 10).alias("request_id"), pairs.alias("i"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("vec_id", F.to_json("i").alias("j")))), lambda s: s["j"])
    body = F.concat(F.lit('{"instances":['), F.array_join(listed, ","), F.lit("]}"))
    return rows.groupBy("request_id").agg(body.alias("body"))


def _predictions(answers: DataFrame) -> DataFrame:
    rows = F.from_json("response", "predictions array<double>")["predictions"]
    return answers.select("request_id", F.posexplode(rows).alias("position", "nll")).select(
        "request_id", "position", r6("nll").alias("nll")
    )


@query
def score_requests(spark, sf_dir):
    """Batch path: bodies to rows, scaled, scored, and back to one response per request."""
    rows, _ = readers.parse_requests(requests(spark, sf_dir), "body", "request_id")
    wide = readers.instance_columns(rows, FEATURES, "request_id", "position")
    params = scaling.fit_scaler(vector_columns(spark, sf_dir), FEATURES)
    done = scaling.scale_columns(wide, params).withColumn("nll", scoring.gaussian_score(FEATURES))
    return _predictions(writers.responses(done, "request_id"))


@query
def score_stream(spark, sf_dir):
    """Streaming path: the same bodies as files, through a stream with the same answers."""
    source, answers = scratch_path(spark, "requests"), scratch_path(spark, "answers")
    requests(spark, sf_dir).write.json(source)
    params = scaling.scaler_values(scaling.fit_scaler(vector_columns(spark, sf_dir), FEATURES))
    stream = scoring.score_requests(scoring.read_request_stream(spark, source), FEATURES, params)
    scoring.run_to_table(stream, answers, scratch_path(spark, "offsets"))
    return _predictions(spark.read.parquet(answers))


@query
def stream_labels(spark, sf_dir):
    source = table(spark, sf_dir, "events")
    stream = (
        spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
        .select("event_id", "ts", "value")
    )
    target = scratch_path(spark, "labels")
    scoring.run_to_table(
        scoring.label_stream(stream, "ts", periods(spark, sf_dir), "label"), target, scratch_path(spark, "offsets")
    )
    return spark.read.parquet(target)


def _fit_frames(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = vectors(spark, sf_dir)
    train = sampling.chosen(["vec_id"], 0.8)
    return rows.filter(train), rows.filter(~train)


@query
def train_vae(spark, sf_dir):
    settings = training.FitSettings(
        latent_dim=4, hidden_dims=16, beta=1e-4, lr=1e-3, batch_size=32, mixing=0.01, max_epochs=4, workers=2
    )
    train, validation = _fit_frames(spark, sf_dir)
    done = training.fit(train, validation, ["vec_id"], "features", VECTOR, settings)
    return done.history.select("epoch", r6("train_loss").alias("train_loss"), r6("val_loss").alias("val_loss"))


@query
def random_search(spark, sf_dir):
    settings = training.FitSettings(latent_dim=4, hidden_dims=16, mixing=0.01, max_epochs=2, workers=2)
    trials = sampling.draw_trials(
        spark, {"lr": [0.0005, 0.0001, 0.00005], "batch_size": [32, 64], "beta": [0.001, 0.0001, 0.0001]}, 3
    )
    train, validation = _fit_frames(spark, sf_dir)
    done = training.random_search(train, validation, ["vec_id"], "features", VECTOR, trials, settings)
    return done.withColumn("val_loss", r6("val_loss")).withColumn("train_loss", r6("train_loss"))


# --- history and registry --------------------------------------------------------------


def history(spark, sf_dir) -> DataFrame:
    """Losses per trial and epoch: a user's values in time order."""
    rows = events(spark, sf_dir).select("event_id", "ts", F.col("user_id").alias("trial"), F.col("value").alias("val_loss"))
    return ordered.number_within(rows, ["trial"], ["ts", *KEY], "epoch")


@query
def early_stop(spark, sf_dir):
    return registry.stop_epoch(history(spark, sf_dir), patience=5, by=["trial"])


@query
def best_epoch(spark, sf_dir):
    return registry.best_epoch(history(spark, sf_dir), by=["trial"])


@query
def best_trial(spark, sf_dir):
    rows = history(spark, sf_dir).select("trial", "epoch", "event_id", "val_loss")
    return registry.best_trial(rows, ["epoch", "event_id"])


def runs_table(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("run_name"),
        F.col("o_orderdate").alias("start_time"),
        F.col("o_orderkey").alias("number"),
        (F.col("o_totalprice") / 600000).alias("composite_f1"),
    )


@query
def run_lookup(spark, sf_dir):
    return registry.latest_run(runs_table(spark, sf_dir), "2-HIGH", "number")


@query
def latest_runs(spark, sf_dir):
    return registry.latest_runs(runs_table(spark, sf_dir), "number")


@query
def promotion_gate(spark, sf_dir):
    return registry.promoted(runs_table(spark, sf_dir))


# --- plots -----------------------------------------------------------------------------


@query
def split_plot_data(spark, sf_dir):
    rows = sampling.split_rows(labelled(spark, sf_dir), "ts", KEY, "label", WINDOW)
    train, _, test = sampling.split_frames(rows, ["value"], "ts", KEY, "label")
    return plots.split_plot(train, test, "ts", KEY, "value", "label")


@query
def result_plot_points(spark, sf_dir):
    done = plots.result_points(scored(spark, sf_dir), "ts", KEY)
    return done.select("series", "ts", r6("y").alias("y"))


@query
def result_plot_bands(spark, sf_dir):
    rows = sampling.split_rows(labelled(spark, sf_dir), "ts", KEY, "label", WINDOW)
    return plots.result_bands(rows.withColumnRenamed("split", "dataset"), "ts", KEY, "label")


# --- the whole pipeline ----------------------------------------------------------------


@query
def anomaly_detection(spark, sf_dir):
    done = run_pipeline(
        telemetry(spark, sf_dir), periods(spark, sf_dir), "ts", KEY, ["value"],
        window=WINDOW, low=PIPELINE_LOW, high=PIPELINE_HIGH, n_thresholds=STEPS,
    )
    return done.metrics.select(*[r6(c).alias(c) for c in done.metrics.columns])
