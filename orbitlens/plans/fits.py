"""Registered queries of the fit on fixed weights, and their SQL twins.

With a learning rate of 0 the weights stay what they are, so the losses of every epoch (order, batches and noise
included) can be written in SQL; so can the gradients of the output layer at the first step.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from orbitlens.functions import likelihood as lk
from orbitlens.functions.noise import normal_draws
from orbitlens.operators import sampling, training
from orbitlens.plans import catalog
from orbitlens.plans.pipeline import run_pipeline
from orbitlens.plans.stage_cache import StageCache, digest_files
from orbitlens.plans import oracles as sql
from orbitlens.plans.catalog import KEY, PIPELINE_HIGH, PIPELINE_LOW, STEPS, VECTOR, WINDOW, fixed_weights, periods, query, r6, telemetry, vectors
from orbitlens.plans.catalog import _fit_frames as fit_frames
from orbitlens.session import scratch_path

STILL = training.FitSettings(latent_dim=2, hidden_dims=8, beta=1e-3, lr=0.0, batch_size=32, mixing=0.01, max_epochs=3, workers=2)
CHOICES = {"lr": [0.0], "batch_size": [16.0, 32.0, 64.0], "beta": [0.01, 0.001, 0.0001]}
TRIALS, SEARCH_EPOCHS = 4, 2
HALF = VECTOR // 2


@query
def fixed_fit(spark, sf_dir):
    """Train and validation loss per epoch of a model that stands still, stopped after two epochs and resumed."""
    train, validation = fit_frames(spark, sf_dir)
    folder = scratch_path(spark, "fit")
    args = (train, validation, ["vec_id"], "features", VECTOR)
    training.fit(*args, replace(STILL, max_epochs=2), folder, fixed_weights())
    done = training.fit(*args, STILL, folder, fixed_weights())
    return done.history.select("epoch", r6("train_loss").alias("train_loss"), r6("val_loss").alias("val_loss"))


@query
def fixed_search(spark, sf_dir):
    """Drawn trials of batch size and beta, all in one pass an epoch: each one's best epoch and its losses."""
    train, validation = fit_frames(spark, sf_dir)
    trials = sampling.draw_trials(spark, CHOICES, TRIALS)
    done = training.random_search(train, validation, ["vec_id"], "features", VECTOR, trials,
                                  replace(STILL, max_epochs=SEARCH_EPOCHS), initial=fixed_weights())
    return done.withColumns({"train_loss": r6("train_loss"), "val_loss": r6("val_loss")})


@query
def synchronous_gradients(spark, sf_dir):
    """The first step of workers in step: mean gradients of the output bias and the log-variances over all rows."""
    train, validation = fit_frames(spark, sf_dir)
    whole = replace(STILL, sync="step", max_epochs=1, batch_size=1 << 30)
    done = training.fit(train, validation, ["vec_id"], "features", VECTOR, whole, initial=fixed_weights())
    # after one step the first moment is the gradient, scaled
    first = done.last[1]
    rows = [(i, float(first["decoder.2.bias"][i]) / (1 - training.ADAM_BETA1), float(first["log_var_x"][i]) / (1 - training.ADAM_BETA1))
            for i in range(VECTOR)]
    found = spark.createDataFrame(rows, "feature int, bias double, log_var double")
    return found.select("feature", F.round("bias", 9).alias("bias"), F.round(F.col("log_var") * 1e6, 6).alias("log_var_millionths"))


@query
def latent_draws(spark, sf_dir):
    """Reparameterised draws with counter-based noise: the halves of a vector as mean and log-variance."""
    noise = normal_draws(["vec_id"], 42, 0, HALF)
    parts = vectors(spark, sf_dir).select("vec_id", F.posexplode(F.arrays_zip(
        F.slice("features", 1, HALF).alias("mean"), F.slice("features", HALF + 1, HALF).alias("log_var"), noise.alias("noise"))))
    z = lk.reparameterized(F.col("col.mean").cast("double"), F.col("col.log_var").cast("double"), F.col("col.noise"))
    return parts.select("vec_id", F.col("pos").alias("position"), r6("col.noise").alias("noise"), r6(z).alias("z"))


def trained_pipeline(spark, sf_dir, cache):
    """The whole analysis with the model branch, on a model that stands still."""
    settings = replace(STILL, max_epochs=2)
    return run_pipeline(telemetry(spark, sf_dir), periods(spark, sf_dir), "ts", KEY, ["value"], window=WINDOW, low=PIPELINE_LOW,
                        high=PIPELINE_HIGH, n_thresholds=STEPS, fit_settings=settings, initial=fixed_weights(1), dtype="float64",
                        cache=cache, source=digest_files(spark, f"{sf_dir}/events.parquet"))


@query
def cached_pipeline(spark, sf_dir):
    """The analysis run twice on one stage cache: metrics of the second run, and how many stages each run made."""
    folder = scratch_path(spark, "stages")
    first, second = StageCache(spark, folder), StageCache(spark, folder)
    trained_pipeline(spark, sf_dir, first)
    done = trained_pipeline(spark, sf_dir, second)
    counts = [F.lit(len(x)).alias(n) for n, x in (("made_first", first.built), ("made_second", second.built), ("reused", second.reused))]
    return done.metrics.select(*[r6(c).alias(c) for c in done.metrics.columns], *counts)


@query
def pipeline_results(spark, sf_dir):
    """The result frame of the model branch: latent columns, smoothed scores and predictions of every row."""
    done = trained_pipeline(spark, sf_dir, StageCache(spark, scratch_path(spark, "stages")))
    rounded = ["neg_log_likelihood", "smoothed_neg_log_likelihood", *[f"{a}_{i}" for a in ("mean_z", "log_var_z") for i in range(2)]]
    return done.results.withColumns({c: r6(c) for c in rounded}).withColumnRenamed("Anomaly", "label")


def md5_text(seed: str, epoch: str, *more: str) -> str:
    return f"md5(concat_ws(':', {', '.join((seed, epoch, *more))}))"


def normal(text: str) -> str:
    def unit(first: int) -> str:
        return f"((('0x' || substr({text}, {first}, 13))::BIGINT + 0.5) / 4503599627370496)"

    return f"sqrt(-2 * ln({unit(1)})) * cos(2 * pi() * {unit(14)})"


def passes(epochs: int, trials: str) -> str:
    """Losses (trial, epoch, part, loss) of the fixed model; ``trials`` is a table (trial, batch_size, beta)."""
    seed = "CASE WHEN part = 'train' THEN '42' ELSE '43' END"
    scale = "(exp(0.5 * sin(1.0 * k) / 10) + 1e-30)"
    d = sql.dense
    return f"""
  src AS (SELECT e.epoch, vec_id, embedding::DOUBLE[] AS x,
            CASE WHEN {sql.below(0.8, 'vec_id')} THEN 'train' ELSE 'val' END AS part FROM embeddings, range(0, {epochs}) e(epoch)),
  f1 AS (SELECT *, {d('x', VECTOR, 8, True)} AS h1 FROM src),
  f2 AS (SELECT * EXCLUDE h1, {d('h1', 8, 8, True)} AS h2 FROM f1),
  f3 AS (SELECT * EXCLUDE h2, {d('h2', 8, 4, False)} AS code FROM f2),
  f4 AS (SELECT *, list_transform(range(0, 2), lambda p: code[p + 1] + exp(0.5 * code[p + 3]) *
            {normal(md5_text(seed, 'epoch', 'vec_id', 'p'))}) AS z, {md5_text(seed, 'epoch', 'vec_id')} AS ord FROM f3),
  f5 AS (SELECT *, {d('z', 2, 8, True)} AS g1 FROM f4),
  f6 AS (SELECT * EXCLUDE g1, {d('g1', 8, 8, True)} AS g2 FROM f5),
  f7 AS (SELECT * EXCLUDE g2, {d('g2', 8, VECTOR, False)} AS m FROM f6),
  per_row AS (SELECT epoch, part, vec_id, ord, (('0x' || substr(ord, 1, 8))::BIGINT * 2 / 4294967296)::DOUBLE AS place, x, m,
            list_sum(list_transform(range(0, {VECTOR}), lambda k: (m[k + 1] - x[k + 1]) ** 2)) AS sq,
            -list_sum(list_transform(range(0, {VECTOR}), lambda k: 0.5 * ((m[k + 1] - x[k + 1]) / {scale}) ** 2 + ln({scale})
              + {sql.HALF_LOG_2PI})) AS ld,
            -0.5 * list_sum(list_transform(range(0, 2), lambda p: 1 + code[p + 3] - code[p + 1] ** 2 - exp(code[p + 3]))) AS kl
          FROM f7),
  batched AS (SELECT *, (row_number() OVER (PARTITION BY trial, epoch, part, floor(place) ORDER BY ord, vec_id) - 1) // batch_size::BIGINT AS b
          FROM per_row, ({trials}) t),
  per_batch AS (SELECT trial, epoch, part, floor(place) AS w, b, count(*) AS n, sum(sq) / (count(*) * {VECTOR}) AS mse, sum(ld) / count(*) AS ld,
            sum(kl) AS kl, any_value(beta) AS beta FROM batched GROUP BY ALL),
  losses AS (SELECT trial, epoch, part, sum(n * (mse + 0.01 * (mse - 1e-5 * ld) + beta * kl)) / sum(n) AS loss FROM per_batch GROUP BY ALL),
  his AS (SELECT a.trial, a.epoch::INTEGER AS epoch, a.loss AS train_loss, v.loss AS val_loss
          FROM losses a JOIN losses v ON a.trial = v.trial AND a.epoch = v.epoch AND a.part = 'train' AND v.part = 'val')"""


def combinations() -> str:
    sizes, betas = CHOICES["batch_size"], CHOICES["beta"]
    rows = [f"({i * len(betas) + j}, 0.0, {b}, {c!r})" for i, b in enumerate(sizes) for j, c in enumerate(betas)]
    return f"(VALUES {', '.join(rows)}) p(combination, lr, batch_size, beta)"


DRAWN = f"""SELECT (row_number() OVER (ORDER BY draw, combination) - 1)::INTEGER AS trial, lr::DOUBLE AS lr,
  batch_size::DOUBLE AS batch_size, beta::DOUBLE AS beta FROM (SELECT *, {sql.draw('combination')} AS draw FROM {combinations()})
  QUALIFY trial < {TRIALS}"""

GRADIENT = 1e-5 * 0.01

#: the model branch on one scaled feature
ONE = f"""{sql.SPLIT},
  par AS (SELECT avg(value) AS c, stddev_pop(value) AS s FROM spl WHERE split = 'train'),
  v0 AS (SELECT event_id, ts, split, CASE WHEN split = 'test' THEN label ELSE 0 END AS label, [(value - c) / s] AS x
         FROM spl, par WHERE split <> 'train'),
  v1 AS (SELECT *, {sql.dense('x', 1, 8, True)} AS h1 FROM v0),
  v2 AS (SELECT *, {sql.dense('h1', 8, 8, True)} AS h2 FROM v1),
  v3 AS (SELECT *, {sql.dense('h2', 8, 4, False)} AS code FROM v2),
  v4 AS (SELECT *, code[1:2] AS z FROM v3),
  v5 AS (SELECT *, {sql.dense('z', 2, 8, True)} AS g1 FROM v4),
  v6 AS (SELECT *, {sql.dense('g1', 8, 8, True)} AS g2 FROM v5),
  v7 AS (SELECT *, {sql.dense('g2', 8, 1, False)} AS m FROM v6),
  raw AS (SELECT event_id, ts, split, label, code, 0.5 * (x[1] - m[1]) * (x[1] - m[1]) + {sql.HALF_LOG_2PI} AS nll FROM v7),
  sco AS (SELECT *, median(nll) OVER (ORDER BY ts, event_id ROWS 99 PRECEDING) AS sm FROM raw),
  {sql.LABEL_RUNS}"""

ORACLES = {
    "cached_pipeline": f"""
WITH {ONE}, {sql.grid(PIPELINE_LOW, PIPELINE_HIGH, STEPS)}, {sql.sweep('sco', 'ts', 'label', '-sm')}
SELECT *, 5::INTEGER AS made_first, 0::INTEGER AS made_second, 5::INTEGER AS reused FROM ({sql.BEST})""",
    "pipeline_results": f"""
WITH {ONE}, hit AS (SELECT DISTINCT i."start", i."end" FROM isl i JOIN sco r ON r.ts BETWEEN i."start" AND i."end"
                    WHERE -r.sm < {PIPELINE_HIGH!r})
SELECT ts, event_id, round(nll, 6) AS neg_log_likelihood, split AS dataset, label, round(code[1], 6) AS mean_z_0,
  round(code[3], 6) AS log_var_z_0, round(code[2], 6) AS mean_z_1, round(code[4], 6) AS log_var_z_1,
  round(sm, 6) AS smoothed_neg_log_likelihood, (-sm < {PIPELINE_HIGH!r})::INT AS prediction_point,
  (-sm < {PIPELINE_HIGH!r} OR EXISTS (SELECT 1 FROM hit h WHERE r.ts BETWEEN h."start" AND h."end"))::INT AS prediction_event
FROM sco r""",
    "fixed_fit": f"""
WITH {passes(3, "SELECT 0 AS trial, 32 AS batch_size, 0.001::DOUBLE AS beta")}
SELECT epoch, round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss FROM his""",
    "fixed_search": f"""
WITH {passes(SEARCH_EPOCHS, DRAWN)},
  best AS (SELECT *, row_number() OVER (PARTITION BY trial ORDER BY val_loss, epoch) AS r FROM his)
SELECT trial, lr, batch_size, beta, epoch, round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss
FROM best JOIN ({DRAWN}) USING (trial) WHERE r = 1""",
    "synchronous_gradients": f"""
WITH {passes(1, "SELECT 0 AS trial, 32 AS batch_size, 0.001::DOUBLE AS beta")},
  one AS (SELECT unnest(range(0, {VECTOR})) AS k, unnest(x) AS x, unnest(m) AS m FROM per_row WHERE part = 'train'),
  r AS (SELECT k, m - x AS d, exp(0.5 * sin(1.0 * k) / 10) + 1e-30 AS s FROM one)
SELECT k::INTEGER AS feature, round(avg(2 * (1 + 0.01) * d / {VECTOR} + {GRADIENT!r} * d / s ** 2), 9) AS bias,
  round(1e6 * {GRADIENT!r} * avg(0.5 * (1 - (d / s) ** 2)), 6) AS log_var_millionths FROM r GROUP BY k""",
    "latent_draws": f"""
WITH n AS (SELECT vec_id, embedding::DOUBLE[] AS x, unnest(range(0, {HALF})) AS p FROM embeddings),
  d AS (SELECT *, {normal(md5_text("'42'", "'0'", 'vec_id', 'p'))} AS noise FROM n)
SELECT vec_id, p::INTEGER AS position, round(noise, 6) AS noise,
  round(x[p + 1] + noise * exp(0.5 * x[p + {HALF} + 1]), 6) AS z FROM d""",
}

QUERIES = {n: catalog.QUERIES[n] for n in ORACLES}
