import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orbitlens.functions import likelihood as lk
from orbitlens.functions.noise import epoch_order, epoch_worker, normal_draws
from orbitlens.operators import model as md
from orbitlens.operators import registry as rg
from orbitlens.operators import training as tr

WIDTH, HIDDEN, LATENT = 6, 5, 2


def weights(seed=1):
    w = md.init_weights(WIDTH, HIDDEN, LATENT, seed)
    w["log_var_x"] = np.random.default_rng(seed).normal(size=WIDTH) * 0.3
    return w


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    z = rng.normal(size=(240, 2))
    x = z @ rng.normal(size=(2, WIDTH)) + 0.05 * rng.normal(size=(240, WIDTH))
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "key int, features array<double>")


@pytest.mark.parametrize("mixing", [0.5, None])
def test_gradients_match_differences(mixing):
    rng = np.random.default_rng(2)
    w, x, noise = weights(), rng.normal(size=(4, WIDTH)), rng.normal(size=(4, LATENT))
    loss, grads = tr.loss_and_gradients(w, x, noise, beta=0.3, mixing=mixing)
    assert set(grads) == set(w) and len(w) == 13
    for name in w:
        flat, g = w[name].reshape(-1), grads[name].reshape(-1)
        for i in rng.choice(flat.size, min(6, flat.size), replace=False):
            kept, h = flat[i], 1e-6
            flat[i] = kept + h
            up = tr.loss_and_gradients(w, x, noise, 0.3, mixing, gradients=False)[0]
            flat[i] = kept - h
            down = tr.loss_and_gradients(w, x, noise, 0.3, mixing, gradients=False)[0]
            flat[i] = kept
            assert g[i] == pytest.approx((up - down) / (2 * h), rel=1e-4, abs=1e-7)


def test_loss_equals_columns(spark):
    """The batch loss is the one the column expressions give."""
    rng = np.random.default_rng(4)
    w, x, noise = weights(), rng.normal(size=(5, WIDTH)), np.zeros((5, LATENT))
    loss, _ = tr.loss_and_gradients(w, x, noise, 0.3, 0.5, gradients=False)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "key int, features array<double>")
    log_var = F.lit(w["log_var_x"].tolist())
    got = md.infer(df, w, dtype="float64").agg(
        (F.sum(lk.row_squared_error(F.col("features"), F.col("mean_x"))) / (5 * WIDTH)).alias("mse"),
        F.avg(-lk.row_nll(F.col("features"), F.col("mean_x"), log_var)).alias("ld"),
        F.sum(lk.row_kl(F.col("mean_z"), F.col("log_var_z"))).alias("kl"),
    )
    total = got.select(lk.total_loss(F.col("mse"), F.col("ld"), F.col("kl"), 0.5, 0.3)).first()[0]
    assert total == pytest.approx(loss, rel=1e-9)


def test_normal_columns(spark):
    df = spark.range(4000).select(
        lk.normal_sample(F.lit(3.0), F.lit(2.0), 5).alias("s"),
        lk.reparameterized(F.lit(1.0), F.lit(2.0), F.lit(-1.0)).alias("r"),
        lk.log_density(F.lit(1.0), F.lit(0.0), F.lit(2.0)).alias("d"),
        lk.entropy(F.lit(2.0)).alias("h"),
        lk.variance(F.lit(0.5)).alias("v"),
    )
    m = df.agg(F.avg("s"), F.stddev("s"), F.max("r"), F.max("d"), F.max("h"), F.max("v")).first()
    assert m[0] == pytest.approx(3, abs=0.15) and m[1] == pytest.approx(2, abs=0.15)
    assert m[2] == pytest.approx(1 - np.e)
    assert m[3] == pytest.approx(-1 / 8 - np.log(2) - 0.5 * np.log(2 * np.pi))
    assert m[4] == pytest.approx(0.5 + 0.5 * np.log(2 * np.pi) + np.log(2))
    assert m[5] == pytest.approx(np.exp(0.5))


def test_infer_equals_sql_likelihood(rows):
    w = weights()
    for side in md.SIDES:
        for i in range(3):
            w[f"{side}.{i}.weight"][:] = 0
            w[f"{side}.{i}.bias"][:] = 0
    w["log_var_x"][:] = 0
    out = md.infer(rows, w, dtype="float64")
    zero = F.transform("features", lambda v: F.lit(0.0))
    gap = F.abs(F.col("neg_log_likelihood") - lk.row_nll(F.col("features"), zero, zero))
    assert out.filter(gap > 1e-9).count() == 0
    assert out.columns == ["key", "features", "mean_z", "log_var_z", "mean_x", "neg_log_likelihood"]


def test_score_column_equals_infer(spark, rows):
    w = weights()
    column = md.nll_column(spark, F.col("features"), w, "float64")
    joined = md.infer(rows.repartition(3), w, dtype="float64").withColumn("s", column)
    assert joined.filter("abs(s - neg_log_likelihood) > 1e-9").count() == 0
    single = md.infer(rows, w).join(joined.select("key", "s"), "key")
    assert single.filter("abs(s - neg_log_likelihood) > 1e-3").count() == 0


def test_width_check(spark):
    df = spark.createDataFrame([(0, [1.0] * WIDTH), (1, [1.0]), (2, None), (3, [None] * WIDTH)],
                               "key int, features array<double>")
    good, bad = md.split_by_width(df, WIDTH)
    assert [r["key"] for r in good.collect()] == [0]
    assert sorted(r["key"] for r in bad.collect()) == [1, 2, 3]
    assert md.infer(good, weights()).count() == 1


def test_weight_table_round_trip(spark, tmp_path):
    from orbitlens.sources.writers import write_weights

    w = weights()
    path = str(tmp_path / "weights")
    write_weights(md.weight_table(spark, w), "r1", path)
    write_weights(md.weight_table(spark, weights(9)), "r2", path)
    record = rg.run_record(spark, "r1", "first", {"lr": 1})
    back = md.weights_from(rg.weights_of(spark.read.parquet(path), record))
    assert set(back) == set(w) and all(np.array_equal(back[n], w[n]) for n in w)


SETTINGS = tr.FitSettings(latent_dim=LATENT, hidden_dims=HIDDEN, beta=1e-5, lr=5e-3, batch_size=16, mixing=0.01,
                          max_epochs=5, workers=3)


def test_fit_learns_and_repeats(rows):
    train, validation = rows.filter("key % 5 <> 0"), rows.filter("key % 5 = 0")
    first = tr.fit(train, validation, ["key"], "features", WIDTH, SETTINGS)
    losses = [r["train_loss"] for r in first.history.orderBy("epoch").collect()]
    assert len(losses) == 5 and losses[-1] < losses[0]
    again = tr.fit(train.repartition(7), validation, ["key"], "features", WIDTH, SETTINGS)
    assert all(np.allclose(first.weights[n], again.weights[n], rtol=1e-12) for n in first.weights)


def shares(rows, s, epoch):
    """Rows and noise of each worker in the order of an epoch."""
    spread = rows.select("key", "features", epoch_worker(["key"], s.seed, epoch, s.workers).alias("w"),
                         epoch_order(["key"], s.seed, epoch).alias("o"), normal_draws(["key"], s.seed, epoch, LATENT).alias("z"))
    found = spread.orderBy("o", "key").collect()
    return [(np.array([r["features"] for r in found if r["w"] == w]).reshape(-1, WIDTH), np.array([r["z"] for r in found if r["w"] == w]).reshape(-1, LATENT))
            for w in range(s.workers)]


def test_one_worker_equals_plain_loop(rows):
    """With one worker the epoch is ordinary mini-batch training."""
    s = tr.FitSettings(**{**SETTINGS.__dict__, "workers": 1, "max_epochs": 1})
    done = tr.fit(rows, rows, ["key"], "features", WIDTH, s)
    (x, z), = shares(rows, s, 0)
    w = md.init_weights(WIDTH, HIDDEN, LATENT, s.seed)
    m, v = ({n: np.zeros_like(a) for n, a in w.items()} for _ in range(2))
    for step, i in enumerate(range(0, len(x), 16), start=1):
        _, g = tr.loss_and_gradients(w, x[i:i + 16], z[i:i + 16], s.beta, s.mixing)
        tr.adam_step(w, m, v, step, g, s.lr)
    assert all(np.allclose(done.weights[n], w[n], rtol=1e-9, atol=1e-12) for n in w)


@pytest.mark.parametrize("size", [1, 7, 16, 1000])
def test_batches_do_not_depend_on_chunks(size):
    x = np.arange(200.0).reshape(100, 2)
    lists = lambda a: pa.array(a.tolist(), pa.list_(pa.float64()))
    stream = [pa.RecordBatch.from_arrays([lists(x[a:b]), lists(x[a:b, :1])], ["x", "z"]) for a, b in ((0, 33), (33, 33), (33, 100))]
    feed, got = tr.Feed(16, 2, 1), []
    for piece in tr.chunks(iter(stream), 2, 1, size):
        got += list(feed.take(*piece))
    assert [len(b) for b, _ in got] == [16] * 6 + [4]
    assert np.array_equal(np.concatenate([b for b, _ in got]), x) and np.array_equal(np.concatenate([z for _, z in got]), x[:, :1])


def test_workers_in_step_equal_one_loop_over_their_batches(rows):
    """Averaged gradients of all workers' batches give the same weights as one process does."""
    s = tr.FitSettings(**{**SETTINGS.__dict__, "workers": 3, "max_epochs": 2, "sync": "step"})
    done = tr.fit(rows, rows, ["key"], "features", WIDTH, s)
    w = md.init_weights(WIDTH, HIDDEN, LATENT, s.seed)
    m, v = ({n: np.zeros_like(a) for n, a in w.items()} for _ in range(2))
    step = 0
    for epoch in range(2):
        parts = shares(rows, s, epoch)
        assert all(len(x) > 20 for x, _ in parts)
        for i in range(0, max(len(x) for x, _ in parts), 16):
            got = [(len(x[i:i + 16]), tr.loss_and_gradients(w, x[i:i + 16], z[i:i + 16], s.beta, s.mixing)[1]) for x, z in parts if len(x) > i]
            total = sum(n for n, _ in got)
            step += 1
            tr.adam_step(w, m, v, step, {k: sum(n * g[k] for n, g in got) / total for k in w}, s.lr)
    assert all(np.allclose(done.last[0][n], w[n], rtol=1e-6, atol=1e-9) for n in w)


def test_losses_do_not_depend_on_the_layout(rows):
    s = tr.FitSettings(**{**SETTINGS.__dict__, "max_epochs": 2, "workers": 2})
    first, second = (tr.fit(x, x, ["key"], "features", WIDTH, s).history.select("train_loss", "val_loss").collect()
                     for x in (rows.coalesce(1), rows.repartition(9)))
    assert np.allclose(first, second, rtol=1e-12)


def test_noise_is_normal_and_fixed(spark):
    draws = spark.range(4000).select(F.explode(normal_draws(["id"], 3, 1, 5)).alias("z")).toPandas()["z"]
    assert abs(draws.mean()) < 0.03 and abs(draws.std() - 1) < 0.03 and abs((draws < -1.96).mean() - 0.025) < 0.01
    one, other = (spark.range(5).select(normal_draws(["id"], 3, e, 2)).collect() for e in (1, 2))
    assert one != other and one == spark.range(5).repartition(3).orderBy("id").select(normal_draws(["id"], 3, 1, 2)).collect()


@pytest.mark.parametrize("sync", ["epoch", "step"])
def test_resumed_fit_equals_unbroken_one(spark, rows, tmp_path, sync):
    s = tr.FitSettings(**{**SETTINGS.__dict__, "max_epochs": 3, "workers": 2, "sync": sync})
    whole = tr.fit(rows, rows, ["key"], "features", WIDTH, s)
    folder = str(tmp_path / "fit")
    for epochs in (1, 2):
        tr.fit(rows, rows, ["key"], "features", WIDTH, tr.FitSettings(**{**s.__dict__, "max_epochs": epochs}), folder)
    # an epoch whose records were not committed does not count
    (tmp_path / "fit" / "epoch-000001" / "records" / "_SUCCESS").unlink()
    again = tr.fit(rows, rows, ["key"], "features", WIDTH, s, folder)
    columns = ["epoch", "train_loss", "val_loss"]
    assert np.allclose(whole.history.select(columns).collect(), again.history.select(columns).collect(), rtol=1e-12)
    assert all(np.allclose(whole.last[0][n], again.last[0][n], rtol=1e-12) for n in whole.weights)
    with pytest.raises(ValueError, match="other settings"):
        tr.fit(rows, rows, ["key"], "features", WIDTH, tr.FitSettings(**{**s.__dict__, "lr": 1.0}), folder)


def test_reset_keeps_log_variances(rows):
    s = tr.FitSettings(**{**SETTINGS.__dict__, "max_epochs": 1, "reset_epochs": 1, "reset_value": -2.0})
    assert np.allclose(tr.fit(rows, rows, ["key"], "features", WIDTH, s).weights["log_var_x"], -2.0)


def test_early_stop_in_fit(rows):
    s = tr.FitSettings(**{**SETTINGS.__dict__, "lr": 0.0, "beta": 0.0, "max_epochs": 30, "patience": 2})
    done = tr.fit(rows, rows, ["key"], "features", WIDTH, s)
    stop = rg.stop_epoch(done.history, 2).first()
    assert done.history.count() == stop["stop_epoch"] + 1 and done.best_epoch == stop["best_epoch"]


def test_random_search(spark, rows):
    trials = spark.createDataFrame([(0, 5e-3, 16.0, 1e-5), (1, 0.0, 24.0, 1e-5)],
                                   "trial int, lr double, batch_size double, beta double")
    s = tr.FitSettings(**{**SETTINGS.__dict__, "max_epochs": 3})
    found = tr.random_search(rows, rows, ["key"], "features", WIDTH, trials, s)
    assert found.count() == 2
    assert rg.best_trial(found, ["lr", "batch_size", "beta"]).first()["trial"] == 0
    for r in found.collect():  # all in one pass, each as if alone
        alone = tr.fit(rows, rows, ["key"], "features", WIDTH, tr.FitSettings(**{**s.__dict__, "lr": r["lr"], "batch_size": int(r["batch_size"]), "beta": r["beta"]}))
        best = alone.history.where(F.col("epoch") == r["epoch"]).first()
        assert alone.best_epoch == r["epoch"] and np.allclose(best["val_loss"], r["val_loss"], rtol=1e-12)
    broken = trials.withColumn("batch_size", F.lit(0.0))
    with pytest.raises(RuntimeError, match="2 of 2"):
        tr.random_search(rows, rows, ["key"], "features", WIDTH, broken, s)


def test_history_operators(spark):
    nan = float("nan")
    data = [("a", e, v) for e, v in enumerate([5.0, 4.0, 4.0, 4.5, 3.0, 9.0])] + [
        ("b", e, v) for e, v in enumerate([nan, 2.0, None, 1.0])]
    df = spark.createDataFrame(data, "trial string, epoch int, val_loss double")
    for n in (1, 4):
        got = {r["trial"]: tuple(r)[1:] for r in rg.stop_epoch(df, 2, by=["trial"], n_buckets=n).collect()}
        assert got == {"a": (3, 1), "b": (3, 3)}
    best = {r["trial"]: tuple(r)[1:] for r in rg.best_epoch(df, by=["trial"]).collect()}
    assert best == {"a": (4, 3.0), "b": (3, 1.0)}
    assert rg.best_trial(df, ["epoch"]).first()["trial"] == "b"


def test_registry(spark, tmp_path):
    path = str(tmp_path / "runs")
    for i, name in enumerate(["x", "y", "x"]):
        rg.append_run(rg.run_record(spark, f"r{i}", name, {"lr": 0.1, "beta": i}), path)
    runs = spark.read.parquet(path)
    assert rg.latest_run(runs, "x").first()["run_id"] == "r2"
    assert rg.require_run(runs, "y").select(rg.hyperparameter("beta")).first()[0] == 1.0
    assert sorted(r["run_id"] for r in rg.latest_runs(runs).collect()) == ["r1", "r2"]
    with pytest.raises(ValueError, match="no run"):
        rg.require_run(runs, "z")
    scores = spark.createDataFrame([("a", 0.7), ("b", 0.71)], "run_id string, composite_f1 double")
    assert [r["run_id"] for r in rg.promoted(scores).collect()] == ["b"]
    pairs = spark.sql("select array(struct('lr' as name, 0.1D as value)) as p")
    assert pairs.select(rg.pairs_to_map("p").alias("m")).first()["m"] == {"lr": 0.1}


def test_fit_without_train_or_validation_rows(spark, rows, tmp_path):
    settings = tr.FitSettings(latent_dim=LATENT, hidden_dims=HIDDEN, max_epochs=3, patience=1, workers=2)
    none = rows.limit(0)
    still = tr.fit(none, rows, ["key"], "features", WIDTH, settings, str(tmp_path / "a"), weights())
    assert all((still.weights[n] == w).all() for n, w in weights().items())
    assert still.best_epoch == -1 and still.history.count() == 0
    for _ in range(2):  # the second time from the checkpoints
        done = tr.fit(rows, none, ["key"], "features", WIDTH, settings, str(tmp_path / "b"), weights())
        assert done.best_epoch == 2 and [r["val_loss"] for r in done.history.collect()] == [None] * 3
        assert all((done.weights[n] == done.last[0][n]).all() for n in done.weights)


def test_null_elements_give_null_scores(spark):
    df = spark.createDataFrame([(0, [1.0] * WIDTH), (1, [None] + [1.0] * (WIDTH - 1)), (2, [1.0] * WIDTH)], "key int, features array<double>")
    got = {r["key"]: r for r in md.infer(df, weights(), dtype="float64").collect()}
    assert got[1]["neg_log_likelihood"] is None and set(got[1]["mean_z"]) == {None}
    assert got[0][2:] == got[2][2:] and got[0]["neg_log_likelihood"] is not None
