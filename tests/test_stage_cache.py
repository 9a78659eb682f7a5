import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from orbitlens.operators.training import FitSettings
from orbitlens.plans.pipeline import run_pipeline
from orbitlens.plans.stage_cache import StageCache, digest_files

SF = "/root/testdata/sf0.001"


@pytest.fixture
def source(tmp_path):
    shutil.copytree(SF, tmp_path / "in", ignore=lambda d, names: [n for n in names if n != "events.parquet"])
    return tmp_path / "in" / "events.parquet"


def analysed(spark, rows, cache, source, **changes):
    found = rows.where("event_type = 'error' and value > 200").select(F.col("ts").alias("start"), (F.col("ts") + F.expr("interval 30 minutes")).alias("end"))
    settings = {"window": dt.timedelta(hours=2), "low": -1.6, "high": -0.95, "n_thresholds": 20,
                "fit_settings": FitSettings(latent_dim=2, hidden_dims=4, max_epochs=2, workers=2), **changes}
    return run_pipeline(rows.select("event_id", "ts", "value"), found, "ts", ["event_id"], ["value"], cache=cache, source=source, **settings)


def test_second_run_reads_no_input(spark, source, tmp_path):
    mark = digest_files(spark, str(source))
    assert mark == digest_files(spark, str(source))
    rows = spark.read.parquet(str(source))
    first = StageCache(spark, str(tmp_path / "cache"))
    want = analysed(spark, rows, first, mark)
    assert first.built == ["split", "scaler", "scored", "metrics", "results"] and not first.reused
    metrics, n = want.metrics.collect(), want.results.count()
    source.unlink()  # any scan of the input would fail now
    second = StageCache(spark, str(tmp_path / "cache"))
    again = analysed(spark, rows, second, mark)
    assert not second.built and second.reused == first.built
    assert again.metrics.collect() == metrics and again.results.count() == n and again.split.count() == 1000
    assert all((again.model.weights[k] == want.model.weights[k]).all() for k in want.model.weights)


def test_other_settings_and_unfinished_stages(spark, source, tmp_path):
    mark = digest_files(spark, str(source))
    rows = spark.read.parquet(str(source))
    first = StageCache(spark, str(tmp_path / "cache"))
    want = analysed(spark, rows, first, mark, fit_settings=None)
    assert first.built == ["split", "scaler", "metrics", "results"]
    other = StageCache(spark, str(tmp_path / "cache"))
    analysed(spark, rows, other, mark, fit_settings=None, n_thresholds=10)
    assert other.reused == ["split", "scaler"] and other.built == ["metrics", "results"]
    # a stage whose manifest was not committed is made again
    key, = [k for k in first.keys() if k.startswith("scaler")]
    (tmp_path / "cache" / key / "manifest" / "_SUCCESS").unlink()
    third = StageCache(spark, str(tmp_path / "cache"))
    assert third.manifest(key) is None
    again = analysed(spark, rows, third, mark, fit_settings=None)
    assert third.built == ["scaler"] and again.metrics.collect() == want.metrics.collect()
    with pytest.raises(ValueError, match="digest"):
        analysed(spark, rows, third, "")


def test_sweep(spark, tmp_path):
    cache = StageCache(spark, str(tmp_path / "cache"))
    assert cache.sweep() == []
    _, kept = cache.stage("a", ["x"], 1, lambda: spark.range(3))
    _, other = cache.stage("b", [kept], 1, lambda: spark.range(4))
    with pytest.raises(ZeroDivisionError):
        cache.stage("c", [], 1, lambda: 1 / 0)
    spark.range(2).write.parquet(str(tmp_path / "cache" / "d-left" / "rows"))
    assert cache.sweep() == ["d-left"] and cache.keys() == sorted([kept, other])
    assert cache.sweep([kept]) == [other] and cache.keys() == [kept]
    rows, _ = cache.stage("a", ["x"], 1, lambda: spark.range(99))
    assert rows.count() == 3


def test_all_rows_near_anomalies(spark, source, tmp_path):
    """Without train and validation rows there are no scores; the run still ends whole, and again from its stages."""
    mark = digest_files(spark, str(source))
    rows = spark.read.parquet(str(source))
    caches = [StageCache(spark, str(tmp_path / "cache")) for _ in range(2)]
    for cache in caches:
        done = analysed(spark, rows, cache, mark, window=dt.timedelta(days=60), choices={"lr": [0.01], "batch_size": [8.0], "beta": [0.1, 0.01]})
        assert {tuple(r) for r in done.results.select("neg_log_likelihood", "mean_z_0", "smoothed_neg_log_likelihood", "prediction_point",
                                                      "prediction_event", "dataset").collect()} == {(None, None, None, 0, 0, "test")}
        assert done.results.count() == 1000 and [tuple(r) for r in done.metrics.collect()] == [(0.0, 0.0, 0.0, -1.6)]
        assert [tuple(r) for r in done.scaler.collect()] == [("value", None, None)] and not done.model.history.count()
    assert caches[1].reused == caches[0].built and not caches[1].built
