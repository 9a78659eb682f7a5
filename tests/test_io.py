"""Sources, sinks, streams and whole plans."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from orbitlens.functions import scalars as fn
from orbitlens.operators import model as md
from orbitlens.operators import plots
from orbitlens.operators import scaling as sc
from orbitlens.operators import training as tr
from orbitlens.plans.catalog import fixed_weights, periods, telemetry
from orbitlens.plans.pipeline import load_model, register_fit, run_pipeline
from orbitlens.plans.preprocess import run_preprocessing
from orbitlens.sources import readers as rd
from orbitlens.sources import writers as wr
from orbitlens.streaming import scoring as st

SF = "/root/testdata/sf0.001"


def one(spark, expression):
    return spark.range(1).select(expression).first()[0]


def test_day_of_year(spark):
    texts = ["2021/045/10:11:12", "2021/45/10:11:12", "2021/5/00:00:00", "2020/366/23:59:59", "garbage", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(fn.parse_day_of_year("t").cast("timestamp_ntz")).collect()]
    day = dt.datetime(2021, 2, 14, 10, 11, 12)
    assert got == [day, day, dt.datetime(2021, 1, 5), dt.datetime(2020, 12, 31, 23, 59, 59), None, None]


@pytest.mark.parametrize("path, want", [
    ("minio://a/b", "s3a://a/b"), ("/minio/a/b", "s3a://a/b"), ("minio/a/b", "s3a://a/b"),
    ("s3://a/minio/b", "s3://a/minio/b"), ("minio/a/minio/b", "s3a://a/minio/b")])
def test_paths(spark, path, want):
    assert one(spark, fn.normalize_path(F.lit(path))) == want == rd.uri(path)


def test_scalars(spark):
    assert one(spark, fn.path_year(F.lit("x/2020/y2021"))) == 2020
    assert one(spark, fn.path_year(F.lit("x/y"))) is None
    assert one(spark, fn.chunk_file_name(F.lit(0), F.lit(10))) == "row_groups_00000_to_00010.parquet"
    assert one(spark, fn.last_part(F.lit("a-b-c"))) == "c"
    name = one(spark, fn.unique_run_name("fit")).split("-")
    assert name[0] == "fit" and [len(p) for p in name[1:]] == [8, 6, 8]
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    assert one(spark, fn.plus(ts, dt.timedelta(hours=-250, microseconds=1))) == dt.datetime(
        2024, 1, 1) - dt.timedelta(hours=250) + dt.timedelta(microseconds=1)
    with_millis = F.lit("2024-01-01 01:02:03.456789").cast("timestamp_ntz")
    assert one(spark, fn.iso_millis(with_millis)) == "2024-01-01T01:02:03.456Z"


@pytest.fixture
def archives(spark, tmp_path):
    base = spark.range(0, 95, 1, 1).select(
        (F.timestamp_seconds(F.col("id") + 1_600_000_000)).alias("t"), F.col("id").cast("double").alias("a"),
        F.col("id").cast("float").alias("b"), F.lit("x").alias("text"), "id")
    for name in ("archive_2020", "archive_2021", "late_2021", "archive_none"):
        base.write.parquet(str(tmp_path / "in" / name))
    return tmp_path


def test_archive_chunks(spark, archives):
    rows, rejected = rd.read_archives(spark, str(archives / "in"))
    assert rejected.count() == 1 and "archive_none" in rejected.first()["archive"]
    listed = wr.write_archive_chunks(rows, str(archives / "out"), "t", rows_per_group=10, groups_per_chunk=4)
    got = [tuple(r) for r in listed.select("year", "chunk", "rows", "file_name").orderBy("year", "chunk").collect()]
    names = [f"row_groups_{a:05d}_to_{b:05d}.parquet" for a, b in ((0, 4), (4, 8), (8, 10))]
    parts = list(zip((0, 4, 8), (40, 40, 15), names))
    # two archives of one year keep their chunks apart
    assert got == [(2020, c, n, f) for c, n, f in parts] + [(2021, c, n, f) for c, n, f in parts for _ in range(2)]
    back = spark.read.parquet(str(archives / "out"))
    assert back.count() == 285 and back.filter("year = 2020 and chunk = 4").agg(F.min("id")).first()[0] == 40
    limited = wr.chunk_rows(rows, 10, 4, group_limit=3)
    assert limited.count() == 90


def test_preprocessing(spark, archives):
    out = run_preprocessing(spark, str(archives / "in" / "*"), "t", 0.5, str(archives / "pre"))
    assert out.columns == ["t", "row_key", "a", "b"]
    rows = out.collect()
    assert 140 < len(rows) < 285 and len({r["row_key"] for r in rows}) == len(rows)
    telemetry_rows = rd.read_telemetry(spark, [str(archives / "in" / "archive_2020")], "t", ("id",))
    assert telemetry_rows.columns == ["t", "id", "a", "b"] and telemetry_rows.count() == 95


@pytest.mark.parametrize("format", ["csv", "json", "parquet"])
def test_periods(spark, tmp_path, format):
    start, end = "EVENT GMT (DOY/HH:MM:SS)", "Duration/End GMT"
    df = spark.createDataFrame([("2021/045/10:11:12", "2021/45/11:11:12", "S1"), ("2021/046/00:00:00", None, "S2")],
                               [start, end, "SYMBOL"])
    path = str(tmp_path / format)
    (df.write.option("header", "true").csv(path) if format == "csv" else df.write.format(format).save(path))
    got = rd.read_periods(spark, path, start, end, format).orderBy("start").collect()
    assert [r["SYMBOL"] for r in got] == ["S1", "S2"] and got[1]["end"] is None
    assert got[0]["end"] - got[0]["start"] == dt.timedelta(hours=1)


def test_scaler_and_metrics_files(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "a double, b double")
    params = sc.fit_scaler(df, ["a", "b"])
    wr.write_scaler(params, str(tmp_path / "s"))
    assert sc.scaler_values(rd.read_frame(spark, str(tmp_path / "s"))) == {"a": (2.0, 1.0), "b": (2.0, 1.0)}
    metrics = spark.createDataFrame([(0.5, 1.0)], "point_precision double, event_recall double")
    wr.write_metrics(metrics, str(tmp_path / "m"))
    text = spark.read.text(str(tmp_path / "m")).first()[0]
    assert json.loads(text) == {"point_precision": 0.5, "event_recall": 1.0}
    assert {tuple(r) for r in wr.metric_rows(metrics).collect()} == {("point_precision", 0.5), ("event_recall", 1.0)}
    wr.write_frame(df, str(tmp_path / "f"), partition_by=["b"])
    assert rd.read_frame(spark, str(tmp_path / "f")).count() == 2


BODIES = [
    (0, '{"instances":[{"a":1,"b":2},{"a":3,"b":2}]}'),
    (1, '{"instances":[]}'),
    (2, "not json"),
    (3, '{"instances":[{"a":1}]}'),
    (4, '{"instances":[{"b":2,"a":1,"z":9}]}'),
]
SCALER = {"a": (1.0, 2.0), "b": (2.0, 1.0)}


def test_requests(spark):
    df = spark.createDataFrame(BODIES, st.REQUESTS)
    rows, rejected = rd.parse_requests(df, "body", "request_id")
    assert [r["request_id"] for r in rejected.collect()] == [2]
    wide = rd.instance_columns(rows, ["a", "b"], "request_id", "position").orderBy("request_id", "position").collect()
    assert [tuple(r) for r in wide] == [(0, 0, 1.0, 2.0), (0, 1, 3.0, 2.0), (3, 0, 1.0, None), (4, 0, 1.0, 2.0)]
    assert json.loads(spark.createDataFrame([(1.0, 2.0)], "a double, b double").select(
        wr.instances_json(["a", "b"])).first()[0]) == {"a": 1.0, "b": 2.0}


@pytest.mark.parametrize("weights", [None, fixed_weights(2, 4, 1)])
def test_stream_equals_batch(spark, tmp_path, weights):
    df = spark.createDataFrame(BODIES, st.REQUESTS)
    batch = {r["request_id"]: (r["response"], r["error"])
             for r in st.score_requests(df, ["a", "b"], SCALER, weights).collect()}
    assert batch[2] == (None, "malformed request") and batch[1][0] == '{"predictions":[]}'
    first = json.loads(batch[0][0])["predictions"]
    if weights is None:
        assert first == pytest.approx([1.8378770664, 1.8378770664 + 0.5])
    assert json.loads(batch[4][0])["predictions"] == pytest.approx(first[:1])
    df.repartition(3).write.json(str(tmp_path / "in"))
    stream = st.score_requests(st.read_request_stream(spark, str(tmp_path / "in"), 1), ["a", "b"], SCALER, weights)
    st.run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "offsets"))
    streamed = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r["request_id"]: (r["response"], r["error"]) for r in streamed} == batch


def test_score_vectors(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0)], "key int, a double, b double")
    w = fixed_weights(2, 4, 1)
    got = st.score_vectors(df, ["a", "b"], SCALER, w, dtype="float64").first()["nll"]
    import numpy as np

    assert got == pytest.approx(md.infer_rows(w, np.zeros((1, 2)))[-1][0])


def test_chunks_are_written_without_a_shuffle(spark, archives):
    rows, _ = rd.read_archives(spark, str(archives / "in"))
    plan = wr.chunk_rows(rows, 10, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_filter_and_columns_reach_the_scan(spark):
    plan = periods(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(value), EqualTo(event_type,error)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan


@pytest.mark.parametrize("options", [{}, {"n_buckets": 5}])
def test_pipeline_with_model(spark, tmp_path, options):
    rows = telemetry(spark, SF).withColumn("twice", F.col("value") * 2)
    settings = tr.FitSettings(latent_dim=2, hidden_dims=4, mixing=0.01, max_epochs=2, workers=2)
    done = run_pipeline(rows, periods(spark, SF), "ts", ["event_id"], ["value", "twice"],
                        window=dt.timedelta(hours=2), low=-20, high=0, n_thresholds=50, fit_settings=settings,
                        choices={"lr": [1e-3, 1e-2], "batch_size": [32], "beta": [1e-4]}, max_trials=2, **options)
    m = done.metrics.first()
    assert done.trials.count() == 2 and done.model.settings.lr in (1e-3, 1e-2)
    registry, weights = str(tmp_path / "runs"), str(tmp_path / "weights")
    register_fit(spark, done.model, "nightly", registry, weights)
    back = load_model(spark, "nightly", registry, weights)
    assert all((back[n] == w).all() for n, w in done.model.weights.items())
    assert 0 <= m["composite_f1"] <= 1 and done.model.history.count() == 2
    assert done.results.columns == [
        "ts", "event_id", "neg_log_likelihood", "dataset", "Anomaly", "mean_z_0", "log_var_z_0", "mean_z_1",
        "log_var_z_1", "smoothed_neg_log_likelihood", "prediction_point", "prediction_event"]
    assert done.results.count() == done.split.filter("split <> 'train'").count()
    assert done.promoted.count() == int(m["composite_f1"] > 0.7)
    bands = plots.result_bands(done.results, "ts", ["event_id"], "Anomaly")
    assert {r["kind"] for r in bands.collect()} == {"test", "anomaly"}


def test_paths_are_taken_apart_once_a_file(spark, archives):
    """No expression of the path is worked out for every row of the archives."""
    rows, _ = rd.read_archives(spark, str(archives / "in"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "split" not in plan
    assert {tuple(r) for r in rows.groupBy("year").count().collect()} == {(2020, 95), (2021, 190)}


def test_archive_chunks_modes_and_types(spark, archives):
    rows, _ = rd.read_archives(spark, str(archives / "in"))
    late = rows.filter("archive like '%archive_2020%'")
    write = lambda mode: wr.write_archive_chunks(late, str(archives / "kept"), "t", 10, 4, mode=mode)
    first = write("error")
    assert first.schema["start"].dataType == rows.schema["t"].dataType
    start = lambda: late.agg(F.min("t"), F.max("t")).first()
    assert tuple(first.agg(F.min("start"), F.max("end")).first()) == tuple(start())
    with pytest.raises(ValueError, match="exists"):
        write("error")
    assert write("append").agg(F.sum("rows")).first()[0] == 190
    assert write("overwrite").agg(F.sum("rows")).first()[0] == 95
