"""The one-pass sweep equals evaluating the whole frame once per threshold."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbitlens.operators import evaluation as ev

BASE = dt.datetime(2024, 1, 1)
GRID = (-4.0, 0.0, 9)


def by_hand(rows, threshold):
    """Metrics and event predictions from the definitions, on rows sorted by (ts, key)."""
    spans, start = [], None
    for ts, _, label, _ in rows:
        if label == 1 and start is None:
            start = ts
        elif label != 1 and start is not None:
            spans.append((start, ts))
            start = None
    if start is not None:
        spans.append((start, rows[-1][0]))
    point = [int(-s < threshold) if not math.isnan(s) else 0 for *_, s in rows]
    event = list(point)
    for a, b in spans:
        inside = [i for i, r in enumerate(rows) if a <= r[0] <= b]
        if any(point[i] for i in inside):
            for i in inside:
                event[i] = 1
    tp = sum(p for p, r in zip(point, rows) if r[2])
    precision = tp / sum(point) if sum(point) else 0.0
    positives = sum(r[2] for r in rows)
    recall = sum(e for e, r in zip(event, rows) if r[2]) / positives if positives else 0.0
    f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
    return (precision, recall, f1), event


def random_rows(seed):
    rnd = random.Random(seed)
    n, stamps = rnd.choice([1, 6, 80, 250]), rnd.choice([2, 8, 40, 400])
    hot = rnd.random() < 0.5
    drawn = sorted(
        (BASE if hot and i % 3 == 0 else BASE + dt.timedelta(seconds=rnd.randrange(stamps)), i) for i in range(n)
    )
    rows, label = [], 0
    for ts, key in drawn:
        if rnd.random() < 0.3:
            label = rnd.randint(0, 1)
        rows.append((ts, key, label, rnd.choice([float("nan"), rnd.uniform(0, 4), float(rnd.randint(0, 4))])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, f"ts timestamp_ntz, key int, label int, {ev.SMOOTHED} double")


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("n", [1, 7])
def test_sweep_equals_definition(spark, seed, n):
    rows = random_rows(seed)
    df = frame(spark, rows).repartition(3)
    got = ev.threshold_sweep(df, "ts", ["key"], "label", *GRID, n_buckets=n).orderBy("threshold").collect()
    assert [r["threshold"] for r in got] == list(np.linspace(*GRID))
    for r in got:
        want, _ = by_hand(rows, r["threshold"])
        assert (r["point_precision"], r["event_recall"], r["composite_f1"]) == pytest.approx(want, abs=1e-12)
    predicted = ev.predict_events(ev.predict_points(df, -2.0), "ts", ["key"], "label", n_buckets=n)
    assert [r["prediction_event"] for r in predicted.orderBy("ts", "key").collect()] == by_hand(rows, -2.0)[1]


@pytest.mark.parametrize("at", ["last", "best"])
def test_evaluate(spark, at):
    rows = random_rows(3)
    results, metrics = ev.evaluate(frame(spark, rows), "ts", ["key"], "label", *GRID, predict_at=at)
    m = metrics.first()
    scored = {t: by_hand(rows, t)[0][2] for t in np.linspace(*GRID)}
    best = max(scored.values())
    assert m["composite_f1"] == pytest.approx(best)
    assert m["best_threshold"] == min(t for t, f in scored.items() if f == pytest.approx(best))
    threshold = m["best_threshold"] if at == "best" else 0.0
    event = [r["prediction_event"] for r in results.orderBy("ts", "key").collect()]
    assert event == by_hand(rows, threshold)[1]


def test_thresholds_match_linspace(spark):
    for low, high, n in [(-1500, 0, 500), (-200, -100, 100), (-1.1, -0.92, 7), (3, 3, 1)]:
        got = [r["threshold"] for r in ev.threshold_grid(spark, low, high, n).orderBy("j").collect()]
        assert got == list(np.linspace(low, high, n))


def test_score_equal_to_threshold_is_not_predicted(spark):
    rows = [(BASE + dt.timedelta(seconds=i), i, 1, float(s)) for i, s in enumerate([4, 3, 2, 1, 0])]
    got = ev.threshold_sweep(frame(spark, rows), "ts", ["key"], "label", *GRID).orderBy("threshold").collect()
    # strict: at -4 nothing lies below, at -3.5 only the score of -4 does
    assert [r["event_recall"] for r in got][:2] == [0.0, 1.0]


def test_tie_takes_lowest_threshold_and_zero_f1_gives_zeros(spark):
    sweep = spark.createDataFrame([(-3.0, 0.5, 0.5, 0.5), (-2.0, 0.5, 0.5, 0.5), (-1.0, 0.1, 0.1, 0.1)],
                                  "threshold double, point_precision double, event_recall double, composite_f1 double")
    assert ev.best_threshold(sweep).first()["best_threshold"] == -3.0
    nothing = sweep.withColumn("composite_f1", F.lit(0.0)).withColumn("point_precision", F.lit(0.0))
    assert tuple(ev.best_threshold(nothing).first()) == (0.0, 0.0, 0.0, -3.0)


@pytest.mark.parametrize("labels, scores", [([0, 0, 0], [1.0, 2.0, 3.0]), ([1, 1, 0], [0.0, 0.0, 0.0])])
def test_no_positives_or_no_predictions(spark, labels, scores):
    rows = [(BASE + dt.timedelta(seconds=i), i, label, s) for i, (label, s) in enumerate(zip(labels, scores))]
    got = ev.metrics_at_threshold(frame(spark, rows), "ts", ["key"], "label", -0.5).first()
    assert (got["event_recall"], got["composite_f1"]) == (0.0, 0.0)


def test_result_frame(spark):
    schema = "ts timestamp_ntz, key int, label int, neg_log_likelihood double, mean_z array<double>, log_var_z array<double>"
    rows = [(BASE + dt.timedelta(seconds=i), i, i % 2, float(i), [1.0 * i, 2.0], [3.0, 4.0]) for i in range(10)]
    df = spark.createDataFrame(rows, schema)
    got = ev.result_frame(df.filter("key < 5"), df.filter("key >= 5").drop("label"), "ts", ["key"], "label", latent=2)
    assert got.columns == ["ts", "key", "neg_log_likelihood", "dataset", "label", "mean_z_0", "log_var_z_0",
                           "mean_z_1", "log_var_z_1", "smoothed_neg_log_likelihood"]
    out = got.orderBy("ts").collect()
    assert [r["dataset"] for r in out] == ["test"] * 5 + ["validation"] * 5
    assert [r["label"] for r in out] == [0, 1, 0, 1, 0, 0, 0, 0, 0, 0]
    assert [r[ev.SMOOTHED] for r in out] == [i / 2 for i in range(10)]
