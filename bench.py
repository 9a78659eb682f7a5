"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  table folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_NAIVE   set to 1 to time the plain formulations next to ours ("naive" in the output)
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orbitlens.functions.scalars import threshold_grid
from orbitlens.operators import evaluation as ev
from orbitlens.operators import ordered
from orbitlens.plans import catalog
from orbitlens.session import build_session, materialize

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "select_float_features", "preprocess_telemetry", "archive_chunks", "label_intervals", "label_intervals_bucketed",
    "test_window_mask", "train_val_test_split", "fit_standard_scaler", "scale_frames", "rolling_median_global",
    "rolling_median_user", "anomaly_intervals", "threshold_sweep", "tied_threshold_sweep", "batch_infer",
    "score_requests", "train_vae", "early_stop", "anomaly_detection",
]


def timed(make) -> float:
    start = time.perf_counter()
    df: DataFrame = make()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def naive(spark) -> dict[str, float]:
    """The same results by the plain formulations, and the rewritten operator on the same input."""
    rows, per = catalog.telemetry(spark, SF_DIR), catalog.periods(spark, SF_DIR)
    scored = catalog.scored(spark, SF_DIR)
    out = {}

    def nested_loop():
        inside = (F.col("start") <= F.col("ts")) & (F.col("ts") < F.col("end"))
        return rows.join(F.broadcast(per), inside, "left_semi")

    def one_window():
        w = Window.orderBy("ts", "event_id").rowsBetween(-99, 0)
        return rows.select("event_id", F.percentile("value", F.lit(0.5)).over(w))

    def cross_sweep():
        grid = threshold_grid(spark, catalog.LOW, catalog.HIGH, catalog.STEPS)
        hit = (-F.col(ev.SMOOTHED) < F.col("threshold")).cast("int")
        pairs = scored.crossJoin(F.broadcast(grid))
        return pairs.groupBy("threshold").agg(F.sum(hit), F.sum(hit * F.col("label")))

    def one_pass():
        return ev.threshold_sweep(scored, "ts", catalog.KEY, "label", catalog.LOW, catalog.HIGH, catalog.STEPS)

    def rolling(n):
        return lambda: ordered.rolling_median(rows, "value", ["ts", "event_id"], n_buckets=n)

    out["label_nested_loop"] = timed(nested_loop)
    out["label_cells"] = timed(lambda: catalog.labelled(spark, SF_DIR))
    out["rolling_one_window"] = timed(one_window)
    out["rolling_one_bucket"] = timed(rolling(1))
    out["rolling_16_buckets"] = timed(rolling(16))
    out["sweep_cross_join_points_only"] = timed(cross_sweep)
    out["sweep_one_pass"] = timed(one_pass)

    vectors = materialize(
        spark.range(200_000).select(F.transform(F.sequence(F.lit(1), F.lit(181)), lambda i: F.sin(i + F.col("id"))
                                                .cast("float")).alias("features")), "vectors")
    weights = catalog.md.init_weights(181, 100, 18)
    for size in (1_000, 10_000, 50_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        seconds = timed(lambda: catalog.md.infer(vectors, weights))
        out[f"infer_181_rows_per_sec_batch_{size}"] = round(200_000 / seconds)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    return out


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM paths and the Python workers before the clock runs
    catalog.QUERIES["rolling_median_global"](spark, SF_DIR).count()
    times = {name: timed(lambda: catalog.QUERIES[name](spark, SF_DIR)) for name in HEADLINE}
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else None,
    }
    if os.environ.get("BENCH_NAIVE"):
        line["naive"] = naive(spark)
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
