"""Global-order operators equal plain one-partition windows, whatever the buckets."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orbitlens.operators import ordered
from orbitlens.operators.ordered import (
    BUCKET,
    batch_numbers,
    number_within,
    order_frame,
    rolling_median,
    scan,
    with_row_number,
)

BASE = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    """900 rows, a third of them on one timestamp and a third of them of one unit."""
    rnd = random.Random(5)
    data = []
    for i in range(900):
        ts = BASE if i % 3 == 0 else BASE + dt.timedelta(seconds=rnd.randrange(-50, 50))
        unit = "hot" if rnd.random() < 0.33 else f"u{rnd.randrange(40)}"
        value = rnd.choice([None, float("nan"), rnd.uniform(0, 9), float(rnd.randrange(4))])
        data.append((ts, f"k{i:04d}", unit, value))
    return spark.createDataFrame(data, "ts timestamp_ntz, key string, unit string, v double").repartition(5).cache()


def plain(df, order, **columns):
    w = Window.orderBy(*order)
    return df.select("key", *[make(w).alias(n) for n, make in columns.items()])


@pytest.mark.parametrize("n", [1, 2, 13, 60, 400])
def test_scan_equals_window(rows, n):
    order = ["ts", "key"]
    start = Window.unboundedPreceding
    v = F.nanvl("v", F.lit(None))
    got = scan(
        order_frame(rows, order, n_buckets=n), rmax=("max", v), before=("max_before", v),
        total=("sum", F.lit(1)), prev=("lag", F.col("unit")), following=("lead", F.col("unit")),
    )
    want = plain(
        rows, order,
        e_rmax=lambda w: F.max(v).over(w.rowsBetween(start, 0)),
        e_before=lambda w: F.max(v).over(w.rowsBetween(start, -1)),
        e_total=lambda w: F.row_number().over(w),
        e_prev=lambda w: F.lag("unit").over(w),
        e_following=lambda w: F.lead("unit").over(w),
    )
    names = ["rmax", "before", "total", "prev", "following"]
    same = " and ".join(f"({c} <=> e_{c})" for c in names)
    joined = got.join(want, "key")
    assert joined.count() == 900
    assert joined.filter(f"not ({same})").count() == 0


def test_hot_timestamp_is_split(rows):
    frame = order_frame(rows, ["ts", "key"], n_buckets=12)
    sizes = [r["count"] for r in frame.df.groupBy(BUCKET).count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 200


def test_buckets_follow_the_order(rows):
    frame = order_frame(rows, ["unit", "ts", "key"], n_buckets=50)
    w = Window.orderBy("unit", "ts", "key")
    back = frame.df.withColumn("prev", F.lag(BUCKET).over(w)).filter(F.col("prev") > F.col(BUCKET))
    assert back.count() == 0


@pytest.mark.parametrize("n", [1, 7, 90])
@pytest.mark.parametrize("by", [[], ["unit"]])
def test_rolling_median_equals_window(rows, n, by):
    got = rolling_median(rows, "v", ["ts", "key"], window=100, by=by, out="m", n_buckets=n)
    w = Window.partitionBy(*by).orderBy("ts", "key").rowsBetween(-99, 0)
    want = rows.select("key", F.percentile(F.nanvl("v", F.lit(None)), F.lit(0.5)).over(w).alias("e"))
    joined = got.join(want, "key")
    assert joined.count() == 900
    assert joined.filter("not (m <=> e) and not (abs(m - e) < 1e-9)").count() == 0


def test_min_periods(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(6)], "i int, v double")
    got = rolling_median(df, "v", ["i"], window=3, min_periods=3, out="m", n_buckets=4).orderBy("i").collect()
    assert [r["m"] for r in got] == [None, None, 1.0, 2.0, 3.0, 4.0]


def test_numbers(rows):
    numbered = with_row_number(rows, ["ts", "key"], n_buckets=9).orderBy("ts", "key").collect()
    assert [r["row_number"] for r in numbered] == list(range(1, 901))
    batches = batch_numbers(rows, ["ts", "key"], 256, n_buckets=9).groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in batches} == {0: 256, 1: 256, 2: 256, 3: 132}


@pytest.mark.parametrize("n", [1, 9, 300])
def test_number_within(rows, n):
    within = number_within(rows, ["unit"], ["ts", "key"], "n", n_buckets=n)
    want = rows.select("key", F.row_number().over(Window.partitionBy("unit").orderBy("ts", "key")).alias("e"))
    joined = within.join(want, "key")
    assert joined.count() == 900 and joined.filter("n <> e").count() == 0


def test_same_result_under_any_layout(rows):
    runs = [rolling_median(rows.repartition(k), "v", ["ts", "key"], out="m", n_buckets=5) for k in (1, 3, 16)]
    tables = [sorted((r["key"], r["m"]) for r in run.select("key", "m").fillna(-1.0, ["m"]).collect()) for run in runs]
    assert tables[0] == tables[1] == tables[2]


def test_empty_frame(spark):
    empty = spark.createDataFrame([], "ts timestamp_ntz, key string, v double")
    assert rolling_median(empty, "v", ["ts", "key"], n_buckets=4).count() == 0
    assert with_row_number(empty, ["ts", "key"]).count() == 0


def test_no_single_partition_exchange_on_rows(rows):
    frame = order_frame(rows, ["ts", "key"], n_buckets=8)
    plan = frame.df.select(F.sum(F.lit(1)).over(frame.ascending()))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and BUCKET in plan


@pytest.mark.parametrize("shape", ["few", "ties", "far"])
def test_bucket_equals_bisect(spark, shape):
    from bisect import bisect_right

    from orbitlens.operators.ordered import _bucket_of

    rnd = random.Random(1)
    cuts = {
        "few": [(-5, "a"), (0, "b"), (7, "a")],
        "ties": sorted((rnd.randrange(5), f"t{rnd.randrange(10**4):05d}") for _ in range(300)),
        "far": sorted({(rnd.randrange(10**15), "m") for _ in range(5000)}),
    }[shape]
    probes = sorted({(v + d, t + e) for v, t in cuts[:400] for d in (-1, 0, 1) for e in ("", "x")})
    df = spark.createDataFrame(probes, "x bigint, y string")
    bucket = _bucket_of([(F.col("x"), "bigint"), (F.col("y"), "string")], cuts)
    got = {(r[0], r[1]): r[2] for r in df.select("x", "y", bucket).collect()}
    assert got == {p: bisect_right(cuts, p) for p in probes}


def test_very_many_buckets_over_repeated_leading_values(spark):
    rows = spark.range(40_000).select((F.col("id") % 1500).alias("user"), F.col("id").alias("key"))
    frame = order_frame(rows, ["user", "key"], n_buckets=4096)
    assert frame.n_buckets == 4096
    sizes = frame.df.groupBy(BUCKET).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] < 200 and sizes[1] > 3500


def test_cuts_count_as_plain_comparison_does():
    """Nulls first, NaN last, tied columns decided by the next one."""
    import math
    import random

    rng = random.Random(6)
    inf, nan = math.inf, math.nan
    for trial in range(60):
        first = [rng.choice([-inf, -1.0, 0.0, 1.0, inf]) for _ in range(12)]
        cuts = sorted((f, rng.randrange(4), rng.choice("abc")) for f in first)
        rows = [(rng.choice([None, nan, -inf, -1.0, 0.0, 0.5, inf]), rng.choice([None, 0, 1, 2, 3]), rng.choice([None, "", "a", "b", "c"]))
                for _ in range(80)]

        def rank(v):
            return (0, 0) if v is None else (2, 0) if v != v else (1, v)

        want = [sum(tuple(map(rank, c)) <= tuple(map(rank, r)) for c in cuts) for r in rows]
        keys = [(np.array([fill if r[i] is None else r[i] for r in rows], dtype=kind), np.array([r[i] is None for r in rows]))
                for i, (fill, kind) in enumerate(((0.0, float), (0, np.int64), ("", object)))]
        assert ordered.Cuts(cuts).not_above(keys).tolist() == want
