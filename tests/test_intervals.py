import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from orbitlens.operators import intervals as iv
from orbitlens.operators import period_index

BASE = dt.datetime(2024, 1, 1)
US = dt.timedelta(microseconds=1)


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


def frame(spark, stamps, *labels):
    rows = [(t, i, *[column[i] for column in labels]) for i, t in enumerate(stamps)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, key int" + ", label int" * len(labels))


def periods(spark, pairs):
    return spark.createDataFrame(pairs, "start timestamp_ntz, end timestamp_ntz")


def labels(df):
    return [r["label"] for r in df.orderBy("key").collect()]


@pytest.mark.parametrize("method", ["index", "cells", "scan"])
def test_half_open_bounds(spark, method):
    df = frame(spark, [at(0), at(10), at(10) - US, at(0) - US])
    got = iv.label_rows(df, "ts", periods(spark, [(at(0), at(10))]), "label", method=method)
    assert labels(got) == [1, 0, 1, 0]


@pytest.mark.parametrize("method", ["index", "cells", "scan"])
def test_odd_periods(spark, method):
    """Null ends, reversed, empty, overlapping, touching, nested."""
    pairs = [(at(0), None), (at(9), at(3)), (at(5), at(5)), (at(20), at(30)), (at(25), at(35)), (at(35), at(40)),
             (at(50), at(90)), (at(60), at(61))]
    df = frame(spark, [at(s) for s in (1, 5, 20, 29, 34, 35, 39, 40, 55, 60, 75, 90)])
    got = iv.label_rows(df, "ts", periods(spark, pairs), "label", method=method)
    assert labels(got) == [0, 0, 1, 1, 1, 1, 1, 0, 1, 1, 1, 0]


@pytest.mark.parametrize("method", ["index", "cells", "scan"])
def test_no_periods(spark, method):
    got = iv.label_rows(frame(spark, [at(1), at(2)]), "ts", periods(spark, []), "label", method=method)
    assert labels(got) == [0, 0]


def test_null_timestamp_is_outside(spark):
    df = spark.createDataFrame([(None, 0), (at(1), 1)], "ts timestamp_ntz, key int")
    for method in ("index", "cells", "scan"):
        assert labels(iv.label_rows(df, "ts", periods(spark, [(at(0), at(5))]), "label", method=method)) == [0, 1]


@pytest.mark.parametrize("n", [1, 8])
def test_merge_equals_sweep_line(spark, n):
    rnd = random.Random(n)
    pairs = [(at(s), at(s + rnd.randrange(-2, 9))) for s in (rnd.randrange(400) for _ in range(120))]
    want = []
    for s, e in sorted(p for p in pairs if p[0] < p[1]):
        if want and s <= want[-1][1]:
            want[-1][1] = max(want[-1][1], e)
        else:
            want.append([s, e])
    got = iv.merge_periods(periods(spark, pairs), n_buckets=n).orderBy("start").collect()
    assert [[r["start"], r["end"]] for r in got] == want


def test_methods_agree_on_random_rows(spark):
    rnd = random.Random(3)
    pairs = [(at(s), at(s + rnd.randrange(1, 30))) for s in (rnd.randrange(3000) for _ in range(60))]
    # a third of all rows on one timestamp
    df = frame(spark, [at(700) if i % 3 == 0 else at(rnd.randrange(3000)) for i in range(600)])
    want = [int(any(s <= r["ts"] < e for s, e in pairs)) for r in df.orderBy("key").collect()]
    per = periods(spark, pairs)
    assert labels(iv.label_rows(df, "ts", per, "label")) == want
    assert labels(iv.label_rows(df, "ts", per, "label", method="scan", key=["key"], n_buckets=10)) == want


def test_dense_next_to_very_long_periods(spark):
    """Many periods close together, one far away, one of years and some of a microsecond."""
    pairs = [(at(i * 2), at(i * 2 + 1)) for i in range(200)] + [(at(10**7), at(10**7 + 5)), (at(10**8), at(3 * 10**8))]
    pairs += [(at(1000 + i), at(1000 + i) + US) for i in range(30)]
    per = periods(spark, pairs)
    stamps = [at(i) for i in range(400)] + [at(10**7 + 4), at(10**7 + 5), at(2 * 10**8), at(3 * 10**8), at(1007), at(1007) + US]
    assert labels(iv.label_rows(frame(spark, stamps), "ts", per, "label")) == [1, 0] * 200 + [1, 0, 1, 0, 1, 0]


def test_mask_of_very_many_positives(spark):
    """More than 100,000 labelled rows, a third of them on one timestamp, with keys as the pipeline hands them on."""
    rows = spark.range(150_000).select(
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 100)).alias("ts"), F.col("id").alias("key"))
    df = rows.withColumn("label", F.lit(1)).union(
        spark.range(1000).select(F.timestamp_seconds(F.col("id") * 15_000 + 50), F.col("id") + 200_000, F.lit(0)))
    got = iv.mark_near(df, "ts", F.col("label") == 1, dt.timedelta(seconds=10), "near", key=["key"], rows_per_bucket=20_000)
    counts = {(r["label"], r["near"]): r["count"] for r in got.groupBy("label", "near").count().collect()}
    assert counts == {(1, 1): 150_000, (0, 0): 1000}


def test_window_is_closed(spark):
    stamps = [at(100), at(90), at(110), at(90) - US, at(110) + US, at(300), at(105), at(117), at(500), at(501)]
    label = [1, 0, 0, 0, 0, 0, 1, 0, 1, 1]
    got = iv.mark_near(frame(spark, stamps, label), "ts", F.col("label") == 1, dt.timedelta(seconds=10), "near")
    near = [r["near"] for r in got.orderBy("key").collect()]
    assert near == [1, 1, 1, 0, 1, 0, 1, 0, 1, 1]


def test_mask_equals_loop(spark):
    rnd = random.Random(8)
    stamps = [at(rnd.randrange(4000)) for _ in range(300)]
    label = [int(rnd.random() < 0.05) for _ in stamps]
    width = dt.timedelta(seconds=25)
    want = [int(any(abs(t - p) <= width for p, on in zip(stamps, label) if on)) for t in stamps]
    df = frame(spark, stamps, label)
    got = iv.mark_near(df, "ts", F.col("label") == 1, width, "near")
    assert [r["near"] for r in got.orderBy("key").collect()] == want


@pytest.mark.parametrize("n", [1, 5])
@pytest.mark.parametrize(
    "label, want",
    [
        ([1, 1, 0, 0], [(0, 2)]),
        ([0, 0, 1, 1], [(2, 3)]),
        ([0, 1, 0, 1], [(1, 2), (3, 3)]),
        ([0, 0, 0, 0], []),
        ([1, 1, 1, 1], [(0, 3)]),
    ],
)
def test_runs(spark, n, label, want):
    df = frame(spark, [at(i) for i in range(4)], label)
    got = iv.runs(df, "ts", ["key"], F.col("label") == 1, n_buckets=n).orderBy("start").collect()
    assert [(r["start"], r["end"]) for r in got] == [(at(a), at(b)) for a, b in want]


def test_closed_end_counts_as_hit(spark):
    """Only the first row after the event is predicted: the event counts."""
    df = frame(spark, [at(i) for i in range(5)], [0, 1, 1, 0, 0]).withColumn("hit", (F.col("key") == 3).cast("int"))
    got = iv.spread_hits(df, "ts", ["key"], "label", "hit", "event").orderBy("key").collect()
    assert [r["event"] for r in got] == [0, 1, 1, 1, 0]


def test_index_beyond_its_limit_goes_another_way(spark, monkeypatch):
    rng = random.Random(8)
    pairs = [(at(a), at(a + rng.randrange(0, 40))) for a in rng.sample(range(3000), 300)]
    df = frame(spark, [at(rng.randrange(3100)) for _ in range(500)])
    want = labels(iv.label_rows(df, "ts", periods(spark, pairs), "label"))
    small = period_index.build
    monkeypatch.setattr(period_index, "build", lambda p, **kw: small(p, **{**kw, "limit": 20}))
    assert small(periods(spark, pairs), limit=20) is None
    assert labels(iv.label_rows(df, "ts", periods(spark, pairs), "label", key=["key"])) == want


@pytest.mark.parametrize("limit", [1 << 20, 3])
def test_windows_from_stretches_equal_all_pairs(spark, monkeypatch, limit):
    rng = random.Random(limit)
    stamps = sorted(rng.randrange(2000) for _ in range(600))
    marks = [int(rng.random() < 0.03) for _ in stamps]
    width = 7
    hits = [t for t, m in zip(stamps, marks) if m]
    want = [int(any(abs(t - h) <= width for h in hits)) for t in stamps]
    small = period_index.build
    monkeypatch.setattr(period_index, "build", lambda p, **kw: small(p, **{**kw, "limit": limit}))
    df = frame(spark, [at(t) for t in stamps], marks).withColumnRenamed("label0", "label")
    got = iv.mark_near(df.toDF("ts", "key", "hit"), "ts", F.col("hit") == 1, dt.timedelta(seconds=width), "label", key=["key"])
    assert labels(got) == want


def test_index_against_all_pairs():
    rng = random.Random(2)
    for closed in (False, True):
        pairs = [(a, a + rng.randrange(-3, 30)) for a in (rng.randrange(-500, 500) for _ in range(60))]
        starts, ends = (period_index.np.array(x, period_index.np.int64) for x in zip(*pairs))
        index = period_index.merged(starts, ends, dt.timedelta(0), closed)
        stamps = list(range(-510, 540))
        want = [int(any(a <= t and (t <= b if closed else t < b) and (a <= b) for a, b in pairs)) for t in stamps]
        assert index.inside(period_index.np.array(stamps)).tolist() == want
        assert (index.starts[1:] > index.ends[:-1]).all()
