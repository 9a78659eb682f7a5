import datetime as dt

import pytest
from pyspark.sql import functions as F

from orbitlens.operators import sampling as sm

BASE = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    data = [(BASE + dt.timedelta(minutes=i // 3), i, int(i in (300, 301, 900)), float(i)) for i in range(1000)]
    return spark.createDataFrame(data, "ts timestamp_ntz, key int, label int, v double")


def keys(df):
    return sorted(r["key"] for r in df.select("key").collect())


def test_sample_is_stable_under_layout(rows):
    want = keys(sm.sample_rows(rows, ["key"], 0.1))
    assert 60 < len(want) < 140
    for n in (1, 3, 16):
        assert keys(sm.sample_rows(rows.repartition(n), ["key"], 0.1)) == want
    assert keys(sm.sample_rows(rows, ["key"], 0.1, seed=7)) != want


@pytest.mark.parametrize("exact", [False, True])
def test_split_is_complete_and_disjoint(rows, exact):
    split = sm.split_rows(rows, "ts", ["key"], "label", dt.timedelta(minutes=5), exact=exact)
    train, validation, test = sm.split_frames(split, ["v"], "ts", ["key"], "label")
    parts = [keys(f) for f in (train, validation, test)]
    assert sorted(sum(parts, [])) == list(range(1000))
    near = [i for i in range(1000) if any(abs(i // 3 - p // 3) <= 5 for p in (300, 301, 900))]
    assert parts[2] == near
    assert "label" in test.columns and "label" not in train.columns and "label" not in validation.columns
    rest = 1000 - len(near)
    assert abs(len(parts[0]) - 0.8 * rest) < (1 if exact else 50)


@pytest.mark.parametrize("n, want", [(5, 2), (7, 4), (9, 4), (1, 0), (0, 0)])
def test_exact_share_rounds_halves_to_even(spark, n, want):
    df = spark.range(n).withColumnRenamed("id", "key").withColumn("ts", F.lit(BASE)).withColumn("label", F.lit(0))
    split = sm.split_rows(df, "ts", ["key"], "label", dt.timedelta(0), train_fraction=0.5, exact=True)
    assert split.filter("split = 'train'").count() == want


def test_drop_by_timestamp_loses_ties(rows):
    train = rows.filter("key % 3 = 0")
    assert sm.drop_by_timestamp(rows, train, "ts").count() == 0
    assert keys(sm.drop_by_timestamp(rows, rows.filter("key = 4"), "ts")) == [i for i in range(1000) if i // 3 != 1]


def test_trials(spark):
    choices = {"lr": [0.1, 0.2], "batch_size": [32], "beta": [1e-3, 1e-4, 1e-4]}
    drawn = [tuple(r) for r in sm.draw_trials(spark, choices, 4).orderBy("trial").collect()]
    assert [d[0] for d in drawn] == [0, 1, 2, 3]
    assert drawn == [tuple(r) for r in sm.draw_trials(spark, choices, 4).orderBy("trial").collect()]
    everything = sm.draw_trials(spark, choices, 99)
    assert everything.count() == 6 and everything.filter("beta = 0.0001").count() == 4
