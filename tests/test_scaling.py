import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbitlens.operators import scaling as sc

NAN = float("nan")


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, float(i), 0.1, NAN if i == 2 else float(i * i), None if i == 3 else 2.0 * i, None, i % 2)
            for i in range(6)]
    return spark.createDataFrame(data, "key int, a double, b double, c double, d double, e double, label int")


FEATURES = ["a", "b", "c", "d", "e"]


def test_standard(rows):
    got = sc.scaler_values(sc.fit_scaler(rows, FEATURES))
    c, d = np.array([0, 1, 9, 16, 25.0]), np.array([0, 2, 4, 8, 10.0])
    assert got["a"] == pytest.approx((2.5, np.std(range(6))))
    assert got["b"] == (pytest.approx(0.1), 1.0)
    assert got["c"] == pytest.approx((c.mean(), c.std()))
    assert got["d"] == pytest.approx((d.mean(), d.std()))
    assert got["e"] == (None, None)


def test_minmax(rows):
    got = sc.scaler_values(sc.fit_scaler(rows, FEATURES[:4], "minmax"))
    assert got == {"a": (0.0, 5.0), "b": (0.1, 1.0), "c": (0.0, 25.0), "d": (0.0, 10.0)}


def test_transform(rows):
    params = sc.fit_scaler(rows, ["a", "b", "c"])
    out = sc.scale_columns(rows, params)
    assert out.columns == rows.columns
    stats = out.agg(F.avg("a"), F.stddev_pop("a"), F.max("b"), F.sum("label")).first()
    assert tuple(stats) == pytest.approx((0, 1, 0, 3), abs=1e-12)
    assert math.isnan(out.filter("key = 2").first()["c"])
    train, test = sc.scale_frames([rows, rows.filter("key > 3")], params)
    assert train.count() == 6 and test.count() == 2


def test_errors(rows):
    with pytest.raises(ValueError, match="robust"):
        sc.fit_scaler(rows, FEATURES, "robust")
    with pytest.raises(ValueError, match="missing"):
        sc.scale_columns(rows.drop("a"), sc.fit_scaler(rows, ["a"]))


def test_many_features(spark):
    names = [f"f{i}" for i in range(181)]
    df = spark.range(50).select(*[(F.col("id") * (i + 1)).cast("double").alias(n) for i, n in enumerate(names)])
    got = sc.scaler_values(sc.fit_scaler(df, names))
    assert list(sorted(got)) == sorted(names)
    assert got["f180"] == pytest.approx((24.5 * 181, np.std(range(50)) * 181))


def test_float_columns_and_width(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, "x", True)], "i int, d double, f float, s string, b boolean")
    assert sc.float_columns(df) == ["d", "f"]
    cut = df.select(sc.first_features(sc.feature_vector(["d", "f"]), 1)).first()[0]
    assert cut == [1.0]
    v = spark.createDataFrame([([1.0, 2.0],), ([1.0],), ([1.0, None],), (None,)], "v array<double>")
    assert [r[0] for r in v.select(sc.valid_width("v", 2)).collect()] == [True, False, False, False]


def test_frame_without_rows(spark):
    none = spark.createDataFrame([], "a double, b double")
    params = sc.fit_scaler(none, ["a", "b"])
    assert sc.scaler_values(params) == {"a": (None, None), "b": (None, None)}
    assert [tuple(r) for r in sc.scale_columns(spark.createDataFrame([(1.0, 2.0)], "a double, b double"), params).collect()] == [(None, None)]
