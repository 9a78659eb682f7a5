"""Whitened rows against numpy on exact integers."""

import math

import numpy as np
import pytest

from orbitlens.llm import registry, whitening

SCHEMA = "vec_id long, embedding array<float>, x string, whitened string, n int"


def plain(rows, components=32):
    """{(vec_id, occurrence): (deviation, projections without sign)} and shares, in Python integers and numpy."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, dims = len(kept), len(kept[0][1])
    sums = [sum(x[d] for _, x in kept) for d in range(dims)]
    a = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for _, x in kept])
    values, vectors = np.linalg.eigh(a.T @ a / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    white = a @ (vectors[:, :k] / np.sqrt(values[:k]))
    dev = [sum((n * c - s) ** 2 for c, s in zip(x, sums)) for _, x in kept]
    return [i for i, _ in kept], dev, white, values[:k] / values.sum()


def matched(got, rows, components=32):
    """The result's rows equal the plain ones up to one sign per component."""
    ids, dev, white, shares = plain(rows, components)
    assert len(got) == len(ids)
    key = lambda i, d: (i is None, i or 0, d)
    want = sorted(zip(ids, dev, white.tolist()), key=lambda r: (key(r[0], r[1]), [abs(round(c, 6)) for c in r[2]]))
    got = sorted(((r["vec_id"], r["deviation"], list(r["whitened"])) for r in got),
                 key=lambda r: (key(r[0], r[1]), [abs(round(c, 6)) for c in r[2]]))
    assert [r[:2] for r in got] == [r[:2] for r in want]
    g, w = np.array([r[2] for r in got]), np.array([r[2] for r in want])
    sign = np.sign((g * w).sum(axis=0))
    np.testing.assert_allclose(g * sign, w, atol=1e-7)
    return shares


def random_rows(n, dims, seed):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(n, dims)) * np.linspace(3, 0.5, dims)
    return [(i, a[i].astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("cells, slab", [(6 * 7, 3), (1 << 18, 1024)])
def test_odd_rows_in_small_blocks_and_slabs(spark, cells, slab):
    rows = random_rows(200, 6, 1)
    rows += [(None, rows[0][1]), (-(2**63), rows[3][1]), (2**63 - 1, rows[4][1]), (7, rows[7][1]), (7, rows[7][1])]
    odd = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (904, [1.0, 2.0]), (905, [])]
    df = spark.createDataFrame([(i, v, "a", "b", 1) for i, v in rows + odd], SCHEMA).repartition(5)
    done, model = whitening.whiten(df, block_cells=cells, slab=slab)
    shares = matched(done.collect(), rows)
    np.testing.assert_allclose(model.values / model.trace, shares, rtol=1e-9)
    assert whitening.identity_error(done) < 1e-9
    assert model.rows == len(rows)


def test_flat_dimensions_and_few_components(spark):
    rows = [(i, [*v, 1.0, v[0]]) for i, v in random_rows(50, 4, 2)]  # a constant and a repeated dimension
    df = spark.createDataFrame([(i, v, "a", "b", 1) for i, v in rows], SCHEMA)
    done, model = whitening.whiten(df)
    assert model.rank == 4
    matched(done.collect(), rows)
    assert {len(r["whitened"]) for r in whitening.whiten(df, components=2)[0].collect()} == {2}


def test_nothing_to_whiten(spark):
    empty, model = whitening.whiten(spark.createDataFrame([], SCHEMA))
    assert model is None and empty.count() == 0 and whitening.identity_error(empty) == 0
    equal, model = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], "a", "b", 1) for i in range(9)], SCHEMA))
    assert model.rank == 0 and equal.count() == 0


def test_deviations_beyond_a_long():
    x = np.array([[0, 0], [4 * 10**9, 1]])
    dev, fits = whitening.deviations(x, 2, x.sum(axis=0))
    assert fits.tolist() == [False, False]
    dev, fits = whitening.deviations(x // 10, 2, (x // 10).sum(axis=0))
    assert fits.all() and dev.tolist() == [(4 * 10**8) ** 2] * 2


def test_query_equals_plain(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = registry.QUERIES["op11_whitening"](spark, sf).toPandas()
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    wide = got.sort_values("component").groupby("vec_id").agg({"deviation": "first", "whitened": list}).reset_index()
    shares = matched(wide.to_dict("records"), rows)
    np.testing.assert_allclose(got.groupby("component")["explained"].first(), shares, rtol=1e-9)
    assert set(got["n"]) == {len(rows)} and got["identity_error"].nunique() == 1 and got["identity_error"].max() < 1e-9
