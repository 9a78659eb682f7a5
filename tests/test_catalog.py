"""Every registered query equals its SQL twin on the smallest tables."""

import pytest
from compare import connect, difference

from orbitlens.plans import catalog, fits, oracles, roundtrips

SF = "/root/testdata/sf0.001"
QUERIES = catalog.QUERIES
ORACLES = {**oracles.ORACLES, **roundtrips.ORACLES, **fits.ORACLES}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        assert difference(got, con.execute(ORACLES[name]).df()) == ""
    else:
        assert len(got)


def test_only_model_fits_lack_sql():
    assert set(QUERIES) - set(ORACLES) == {"train_vae", "random_search"}
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["point_precision", "event_recall", "composite_f1", "best_threshold"]
