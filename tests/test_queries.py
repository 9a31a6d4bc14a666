"""Every registered query against its SQL, over the whole smallest tables."""

import pytest

from inkprint.plans import catalog
from tests.oracle import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, con, name):
    assert difference(catalog.QUERIES[name](spark, SF), con, catalog.ORACLES[name]) is None


@pytest.mark.parametrize("name", ["logistic_regression", "linear_svm", "random_forest", "model_zoo"])
def test_fitted_models_beat_the_majority_label(spark, name):
    rows = catalog.QUERIES[name](spark, SF).collect()
    assert rows and all(r.accuracy > 0.8 for r in rows)
    assert {r.split for r in rows} == {"validation", "test"}


def test_reloaded_model_is_reused(spark):
    rows = catalog.QUERIES["model_reload"](spark, SF).collect()
    assert rows and all(r.reused for r in rows)


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
