"""Every query with SQL equals DuckDB on the small tables."""

import os

import pytest

import __spark_entry__ as entry
from holdfast.catalog.queries import QUERIES
from tests.compare import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    message, _ = differences(entry.queries()[name](spark, FOLDER), duck, ORACLE[name])
    assert message is None, message


#: What a fitted forest says about labels that no SQL can foretell; see tests/test_model.py.
FITTED = {"model_calibrate", "model_score", "model_metrics"}


def test_all_catalog_queries_have_sql():
    assert set(QUERIES) - set(ORACLE) == FITTED
    assert not set(ORACLE) - set(entry.queries())
