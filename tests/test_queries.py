import pytest

from __spark_entry__ import SMOKE_FOLDER, entry, oracle_sql, queries
from smogline.plans.queries import ORACLES, QUERIES
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def connection():
    return connect(SMOKE_FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    assert differences(queries()[name](spark, SMOKE_FOLDER), connection, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
