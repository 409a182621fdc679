"""Every named query against its SQL on the smallest test data."""

import pytest
from compare import connect, difference
from conftest import SF_DIR

import __spark_entry__ as entry
from revmart.plans.queries import QUERIES as OWN

QUERIES = {name: entry.queries()[name] for name in OWN}
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    with connect(SF_DIR) as con:
        yield con


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) is None


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["source_system", "registration_id"]
    assert df.limit(1).count() == 1
