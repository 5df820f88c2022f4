"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    """But for some of the text queries, which no SQL expresses; their own tests hold them to other versions."""
    from sample_sql import ORACLES

    assert {q.__name__ for q in entry._QUERIES} == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) is None


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() == 6000 and df.columns[0] == "fact_id"
