"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["site_code", "rank", "device_id", "value_sum"]
    assert df.count() > 0
