import pytest

import __spark_entry__ as entry_point
from workload.oracles import ORACLES
from workload.queries import QUERIES
from compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_equivalent():
    assert set(QUERIES) == set(ORACLES)
    assert not set(QUERIES) - set(entry_point.queries()) and not set(ORACLES) - set(entry_point.oracle_sql())


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    found = differences(QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLES[name]).df())
    assert found is None, found


