"""Every query with an SQL twin, compared as whole results."""

import pytest

from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.queries import QUERIES


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_rows(spark, folder, duck, name):
    ours = QUERIES[name](spark, folder).toPandas()
    assert difference(ours, duck.sql(ORACLES[name]).df()) is None
