"""Every query against its SQL on the given tables."""

import pytest

from inkloom.workload.oracles import ORACLES
from inkloom.workload.registry import QUERIES
from tests.compare import connect, difference


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == ""
