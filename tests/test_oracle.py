"""Every query against its SQL on the smallest tables; those without SQL must give rows."""

import pytest

from workload.check import compare
from workload.oracle import ORACLE
from workload.queries import QUERIES


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, sf_dir, name):
    assert compare(spark, duck, sf_dir, name) is None
