"""Every registered query against its SQL twin in another engine."""

import pytest

import __spark_entry__ as E
import check
from attrspark.plans.oracle import ORACLES
from attrspark.plans.queries import QUERIES


@pytest.fixture(scope="module")
def connection(tables):
    return check.oracle(tables)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, tables, connection, name):
    verdict, rows, _ = check.compare(spark, connection, tables, name)
    assert verdict == "ok"
    assert rows > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry(spark):
    frame = E.entry(spark)
    assert frame.columns[0] == "vec_id"
    assert frame.count() == 500
