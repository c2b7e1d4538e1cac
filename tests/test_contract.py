"""The driver contract, and every query against its oracle at the smallest scale."""

import pytest

import __spark_entry__ as contract
from tests.support import SMALL, compare, duck
from textpulse.catalog.oracles import ORACLES
from textpulse.catalog.queries import QUERIES
from textpulse.session import scratch_dir



@pytest.fixture(scope="module")
def engine():
    return duck(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, engine, name):
    actual = contract.queries()[name](spark, SMALL).toPandas()
    assert len(actual) > 0
    assert compare(actual, engine.execute(ORACLES[name]).fetchdf()) is None


def test_scratch_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    if shared:
        assert first.startswith(shared)
