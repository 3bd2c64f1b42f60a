"""Every registered query against its SQL on DuckDB; queries without SQL must give rows."""

import pytest

import harness
from millrace.registry import ORACLES, QUERIES

import millrace.queries  # noqa: F401


@pytest.fixture(scope="module")
def duck(sf_dir):
    return harness.connect(sf_dir)


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_rows(spark, sf_dir, duck, name):
    difference = harness.compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name])
    assert difference is None, difference


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).take(1)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
