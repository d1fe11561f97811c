"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entries
from branchyard.plans.oracles import ORACLES
from branchyard.plans.queries import QUERIES
from check import compare, views


@pytest.fixture(scope="module")
def connection(sf_dir):
    return views(sf_dir)


def test_every_query_of_the_core_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert entries.oracle_sql().keys() <= entries.queries().keys()


@pytest.mark.parametrize("name", list(entries.oracle_sql()))
def test_query(spark, connection, sf_dir, name):
    result, _ = compare(spark, connection, sf_dir, name)
    assert result.startswith("ok"), result


def test_entry(spark):
    frame = entries.entry(spark)
    assert frame.columns == ["ref", "n_rows"]
    assert {r["ref"] for r in frame.collect()} == {"main", "dev", "etl", "experiment"}
