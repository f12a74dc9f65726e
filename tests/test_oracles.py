"""Every registered query against its oracle."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import compare
from meterflow.plans.oracles import ORACLES
from meterflow.plans.queries import QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf, name):
    same, detail = compare(spark, name, sf)
    assert same, detail


def test_entry_runs(spark):
    assert len(entry(spark).columns) == 15
