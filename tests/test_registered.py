"""Every registered query against its SQL, on the smallest data set."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.oracles import ORACLES
from catalog.queries import QUERIES
from check import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["city", "region", "avg_salary_min", "avg_salary_max", "job_count"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    outcome, _ = compare(spark, con, name, SF_DIR)
    assert outcome == "ok", outcome
