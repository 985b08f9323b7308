"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from starmill.catalog import ORACLES, QUERIES  # noqa: E402
from check_oracles import compare, open_tables  # noqa: E402


@pytest.fixture(scope="module")
def db():
    return open_tables(FOLDER)


# Operators that compare all pairs of rows, or that run Python on rows.
UNWANTED = ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = queries()[name](spark, FOLDER)
    outcome = compare(df, db, oracle_sql().get(name))
    assert outcome.startswith("ok"), outcome
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in UNWANTED if operator in plan]


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry_offers_every_query():
    assert QUERIES.keys() <= queries().keys()
    assert oracle_sql().keys() <= queries().keys()


def test_entry(spark):
    assert entry(spark).count() > 0
