"""Every registered query against its SQL twin on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from oracle_check import compare, duckdb_on
from tripweave.plans import pipeline
from tripweave.plans.catalog import QUERIES

SF_DIR = contract.SMOKE_TABLES

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return duckdb_on(SF_DIR)


@pytest.fixture(scope="module")
def one_run(spark):
    """All stream queries read one run with every job, to keep the suite short."""
    lake = pipeline.run(spark, SF_DIR, *pipeline.GOLD_JOBS)
    original, pipeline.run = pipeline.run, lambda *_: lake
    yield
    pipeline.run = original


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, one_run, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
