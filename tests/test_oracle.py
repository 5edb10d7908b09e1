"""Every registered query equals its SQL on the smallest tables."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from chartpost.plans.catalog import QUERIES
from chartpost.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_sql_is_not_vacuous(con, name):
    assert con.sql(ORACLE[name]).limit(1).fetchall()


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["idempotency_key", "patient_id", "code", "payload"]
    assert out.count() > 0
