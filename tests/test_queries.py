from __future__ import annotations

import pytest
from check_queries import compare

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    own = {**contract.ingest.QUERIES, **contract.audit.QUERIES, **contract.archive.QUERIES}
    assert set(own) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    same, rows = compare(spark, SF_DIR, name)
    assert same and rows > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 7
