"""The driver contract, and every query beside DuckDB at the smallest scale."""

import pytest

import __spark_entry__ as entry_module
from compare import compare, connect
from meterloom.plans.oracle import ORACLE
from meterloom.plans.queries import COVERS, QUERIES

SF = "/root/testdata/sf0.001"


def test_contract(spark):
    assert set(QUERIES) == set(ORACLE) == set(COVERS) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), entry_module.queries()[name], entry_module.oracle_sql()[name], SF) == ""
