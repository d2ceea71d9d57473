"""Queries over every event, beside DuckDB, and that they leave no event out."""

import pytest

import __spark_entry__ as entry_module
from compare import compare, connect

SF = "/root/testdata/sf0.001"
NAMES = ["time_expressions_of_all", "payloads_of_all_dated", "spend_per_interval_of_all", "totals_5m_of_all_scans"]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), entry_module.queries()[name], entry_module.oracle_sql()[name], SF) == ""


@pytest.mark.parametrize("name", NAMES[:3])
def test_every_event_has_a_row(spark, name):
    assert entry_module.queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/events.parquet").count()
