import pytest

import __spark_entry__ as contract
from logmill.suite.oracles import ORACLES
from logmill.suite.queries import QUERIES
from verify import compare, connect

SF = "/root/testdata/sf0.001"
SAMPLE = ["normalize_documents", "merge_anchored", "merge_aggregate_rows", "handling_summary", "storm_summary", "retention_by_table"]


def test_every_log_query_has_reference_sql():
    assert set(ORACLES) == set(QUERIES)
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, connect(SF), name, SF).startswith("ok")
