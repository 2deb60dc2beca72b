"""Queries against their SQL. Some by default; all of them with BAZAAR_ALL_QUERIES=1 (or tests/compare.py)."""

import os

import pytest
from compare import compare, database

import __spark_entry__ as entry
from bazaar.oracle import statements
from bazaar.queries import queries

SF_DIR = os.environ.get("BAZAAR_SF_DIR", "/root/testdata/sf0.001")
QUICK = [
    "slice_half_open", "parse_mixed_ts", "parse_price", "dedup_latest", "asof_fx", "asof_fx_large", "dim_customer_scd2",
    "scd2_interval_join", "reject_reasons", "quarantine_order_lines", "status_reconciliation", "report_monthly_revenue",
    "report_funnel", "report_lead_time", "incremental_by_event", "replace_range", "src_customers_csv", "stream_events",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(statements()) == set(queries())
    assert set(queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", list(entry.oracle_sql()) if os.environ.get("BAZAAR_ALL_QUERIES") else QUICK)
def test_query_equals_sql(spark, db, key):
    assert compare(spark, db, key, entry.queries()[key], entry.oracle_sql()[key], SF_DIR) == ""
