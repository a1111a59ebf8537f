"""Registered queries against their SQL on the smallest scale; the slow ones are left to tools/compare.py."""

import os

import pytest

import __spark_entry__ as entry
from hemline.plans.oracles import ORACLES
from hemline.plans.queries import QUERIES
from tools.compare import compare, connection

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NO_SQL = {"tweedie_forecast", "tree_forecast", "parameter_search"}
QUICK = [
    "calendar_parts",
    "week_to_date",
    "silver_sales",
    "sales_conserved",
    "silver_price",
    "customer_stats_join",
    "gold_features",
    "gold_restock",
    "gold_inventory",
    "inventory_balance",
    "inventory_balance_iso",
    "exog_lags",
    "lag_join",
    "error_by_store",
    "error_by_dimension",
    "conformal_by_store",
    "drift_table",
    "stability_suite",
    "image_headers",
    "image_faults",
    "verified_images",
    "stream_ingest_clothes",
    "stream_fields",
    "drift_small",
    "reorder_budget",
    "reduction_checks",
    "stream_ingest_customer",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no warehouse tables")


def test_every_query_has_sql_or_is_listed():
    assert set(QUERIES) - set(ORACLES) == NO_SQL
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).columns[-1] == "accumulated_inventory"


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_sql(spark, name):
    ok, note = compare(spark, connection(SF_DIR), SF_DIR, name)
    assert ok, note
