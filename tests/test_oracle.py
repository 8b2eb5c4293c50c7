"""Registered queries against their SQL on the smallest test tables, and the shape of key plans."""
import os
import re

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect
from quarterline.oracle.finals import oracle_sql
from quarterline.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# the quick ones; oracle_check.py runs all of them
NAMES = [
    "quarter_labels", "snap_quarters", "ticker_norm_dedup", "company_first_name", "facts_dedup_earliest",
    "eps_q4_derived", "eps_collisions", "shares_quarterly", "split_factor_after", "split_factor_between",
    "price_quarterly", "dividends_as_paid", "corrupt_tickers", "stock_risk_quarter", "shares_price_basis",
    "quarterly_fundamentals", "value_panel", "backtest_series_annual", "load_ledger_latest",
    "dq_glitch_dividends",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, con, name):
    assert compare(con, entry.oracle_sql()[name], entry.queries()[name](spark, SF)) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_sql()) <= set(entry.queries())


def plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[:3] == ["ticker_yahoo", "quarter", "price_date"]


@pytest.mark.parametrize("name, exchanges", [("stock_risk_quarter", 3), ("price_quarterly", None), ("eps_quarterly", None)])
def test_plan_shape(spark, name, exchanges):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    if exchanges is not None:
        # the benchmark's days, one row per ticker and day, and the ticker
        assert len(re.findall(r"Exchange hashpartitioning", p)) == exchanges
