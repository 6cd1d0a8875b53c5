"""Every driver query against its DuckDB oracle (rows, column names, values) on sf0.001."""

import os

import pytest

import __spark_entry__ as E
from harness import compare, duck
from ledgerline.plans.driver_queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert name in ORACLE, f"{name} has no oracle"
    r = compare(df, ORACLE[name], con)
    assert r["ok"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["SalesDepartment", "UserName", "PeriodID", "ProductCategory", "AccountingPaymentType",
                          "FinalQty", "SalesAmt"]
