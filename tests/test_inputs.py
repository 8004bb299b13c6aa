"""The derived input tables grow with the test tables, and their ids hold at any size."""

from __future__ import annotations

import pytest

from tradeops.workload import compare
from tradeops.workload.base import twin_sql
from tradeops.workload.derived import _LINE_ID, DERIVED

SMALL, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
# Dimensions of regions, nations and days, which have their size at any scale.
FIXED = {
    "budget_sales", "crm_users", "sales_global_entitlement", "login_local_entitlement", "domain_catalog", "branch_domain",
    "global_entitlement", "office_entitlement", "domain_currency", "snapshot_rates", "charge_service_mapping", "customs_rates",
    "organization", "purchase_order_company", "ports", "airports", "port_codes", "country_codes", "country_transit_time",
    "carrier_shipping", "fx_daily",
}


@pytest.mark.parametrize("name", sorted(set(DERIVED) - FIXED))
def test_tables_grow(name):
    counts = [compare.duck(d).execute(twin_sql(f"select count(*) from @{name}")).fetchall()[0][0] for d in (SMALL, LARGE)]
    assert counts[1] > 3 * counts[0]


def test_users_and_companies_grow():
    counts = [
        compare.duck(d).execute(twin_sql("select count(distinct company_id) from @companies_on_users join @company on id = company_id")).fetchall()[0][0]
        for d in (SMALL, LARGE)
    ]
    assert counts[1] > 8 * counts[0]


def test_line_ids_are_unique():
    con = compare.duck(LARGE)
    assert con.execute(f"select count(*) - count(distinct id) from (select distinct l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, {_LINE_ID} as id from lineitem)").fetchall() == [(0,)]


def test_line_ids_fit_large_keys(spark):
    big = spark.sql("select 10000000000L as l_orderkey, 7 as l_linenumber, 2000000000L as l_partkey, 100000000L as l_suppkey, date '1998-12-31' as l_shipdate")
    assert big.selectExpr(f"{_LINE_ID} as id").first()["id"] > 10**18
