"""Shipment fact for client analysis."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import volume_waterfall
from ..functions.text import clean_upper, joined, or_na, part
from ..operators.grouping import attach_totals


def rls_link(*users: str):
    """'doc|oper|sales' key that row filters look up; unknown users count as NA."""
    parts = []
    for u in users:
        parts += [F.lit("|"), or_na(clean_upper(u))]
    return joined(*parts[1:])


def client_shipments(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per shipment with an operational date (x contact matches)."""
    s = tables["shipments_fact"].where(F.col("operational_date").isNotNull())
    x = tables["contacts"].select(F.col("id").alias("__contact"), "account_manager_name")
    rows = s.join(x, F.col("crm_contact_id") == F.col("__contact"), "left").withColumns(
        {
            "_client_name": clean_upper("crm_client"),
            "__year": F.year("operational_date"),
            "_origin": or_na("origin"),
            "_destination": or_na("destination"),
        }
    )
    rows = attach_totals(rows, ["_client_name", "__year"], {"_yearly_shipments": F.count("id")})
    volumes = volume_waterfall()
    return rows.select(
        F.col("serial_no").alias("_shipment_serial"),
        F.col("operational_date").cast("date").alias("_oper_date"),
        F.upper(part("service", "_", 1)).alias("_service_type"),
        F.upper(part("service", "_", 2)).alias("_service_direction"),
        "_origin",
        "_destination",
        joined("_origin", F.lit("-"), "_destination").alias("_trade_lane"),
        or_na(F.upper("line_of_business")).alias("_line_of_business"),
        or_na(F.upper("shipment_type")).alias("_shipment_type"),
        F.col("iss_domain").alias("_iss_domain"),
        F.upper("area_name").alias("_area"),
        "_client_name",
        clean_upper(or_na("account_manager_name")).alias("_acc_manager"),
        F.upper(part("financial_status", "_", 2)).alias("_fin_status"),
        F.upper(part("operational_status", "_", 2)).alias("_oper_status"),
        F.upper("sales_user").alias("_sales_person"),
        or_na(clean_upper("documentation_user")).alias("_doc_user"),
        or_na(clean_upper("operations_user")).alias("_oper_user"),
        rls_link("documentation_user", "operations_user", "sales_user").alias("_doc_oper_sales_user_rls_link"),
        F.col("expected_revenue_usd").alias("_expected_revenue_usd"),
        F.col("expected_profit_usd").alias("_expected_profit_usd"),
        F.col("expected_revenue_local").alias("_expected_revenue_local"),
        F.col("expected_profit_local").alias("_expected_profit_local"),
        F.col("dax_revenue_local").alias("_actual_revenue_local"),
        F.col("dax_gp_local").alias("_actual_profit_local"),
        F.col("dax_revenue_usd").alias("_actual_revenue_usd"),
        F.col("dax_gp_usd").alias("_actual_profit_usd"),
        F.coalesce("teu_fcl", "cbm_lcl").alias("_volume"),
        "_yearly_shipments",
        F.when(F.col("teu_fcl").isNotNull(), "TEU").when(F.col("cbm_lcl").isNotNull(), "CBM").alias("_unit"),
        *[c.alias(name) for name, c in volumes.items()],
    )
