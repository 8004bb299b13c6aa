"""Gross-profit contribution by client, seller and account manager."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import late_trim_key, name_key
from ..operators.daygrain import as_of_join, dormancy, previous_day, trailing_max
from ..operators.money import fx_to_usd
from ..operators.ranking import dense_ids
from ..sources.staging import staged

SINCE = dt.date(2023, 1, 1)  # fixed value
# Revenue and cost accounts.
GP_ACCOUNTS = (
    30000, 30001, 30002, 30003, 30004, 30008, 30014, 30017, 31003,
    40000, 40001, 40002, 40003, 40004, 40007, 41003, 41007, 41009,
)
GAP_MONTHS, TRAILING_MONTHS = 8, 12  # fixed values


def sales_ids(tables: Mapping[str, DataFrame]) -> DataFrame:
    budget = tables["budget_sales"].select(name_key("sales_user").alias("__seller"))
    return dense_ids(budget, "__seller", "__seller_id")


def attributed_shipments(facts: DataFrame) -> DataFrame:
    """Shipments with people's keys and the previous date of client and manager."""
    rows = facts.select(
        F.col("id").alias("__shipment"),
        F.col("serial_no").alias("__serial"),
        F.col("crm_client").alias("_client"),
        F.col("crm_contact_id").alias("_client_id"),
        F.col("operational_date").cast("date").alias("_oper_date"),
        name_key("sales_user").alias("_sales_user"),
        name_key("operations_user").alias("_oper_user"),
        name_key("documentation_user").alias("_doc_user"),
        name_key("account_manager").alias("_acc_manager_shipment"),
    )
    rows = previous_day(rows, ["_client", "_acc_manager_shipment"], "_oper_date", "__shipment", "_prev_ship_date")
    return rows.withColumns(dormancy(rows, "_prev_ship_date", "_oper_date", GAP_MONTHS))


def gp_contribution(
    tables: Mapping[str, DataFrame], since: dt.date = SINCE, accounts: tuple[int, ...] = GP_ACCOUNTS, stage=staged
) -> DataFrame:
    """One row per ledger entry (x shipment and rate matches) of budgeted people.

    The attributed rows feed both the trailing window and the output, so they
    are staged once. Quirks kept: the manager id follows the shipment's manager,
    not the one valid at the ledger date, and the gap is counted per shipment
    manager while the trailing window runs per valid manager.
    """
    ledger = tables["journal"].where((F.col("accountingdate") >= F.lit(since)) & F.col("mainaccount").isin(*accounts))
    rows = fx_to_usd(ledger, tables["fx_daily"])
    shipments = attributed_shipments(tables["shipments_fact"])
    rows = rows.join(shipments, F.col("jobmaster") == F.col("__serial"), "left")
    rows = as_of_join(
        rows, tables["account_manager_changes"], "_client_id", "accountingdate", "contact_id", "changed_at",
        "new_account_manager",
    )
    manager = F.coalesce("new_account_manager", "_acc_manager_shipment")
    rows = rows.withColumns({"_acc_manager": name_key(manager), "__manager_test": late_trim_key(manager)})

    ids = sales_ids(tables)
    sellers = ids.select(F.col("__seller").alias("__s1"), F.col("__seller_id").alias("_sales_user_id"))
    managers = ids.select(F.col("__seller").alias("__s2"), F.col("__seller_id").alias("_acc_manager_id"))
    budgeted = ids.select(F.col("__seller").alias("__s3"))
    rows = (
        rows.join(sellers, F.col("_sales_user") == F.col("__s1"), "left")
        .join(managers, F.col("_acc_manager_shipment") == F.col("__s2"), "left")
        .join(budgeted, F.col("__manager_test") == F.col("__s3"), "left")
        .where(F.col("_sales_user_id").isNotNull() | F.col("__s3").isNotNull())
    )
    rows = rows.select(
        F.col("accountingdate").cast("date").alias("_acc_date"),
        F.col("jobmaster").alias("_ship_serial"),
        "_oper_date", "_client", "_client_id", "_amount_usd", "_amount",
        F.upper("name").alias("_oper_type"),
        "_sales_user", "_sales_user_id", "_oper_user", "_doc_user", "_acc_manager", "_acc_manager_shipment",
        "_acc_manager_id", "_prev_ship_date", "_prev_ship_diff_days", "_prev_ship_diff_mon",
        F.coalesce("_dormacy_break_trigger", F.lit(0)).alias("_dormacy_break_trigger"),
    )
    return trailing_max(
        stage(rows, "gross-profit"), ["_client", "_acc_manager"], "_oper_date", "_dormacy_break_trigger",
        TRAILING_MONTHS, "_regained",
    )
