"""Service-level reports: transit by country, reaction by supplier."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import days_between, safe_day
from ..functions.payload import CUSTOM_DATES, named_value, parse_payload
from ..functions.rules import sla_breach
from ..functions.text import surrogate_key
from ..operators.freight import resolve_payload


def _companies(tables: Mapping[str, DataFrame]) -> DataFrame:
    return tables["purchase_order_company"].select(F.col("id").alias("__company"), F.col("iss_domain").alias("__dom"))


def _payload_fields(df: DataFrame) -> DataFrame:
    return df.withColumn("_p", parse_payload("_payload")).withColumns(
        {
            "_shipment_serial_iss_job": F.col("_p.serial_no"),
            "_origin_country_code": F.col("_p.origin_country"),
            "_crd_actual": safe_day(named_value("_p.custom_dates", CUSTOM_DATES["_crd_actual"])),
            "_delivery_date": safe_day("_p.delivery_date"),
        }
    )


def country_sla(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per delivered unit and payload; transit days against the country's average.

    Rows are made distinct before the two country lookups, and again after them
    in case a lookup lists a country twice.
    """
    links = tables["purchase_order_on_freight_unit"].select("freight_unit_id", "purchase_order_company_id").distinct()
    units = (
        tables["freight_unit"]
        .select(F.col("id").alias("__unit_id"), "unit_no", "serial_no")
        .join(links, F.col("__unit_id") == F.col("freight_unit_id"))
        .join(_companies(tables), F.col("purchase_order_company_id") == F.col("__company"))
    )
    rows = _payload_fields(resolve_payload(units, tables["freight_unit_enrich"], "unit_no", "__dom"))
    columns = ["serial_no", "_shipment_serial_iss_job", "_origin_country_code", "_crd_actual", "_delivery_date"]
    delivered = rows.where(F.col("_delivery_date").isNotNull()).select(*columns).distinct()
    names = tables["country_codes"].select(
        F.col("iso_2_char_code").alias("__iso"), F.col("iso_country_name").alias("_origin_country")
    ).distinct()
    master = tables["country_transit_time"].select(
        F.col("code").alias("__code"), F.col("average_transit_time").alias("_sla_country_lead_time")
    ).distinct()
    return (
        delivered.join(names, F.col("_origin_country_code") == F.col("__iso"), "left")
        .join(master, F.col("_origin_country_code") == F.col("__code"), "left")
        .select(*columns, "_origin_country", "_sla_country_lead_time")
        .withColumn("_actual_duration", days_between("_delivery_date", "_crd_actual"))
        .withColumn("_sla_status", sla_breach("_actual_duration", "_sla_country_lead_time"))
    )


def supplier_sla(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per order line and unit with a known cargo-ready date."""
    lines = tables["purchase_order_line"].select(
        F.col("id").alias("_po_id"),
        F.col("po_line_num").alias("_po_line_no"),
        F.col("po_no").alias("_po_no"),
        F.col("po_desc").alias("_item_description"),
        F.col("po_uom").alias("_po_uom"),
        F.col("item_code").alias("_item_code"),
        F.col("po_app_dt").cast("date").alias("_po_approval_date"),
        F.col("supplier_no").try_cast("int").alias("__supplier"),
    )
    lead = tables["supplier_lead_time"].select(
        F.col("supplier_id").try_cast("int").alias("__lead_supplier"), F.col("avg_lead_time").alias("_supplier_sla_lt")
    )
    links = tables["purchase_order_on_freight_unit"].select(
        "purchase_order_id", "freight_unit_id", "purchase_order_company_id"
    )
    units = tables["freight_unit"].select(F.col("id").alias("__unit_id"), "unit_no")
    rows = (
        links.join(lines, F.col("purchase_order_id") == F.col("_po_id"))
        .join(_companies(tables), F.col("purchase_order_company_id") == F.col("__company"))
        .join(units, F.col("freight_unit_id") == F.col("__unit_id"), "left")
        .join(lead, F.col("__supplier") == F.col("__lead_supplier"), "left")
    )
    rows = _payload_fields(resolve_payload(rows, tables["freight_unit_enrich"], "unit_no", "__dom"))
    return (
        rows.where(F.col("_crd_actual").isNotNull())
        .withColumns(
            {
                "_line_id": surrogate_key("_po_id", "_item_code", "_shipment_serial_iss_job"),
                "_supplier_reaction_time": days_between("_crd_actual", "_po_approval_date"),
                "_supplier_lead_time_sla": F.col("_supplier_sla_lt"),
            }
        )
        .withColumn("_reaction_time_var", F.col("_supplier_reaction_time") - F.col("_supplier_sla_lt"))
        .withColumn("_reaction_sla_status", sla_breach("_reaction_time_var", F.lit(0)))
        .select(
            "_po_id", "_line_id", "_po_line_no", "_po_no", "_item_description", "_po_uom", "_item_code",
            "_po_approval_date", "_crd_actual", "_supplier_sla_lt", "_shipment_serial_iss_job",
            "_supplier_reaction_time", "_supplier_lead_time_sla", "_reaction_time_var", "_reaction_sla_status",
        )
    )
