"""Steps shared by the freight-order and order-line reports.

Most of what the reports publish belongs to a freight unit, not to an order
line: payload, plan, places, carrier, charges. These are assembled once per unit
and ordering company's domain (`unit_facts`), staged, and joined to the far more
numerous order lines only where needed, so line-level rows stay narrow.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import plus_days
from ..functions.payload import (
    container_counts,
    equipment_items,
    equipment_text,
    listed,
    listed_distinct,
    named_value,
    CUSTOM_DATES,
    parse_payload,
    payload_or_plan,
    with_payload_dates,
)
from ..functions.rules import (
    actual_lead,
    committed_lead,
    delay_metrics,
    doc_flag,
    health_check,
    lead_times,
    need_by_metrics,
    perf_scores,
    placement_score,
    present,
    reason_code,
    shipment_status,
)
from ..functions.text import surely_matches
from ..operators.freight import (
    carrier_lookup,
    destination_place,
    labelled_documents,
    origin_place,
    plan_serials,
    places,
    resolve_payload,
    transit_master,
)
from ..operators.grouping import fanout_left_join
from ..operators.money import CHARGE_FX_DATE, CUSTOMS_FX_DATE, charge_pivot, customs_values
from ..sources.staging import staged

DELIVERY_NOTE = "AGI"  # fixed value: attachment label


@dataclass(frozen=True)
class Variant:
    """Where the two reports differ by design or by kept quirk."""

    whole_ratios: bool  # integer division in scores
    inverted_total: bool  # end-to-end score is one minus the deviation
    null_policy: str  # missing master lead times
    container_separator: str
    need_by_eta: str  # arrival compared with the need-by date ...
    need_by_if: str  # ... where this date is known
    terms_follow: str  # serial that decides between payload and planned terms
    plan_country: bool  # planned origin stands in for the country lead time


FREIGHT_ORDERS = Variant(True, False, "propagate", "|", "_revised_eta", "_revised_etd", "__unit_serial", False)
PO_LINES = Variant(False, True, "zero", " | ", "_full_eta", "_full_eta", "_shipment_serial_iss_job", True)


def order_columns() -> dict:
    """Published names of the order line's own columns."""
    return {
        "_branch_bu": F.col("ship_to_location"),
        "_supplier_code": F.col("supplier_no"),
        "_supplier_name": F.col("supplier_name"),
        "_po_no_ekporef": F.col("po_no"),
        "_po_remarks": F.col("po_remarks"),
        "_commodity": F.col("po_desc"),
        "_item_code": F.col("item_code"),
        "_incoterms": F.col("inco_term_po"),
        "_pr_appr_date": F.col("req_app_dt"),
        "_po_app_date": F.col("po_app_dt"),
        "_po_creation_date": F.col("po_date"),
        "_po_recd_date": plus_days("po_app_dt", 2),
        "_po_need_by_date": F.col("current_po_promised_dt"),
    }


PAYLOAD_KEYS = (
    "service", "shipping_terms", "carrier", "operational_status",
    "origin_port", "destination_port", "origin_country", "destination_country",
)

# Unit columns the line-level rules read; the rest is only published.
LINE_LEVEL = """
_shipment_serial_iss_job _response_shipment_id _inbound_iss_job_no _outbound_iss_job_no _fe_id _ship_focus_status
_eta _revised_eta _full_eta _eta_simple _eta_wakeo _etd _revised_etd _full_etd _etd_simple _etd_wakeo _pta _ptd _crd
_del _departure_date _departure_date_actual _arrival_date _arrival_date_actual _goods_cleared_destination
_origin_country _country_lead_time __void
""".split()


# What the lights and expected deliveries read of a unit: dates of its payload alone.
LIGHT_LEVEL = """
_eta _eta_simple _eta_wakeo _etd _etd_wakeo _pta _ptd _crd _del _departure_date _departure_date_actual
_arrival_date _arrival_date_actual _goods_cleared_destination
""".split()


def unit_domains(links: DataFrame, companies: DataFrame) -> DataFrame:
    """The (freight unit, ordering domain) pairs that occur on order lines."""
    c = companies.select(F.col("id").alias("__company"), F.col("iss_domain").alias("__domain"))
    return (
        links.select("freight_unit_id", "purchase_order_company_id")
        .distinct()
        .join(c, F.col("purchase_order_company_id") == F.col("__company"))
        .select(F.col("freight_unit_id").alias("__unit"), "__domain")
        .distinct()
    )


def read_payload(df: DataFrame, variant: Variant) -> DataFrame:
    """Replace a payload text by published columns."""
    df = with_payload_dates(df.withColumn("_p", parse_payload("_payload")).drop("_payload"))
    df = df.withColumn("__items", equipment_items("_p.equipment"))
    return df.withColumns(
        {
            "_shipment_serial_iss_job": F.col("_p.serial_no"),
            "_response_shipment_id": F.col("_p.id"),
            "_hbl_hawb": F.col("_p.house_no"),
            "_mbl_mawb": F.col("_p.master_no"),
            "_container_no": listed("_p.equipment_details", "equipment_no", variant.container_separator),
            "_pack_type": listed_distinct("_p.cargo", "package_type", ", "),
            "_eqpt_type": equipment_text("__items"),
            **container_counts("__items"),
            "_cargo_ho": F.col("_pickup_date"),
            "_spo_number": F.col("_p.master_spo_no"),
            "_cbm": F.col("_p.gross_volume"),
            "_gw": F.col("_p.gross_weight"),
            "_chw": F.col("_p.chargeable_weight"),
            "_qnty": F.col("_p.package_count"),
            "__pod_text": named_value("_p.custom_dates", CUSTOM_DATES["_pod_date"]),
            "__do_text": named_value("_p.custom_dates", CUSTOM_DATES["_do_date"]),
            "__exp_text": named_value("_p.custom_dates", CUSTOM_DATES["_do_exp"]),
            **{f"__{f}": F.col(f"_p.{f}") for f in PAYLOAD_KEYS},
        }
    ).drop("_p", "__items")


def with_payload(pairs: DataFrame, tables: Mapping[str, DataFrame], variant: Variant) -> DataFrame:
    """Give each unit the published columns of its payload. Texts are read where they lie: their columns, not they, are joined."""
    df = resolve_payload(
        pairs, tables["freight_unit_enrich"], "unit_no", "__domain", domains=tables["purchase_order_company"].select("iss_domain"),
        read=lambda arms: read_payload(arms, variant),
    )
    # A unit without a payload has no containers.
    return df.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("_count_of_cont", "_teus")})


def with_plan(df: DataFrame, enrich: DataFrame, variant: Variant) -> DataFrame:
    """Join the unit's planning data; columns are prefixed ``fe_``."""
    plan = plan_serials(enrich)
    plan = plan.select(*[F.col(c).alias(f"fe_{c}") for c in plan.columns])
    df = df.join(plan, F.col("unit_no") == F.col("fe_unit_no"), "left")
    serial = "_shipment_serial_iss_job"
    return df.withColumns(
        {
            "_fe_id": F.col("fe_id"),
            "_incoterms_fo": payload_or_plan(variant.terms_follow, "__shipping_terms", "fe_shipping_terms"),
            "_mode": payload_or_plan(serial, "__service", "fe_service"),
            "_routed_by": F.col("fe_routed_by"),
            "_inbound_iss_job_no": F.col("fe___in"),
            "_outbound_iss_job_no": F.col("fe___out"),
            "_pr_number": F.col("fe_pr_number"),
            "_pr_date": F.col("fe_pr_date").cast("date"),
            "_req_status": present("fe_pr_number", "Logged", "Pending"),
            "_po_status": present("fe_spo_number", "Received", "Pending"),
            "_grn_no": F.col("fe_grn_no"),
            "_grn_status": present("fe_grn_no", "Complete", "Pending"),
            "_addl_po": F.col("fe_addl_po"),
            "_addl_po_grn": F.col("fe_addl_po_grn_number"),
            "_delivery_location": F.col("fe_delivery_location"),
            "_ship_remarks_updates": F.col("fe_shipment_remarks"),
            "_ship_billing_remarks": F.col("fe_billing_notes"),
            "_pre_alert": present("fe_pre_alert_sent_at", "Yes", "No"),
            "_aux_charge_form_no": F.col("fe_ancillary_charge_form_no"),
        }
    )


def with_places(df: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    dim = places(tables["ports"], tables["airports"], tables["port_codes"])
    df = origin_place(df, dim, "fe_service", "_shipment_serial_iss_job", "fe_origin_port", "__origin_port")
    return destination_place(
        df, dim, tables["country_codes"], "fe_service", "_shipment_serial_iss_job", "fe_shipment_serial_no",
        "fe_destination_port", "__destination_port", "fe_destination_country", "__destination_country",
    )


def shipment_facts(tables: Mapping[str, DataFrame], fx_date: dt.date, customs_date: dt.date) -> DataFrame:
    """Everything known per shipment: documents, customs value and charges.

    Assembled on the shipment side, so the wide order rows are joined to it once
    instead of once per source.
    """
    s = tables["shipments_ops"].select(F.col("id").alias("__ship"), F.col("serial_no").alias("__serial"))
    s = s.where(F.col("__serial").isNotNull())
    notes = labelled_documents(tables["attachments"], DELIVERY_NOTE, "__notes")
    customs = customs_values(tables["customs"], tables["customs_rates"], fx_date=customs_date)
    costs = charge_pivot(
        tables["shipments_ops"], tables["cost_revenue_items"], tables["charge_service_mapping"],
        tables["issued_invoices"], tables["snapshot_rates"], tables["domain_currency"], tables["freight_unit"], fx_date,
    ).drop("_ship_id")
    return (
        fanout_left_join(s, customs, [("__ship", "__customs_ship")])
        .join(notes, F.col("__ship") == F.col("__parent"), "left")
        .join(costs, F.col("__serial") == F.col("_ship_serial"), "left")
        .drop("__parent", "__customs_ship", "_ship_serial")
    )


def with_shipment_facts(df: DataFrame, facts: DataFrame) -> DataFrame:
    df = df.join(facts, F.col("_shipment_serial_iss_job") == F.col("__serial"), "left")
    stems = ("org", "dest", "frt", "aux")
    renamed = {f"_{s}_charges_local": f"_{s}_charges_aed" for s in stems}
    df = df.withColumnsRenamed(renamed)
    totals = {}
    for cur in ("aed", "usd"):
        p2p = F.col(f"_org_charges_{cur}") + F.col(f"_frt_charges_{cur}") + F.col(f"_dest_charges_{cur}")
        totals[f"_p2p_value_{cur}"] = p2p
        totals[f"_total_charges_{cur}"] = p2p + F.col(f"_aux_charges_{cur}")
    return df.withColumns(
        {
            **totals,
            "_dn": doc_flag("__ship", "__notes"),
            "_invoice_no": F.col("_issued_invoices"),
            "_billing_status": present("_issued_invoices", "Billed", "Pending"),
            "_customs_invoice_aed": F.col("_amount_aed"),
            "_customs_invoice_usd": F.col("_amount_usd"),
        }
    )


def with_carrier(df: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    return carrier_lookup(df, tables["carrier_shipping"], "__carrier")


def unit_dates(tables: Mapping[str, DataFrame], pairs: DataFrame) -> DataFrame:
    """`LIGHT_LEVEL` of each unit as seen from an ordering domain; no plan, place, carrier or charge is read."""

    def read(arms: DataFrame) -> DataFrame:
        dated = with_payload_dates(arms.withColumn("_p", parse_payload("_payload")))
        return dated.select("__arm_unit", "__arm_domain", *LIGHT_LEVEL)

    domains = tables["purchase_order_company"].select("iss_domain")
    df = resolve_payload(pairs, tables["freight_unit_enrich"], "unit_no", "__domain", domains=domains, read=read)
    return df.select("__unit", "__domain", "_fo_id", "_fo_serial", *LIGHT_LEVEL)


def unit_facts(
    tables: Mapping[str, DataFrame], pairs: DataFrame, variant: Variant, fx_date: dt.date, customs_date: dt.date
) -> DataFrame:
    """Everything about a unit as seen from an ordering domain, keyed `__unit`, `__domain`.

    A pair has one row, or several where the sources themselves do (both sides
    of a shipment match, or a lookup lists a key twice). Facts per shipment are staged: they are far narrower than what is
    shuffled for them, and that is gone before the units are put together.
    """
    df = with_payload(pairs, tables, variant)
    df = with_plan(df, tables["freight_unit_enrich"], variant)
    df = with_shipment_facts(df, staged(shipment_facts(tables, fx_date, customs_date), "shipment-facts"))
    df = with_carrier(df, tables)
    df = with_places(df, tables)
    planned = F.col("fe_origin_country") if variant.plan_country else F.lit(None).cast("string")
    df = df.withColumns(
        {
            "__from_country": F.coalesce(F.col("__origin_country"), planned),
            # Neither delivered nor routed, or called off: no lead time is committed.
            "__void": F.col("_del").isNull()
            | F.col("__origin_country").isNull()
            | surely_matches("__operational_status", "cancel"),
        }
    )
    return df.join(
        transit_master(tables["country_transit_time"]), F.col("__from_country") == F.col("__country"), "left"
    ).drop("__country")


def with_scores(df: DataFrame, variant: Variant, as_of) -> DataFrame:
    """Lead times, committed lead, health, state, scores and reason.

    Needs the line's dates, the `LINE_LEVEL` unit columns and
    `_supplier_lead_time`.
    """
    df = delay_metrics(lead_times(df))
    df = df.withColumns(
        {
            "_ontime_order_placement_perf": placement_score("_pr_appr_date", "_po_app_date", variant.whole_ratios),
            "_days_total_comm_perf": committed_lead(
                "_supplier_lead_time", "_country_lead_time", F.col("__void"), variant.null_policy
            ),
            "_actual_lead": actual_lead(),
        }
    )
    df = df.withColumn("__overrun", F.col("_actual_lead") - F.col("_days_total_comm_perf"))
    needs = ["_supplier_lead_time", "_del", "_full_eta", "_full_etd", "_pr_appr_date"]
    df = df.withColumns({"_health_check": health_check(needs, "__overrun"), "_status": shipment_status(as_of)})
    df = perf_scores(df, variant.whole_ratios, variant.inverted_total)
    df = need_by_metrics(df, variant.need_by_eta, variant.need_by_if)
    return df.withColumn("_reason_code", reason_code())


__all__ = [
    "CHARGE_FX_DATE", "CUSTOMS_FX_DATE", "FREIGHT_ORDERS", "LIGHT_LEVEL", "LINE_LEVEL", "PO_LINES", "Variant",
    "order_columns", "unit_dates", "unit_domains", "unit_facts", "with_scores",
]
