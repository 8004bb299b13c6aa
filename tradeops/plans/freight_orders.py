"""Freight orders: one row each, plus order lines with quantity left."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import AsOf, as_of_date, days_between
from ..functions.rules import open_line_status, placement_score
from ..functions.text import surrogate_key
from ..operators.freight import distinct_links, inner_quantity_text
from ..operators.orders import collapse_by_primary, shipped_quantity
from ..sources.staging import staged
from .tracking import (
    CHARGE_FX_DATE,
    CUSTOMS_FX_DATE,
    FREIGHT_ORDERS,
    LINE_LEVEL,
    order_columns,
    unit_domains,
    unit_facts,
    with_scores,
)

# Published columns, in order.
COLUMNS = """
_fo_id _shipment_serial_iss_job _response_shipment_id _inbound_iss_job_no _outbound_iss_job_no _branch_bu _fe_id
_pid _po_qty_ordered _remaining_quantity _supplier_code _supplier_name _po_no_ekporef _item_code _secondary_po
_po_remarks _commodity _iss_ref _mode _client_id _client _routed_by _incoterms _incoterms_fo _hbl_hawb _mbl_mawb
_container_no _origin_port_pol _origin_port_name _origin_country _origin_region_org_reg
_destination_port_code_dest _destination_port_name_dest _destination_country_code_dest _destination_country_dest
_destination_region_reg _eqpt_type _20_ft _40_ft _count_of_cont _teus _carrier _arrival_date _departure_date
_pr_appr_date _po_app_date _po_creation_date _po_recd_date _po_need_by_date _crd _est_cargo_ready_date
_goods_cleared_origin _goods_cleared_destination _pickup_date _cargo_ho _etd _revised_etd _etd_wakeo _full_etd
_eta _revised_eta _eta_wakeo _full_eta _pod_date _do_date _do_exp _del _pr_number _pr_date _req_status _spo_number
_po_status _spo_invoice_val_aed _invoice_no _invoice_issue_date _billing_status _grn_no _grn_status _addl_po
_addl_issued_invoices _addl_invoice_issue_date _addl_po_grn _days_delayed_eta _days_delayed_etd _rdd_eta
_nbd_2_crd _po_2_crd _crd_2_etd _etd_2_eta _eta_2_del _nbd_2_eta _nbd_2_del _avg_lt _customs_invoice_aed
_customs_invoice_usd _days_order_placement_lt _days_supplier_production_lt _days_custom_clearance_lt
_days_iss_cont_booking_lt _days_transit_lt _e2e_total_lt _actual_lead _status _delivery_location _inner_qty _cbm
_gross_weight _chargeable_weight _quantity _pack_type _ship_remarks_updates _ship_billing_remarks _pre_alert _dn
_ontime_order_placement_perf _iss_cont_booking_perf _supplier_committed_prod_rdy_perf _iss_transit_lead_time_perf
_iss_custom_clear_perf _e2e_total_lead_time_perf _days_total_comm_perf _health_check _reason_code _aux_charge_type
_org_charges_aed _dest_charges_aed _frt_charges_aed _aux_charges_aed _p2p_value_aed _total_charges_aed
_org_charges_usd _dest_charges_usd _frt_charges_usd _aux_charges_usd _p2p_value_usd _total_charges_usd
_aux_charge_form_no _supplier_lead_time _country_lead_time _row_type
""".split()

# Taken from the order line promised first.
FROM_PRIMARY = """
_shipment_serial_iss_job _response_shipment_id _inbound_iss_job_no _outbound_iss_job_no _supplier_code
_supplier_name _incoterms _po_need_by_date _crd _etd _revised_etd _etd_wakeo _full_etd _eta _revised_eta
_eta_wakeo _full_eta _crd_2_etd _etd_2_eta _eta_2_del _nbd_2_eta _nbd_2_del _supplier_committed_prod_rdy_perf
_supplier_lead_time _country_lead_time
""".split()
TEXTS = ["_po_remarks", "_commodity"]
# Filled elsewhere: keys, list texts, constants and values computed after the reduction.
_NOT_MAXIMA = {"_fo_id", "_po_qty_ordered", "_remaining_quantity", "_po_no_ekporef", "_item_code", "_secondary_po",
               "_avg_lt", "_row_type", *FROM_PRIMARY, *TEXTS}
LARGEST = [c for c in COLUMNS if c not in _NOT_MAXIMA]


# Published per unit; their maxima are taken over the unit's rows, not its lines.
UNIT_LEVEL = """
_iss_ref _mode _routed_by _incoterms_fo _hbl_hawb _mbl_mawb _container_no _origin_port_pol _origin_port_name
_origin_country _origin_region_org_reg _destination_port_code_dest _destination_port_name_dest
_destination_country_code_dest _destination_country_dest _destination_region_reg _eqpt_type _20_ft _40_ft
_count_of_cont _teus _carrier _arrival_date _departure_date _est_cargo_ready_date _goods_cleared_origin
_goods_cleared_destination _pickup_date _cargo_ho _pod_date _do_date _do_exp _del _pr_number _pr_date _req_status
_spo_number _po_status _spo_invoice_val_aed _invoice_no _invoice_issue_date _billing_status _grn_no _grn_status
_addl_po _addl_issued_invoices _addl_invoice_issue_date _addl_po_grn _customs_invoice_aed _customs_invoice_usd
_delivery_location _inner_qty _cbm _gross_weight _chargeable_weight _quantity _pack_type _ship_remarks_updates
_ship_billing_remarks _pre_alert _dn _aux_charge_type _org_charges_aed _dest_charges_aed _frt_charges_aed
_aux_charges_aed _p2p_value_aed _total_charges_aed _org_charges_usd _dest_charges_usd _frt_charges_usd
_aux_charges_usd _p2p_value_usd _total_charges_usd _aux_charge_form_no
""".split()


def freight_units(tables: Mapping[str, DataFrame], fx_date: dt.date, customs_date: dt.date) -> DataFrame:
    """Facts of every live unit that carries order lines."""
    links = tables["purchase_order_on_freight_unit"]
    lines = tables["purchase_order_line"].select(F.col("id").alias("__line"))
    live = tables["freight_unit"].where(F.col("deleted_at").isNull()).select(
        F.col("id").alias("__fo"), "unit_no", F.col("serial_no").alias("_iss_ref"),
        F.col("shipment_serial_no").alias("__unit_serial"),
    )
    used = links.join(lines, F.col("purchase_order_id") == F.col("__line"), "left_semi")
    pairs = unit_domains(used, tables["purchase_order_company"]).join(live, F.col("__unit") == F.col("__fo"))
    df = unit_facts(tables, pairs, FREIGHT_ORDERS, fx_date, customs_date)
    return df.withColumns(
        {
            "_fo_id": F.md5(F.coalesce(F.col("__fo").cast("string"), F.lit("NA"))),
            "_est_cargo_ready_date": F.col("_crd_estimated"),
            "_invoice_issue_date": F.col("_issue_date"),
            "_addl_invoice_issue_date": F.col("_addl_issue_date"),
            "_gross_weight": F.col("_gw"),
            "_chargeable_weight": F.col("_chw"),
            "_quantity": F.col("_qnty"),
            # These three stay text here.
            "_pod_date": F.col("__pod_text"),
            "_do_date": F.col("__do_text"),
            "_do_exp": F.col("__exp_text"),
            "_eqpt_type": F.replace("_eqpt_type", F.lit('"'), F.lit("")),
            "_spo_invoice_val_aed": F.col("_p2p_value_aed"),
        }
    )


def shipped_lines(tables: Mapping[str, DataFrame], units: DataFrame, as_of) -> DataFrame:
    """One row per order line and freight unit with its lead times, state and scores."""
    lines = tables["purchase_order_line"].select(
        F.col("id").alias("_pid"), *[c.alias(name) for name, c in order_columns().items()]
    )
    companies = tables["purchase_order_company"].select(
        F.col("id").alias("_client_id"), F.col("company_name").alias("_client"), F.col("iss_domain").alias("__dom")
    )
    suppliers = tables["supplier_lead_time"].select(
        F.col("supplier_id").alias("__supplier"), F.col("avg_lead_time").alias("_supplier_lead_time")
    )
    facts = units.select("__unit", "__domain", "_fo_id", *LINE_LEVEL)
    df = (
        distinct_links(tables["purchase_order_on_freight_unit"])
        .join(lines, F.col("purchase_order_id") == F.col("_pid"))
        .join(companies, F.col("purchase_order_company_id") == F.col("_client_id"))
        .join(suppliers, F.col("_supplier_code") == F.col("__supplier"), "left")
        .join(facts, (F.col("freight_unit_id") == F.col("__unit")) & F.col("__dom").eqNullSafe(F.col("__domain")))
    )
    return with_scores(df, FREIGHT_ORDERS, as_of)


def freight_orders(shipped: DataFrame, units: DataFrame, inner: DataFrame, stage=staged) -> DataFrame:
    """Collapse to one row per freight order, led by the line promised first.

    Lines are reduced on narrow rows, which are staged, by the unit's number; what belongs to a unit, the published maxima and
    the quantity text (``inner``: __fu, _inner_qty), meets the reduced rows where they lie, so that these never move.
    """
    per_line = [c for c in LARGEST if c not in UNIT_LEVEL]
    order = ["_po_need_by_date", "_pid", "_client_id", "_fe_id", "_shipment_serial_iss_job"]
    used = dict.fromkeys(["__unit", "_po_no_ekporef", *order, *FROM_PRIMARY, *per_line, *TEXTS])
    led = stage(shipped.select(*used), "shipped-lines").withColumn("__po", F.col("_po_no_ekporef"))
    published = units.groupBy(F.struct("__unit").alias("__key")).agg(*[F.max(c).alias(c) for c in ["_fo_id", *UNIT_LEVEL] if c != "_inner_qty"])
    out = collapse_by_primary(
        led, "__unit", "__po", order=order, from_primary=[*FROM_PRIMARY, "_po_no_ekporef"],
        largest={c: F.max(c) for c in per_line}, texts=TEXTS, others="_secondary_po",
        about=[published, inner.select(F.struct(F.col("__fu").alias("__unit")).alias("__key"), "_inner_qty")],
    )
    gaps = F.col("_crd_2_etd") + F.col("_etd_2_eta") + F.col("_eta_2_del") + F.col("_nbd_2_eta") + F.col("_nbd_2_del")
    return out.withColumns({"_avg_lt": gaps, "_row_type": F.lit("main")})


def open_lines(tables: Mapping[str, DataFrame], as_of) -> DataFrame:
    """Order lines with quantity left to ship.

    Quirk kept: suppliers are looked up by name although nothing of them is
    published, so a name listed twice doubles its lines.
    """
    lines = tables["purchase_order_line"]
    companies = tables["purchase_order_company"].select(F.col("id").alias("_client_id"), F.col("company_name").alias("_client"))
    names = tables["supplier_lead_time"].select(F.upper("supplier_name").alias("__name"))
    used = shipped_quantity(tables["purchase_order_on_freight_unit"])
    ordered = F.coalesce(F.col("po_qty_ordered").try_cast("double"), F.lit(0.0))
    df = (
        lines.join(used, F.col("id") == F.col("__line"), "left")
        .join(companies, F.col("purchase_order_company_id") == F.col("_client_id"))
        .withColumns(
            {
                "_po_qty_ordered": ordered,
                "_remaining_quantity": ordered - F.coalesce(F.col("__shipped").cast("double"), F.lit(0.0)),
            }
        )
        .where(F.col("_remaining_quantity") > 0)
        .join(names, F.upper("supplier_name") == F.col("__name"), "left")
    )
    df = df.withColumns({"_pid": F.col("id"), **order_columns()})
    return df.select(
        surrogate_key("_po_no_ekporef", "_commodity", "_po_need_by_date", "_pid").alias("_fo_id"),
        "_branch_bu", "_pid", "_po_qty_ordered", "_remaining_quantity", "_supplier_code", "_supplier_name",
        "_po_no_ekporef", "_item_code", "_po_remarks", "_commodity", "_client_id", "_client", "_incoterms",
        "_pr_appr_date", "_po_app_date", "_po_creation_date", "_po_recd_date", "_po_need_by_date",
        days_between("_po_app_date", "_pr_appr_date").alias("_days_order_placement_lt"),
        open_line_status("status", "_po_need_by_date", as_of).alias("_status"),
        placement_score("_pr_appr_date", "_po_app_date", whole=True).alias("_ontime_order_placement_perf"),
        F.lit(0.0).alias("_supplier_committed_prod_rdy_perf"),
        F.lit("remaining").alias("_row_type"),
    )


def freight_order_view(
    tables: Mapping[str, DataFrame], as_of: AsOf = None, fx_date: dt.date = CHARGE_FX_DATE,
    customs_date: dt.date = CUSTOMS_FX_DATE, stage=staged,
) -> DataFrame:
    """Freight orders (row type 'main') and open order lines ('remaining').

    Unit facts feed the line-level rules and the published maxima, so they are
    staged once. Quantity texts and the freight orders are staged, too: what has been shuffled for them is gone before the rest runs.
    """
    today = as_of_date(as_of)
    units = stage(freight_units(tables, fx_date, customs_date), "freight-units")
    inner = stage(inner_quantity_text(tables["purchase_order_on_freight_unit"], tables["purchase_order_line"]), "quantities")
    main = stage(freight_orders(shipped_lines(tables, units, today), units, inner, stage), "freight-orders")
    left = open_lines(tables, today)
    return main.unionByName(left, allowMissingColumns=True).select(*COLUMNS)
