"""Order lines: one row per line and freight unit, plus a master row per line."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import AsOf, as_of_date, plus_days, safe_day
from ..functions.rules import (
    SHIPPED_UNIT_PIECES,
    STAGES,
    current_delivery,
    final_delivery,
    line_type,
    order_placement_days,
    pieces_of,
    placement_score,
    stage_lights,
    unit_pieces,
)
from ..functions.text import choose, surely_matches, surrogate_key, title_words
from ..operators.grouping import attach_totals
from ..operators.orders import balance_pieces, light_rollup, number_lines, shipped_quantity
from ..operators.ranking import numbers_by_group
from ..sources.staging import staged
from .tracking import (
    CHARGE_FX_DATE,
    CUSTOMS_FX_DATE,
    LIGHT_LEVEL,
    LINE_LEVEL,
    PO_LINES,
    order_columns,
    unit_dates,
    unit_domains,
    unit_facts,
    with_scores,
)

# Published columns, in order.
COLUMNS = """
_line_type _line_id _line_no _client_id _client_name _original_po_qty _po_outer_qty _shipped _qnty_shipped_remaning
_inner_qnty_shipped _balance_outer_qnty _balance_inner_qnty _freight_unit_id _fo_id _fo_serial _shipment_link
_branch_bu _supplier_code _supplier_name _po_no_ekporef _po_remarks _commodity _po_type _po_uom _units_po_uom
_po_inner_qnty _po_line_status _item_code _incoterms _incoterms_desc _pr_appr_date _po_app_date _po_creation_date
_po_recd_date _po_need_by_date _mode _routed_by _ship_remarks_updates _ship_billing_remarks _incoterms_fo
_shipment_serial_iss_job _response_shipment_id _inbound_iss_job_no _outbound_iss_job_no _hbl_hawb _mbl_mawb
_container_no _cbm _gw _chw _qnty _eqpt_type _pack_type _20_ft _40_ft _count_of_cont _teus _carrier _arrival_date
_arrival_date_actual _del _departure_date _departure_date_actual _crd_actual _crd_estimated _crd
_goods_cleared_origin _goods_cleared_destination _pickup_date _cargo_ho _eta _eta_simple _revised_eta _eta_wakeo
_full_eta _etd _etd_simple _revised_etd _etd_wakeo _full_etd _pta _ptd _first_edd_po _current_edd_po _first_edd_fo
_pod_date _do_date _do_exp _pr_number _pr_date _req_status _spo_number _po_status _grn_no _grn_status _addl_po
_addl_po_grn _days_delayed_eta _days_delayed_etd _etd_2_eta _eta_2_del _nbd_2_del _origin_port_pol
_delivery_location _origin_port_name _origin_country _origin_region_org_reg _destination_port_code_dest
_destination_port_name_dest _destination_country_code_dest _destination_country_dest _destination_region_reg
_aux_charge_type _aux_charge_form_no _org_charges_aed _dest_charges_aed _frt_charges_aed _aux_charges_aed
_p2p_value_aed _total_charges_aed _org_charges_usd _dest_charges_usd _frt_charges_usd _aux_charges_usd
_p2p_value_usd _total_charges_usd _invoice_no _invoice_issue_date _addl_issued_invoices _addl_invoice_issue_date
_customs_invoice_aed _customs_invoice_usd _billing_status _days_order_placement_lt _days_supplier_production_lt
_days_custom_clearance_lt _days_iss_cont_booking_lt _days_transit_lt _e2e_total_lt _supplier_lead_time
_country_lead_time _ontime_order_placement_perf _days_total_comm_perf _ship_focus_status _pre_alert _dn
_current_edd_fo _actual_lead _health_check _status _e2e_total_lead_time_perf _iss_cont_booking_perf
_supplier_committed_prod_rdy_perf _iss_transit_lead_time_perf _iss_custom_clear_perf _rdd_eta _crd_2_etd _po_2_crd
_reason_code _nbd_2_crd _nbd_2_eta _spo_invoice_val_aed _avg_lt _01_po_aknowledgment_expt
_02_po_pickup_departure_expt _03_po_transit_expt _04_po_custom_clear_expt _05_po_delivery_expt _master_line
_final_expected_del_date _06_expt_status
""".split()

QUANTITY = "decimal(38,6)"
KEYS = ["_po_no_ekporef", "_line_no"]


def order_lines(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Order lines with their running number and published columns."""
    lines = number_lines(tables["purchase_order_line"], name="_line_no")
    return lines.select(
        F.col("id").alias("__line"),
        "_line_no",
        F.col("purchase_order_company_id").alias("_client_id"),
        F.col("po_qty_ordered").try_cast(QUANTITY).alias("_original_po_qty"),
        F.col("po_type").alias("_po_type"),
        F.col("po_uom").alias("_po_uom"),
        F.col("inco_term_desc_po").alias("_incoterms_desc"),
        unit_pieces("po_uom").alias("_units_po_uom"),
        F.col("status").alias("__status"),
        *[c.alias(name) for name, c in order_columns().items()],
    )


def _linked_units(tables: Mapping[str, DataFrame]) -> DataFrame:
    units = tables["freight_unit"].select(
        F.col("id").alias("_fo_id"), "unit_no", F.col("serial_no").alias("_fo_serial"),
        F.col("shipment_link").alias("_shipment_link"),
    )
    pairs = unit_domains(tables["purchase_order_on_freight_unit"], tables["purchase_order_company"])
    return pairs.join(units, F.col("__unit") == F.col("_fo_id"), "left")


def line_units(
    tables: Mapping[str, DataFrame], fx_date: dt.date = CHARGE_FX_DATE, customs_date: dt.date = CUSTOMS_FX_DATE
) -> DataFrame:
    """Facts of every linked unit. `__unit_row` tells rows apart once they are staged."""
    df = unit_facts(tables, _linked_units(tables), PO_LINES, fx_date, customs_date)
    return df.withColumns(
        {
            **{c: F.col(c).try_cast(QUANTITY) for c in ("_cbm", "_gw", "_chw", "_qnty")},
            # A list of months is no date; such texts give NULL.
            "_invoice_issue_date": safe_day("_issue_date"),
            "_addl_invoice_issue_date": safe_day("_addl_issue_date"),
            "_spo_invoice_val_aed": F.col("_p2p_value_aed"),
            "__unit_row": F.monotonically_increasing_id(),
        }
    )


def with_unit_delivery(units: DataFrame, as_of) -> DataFrame:
    """First and current expected delivery of each freight unit."""
    df = attach_totals(
        units, ["_fo_id"],
        {
            "__first": F.min("_eta"),
            "__latest": F.max(F.coalesce("_eta_wakeo", "_eta_simple")),
        },
    )
    return df.withColumns(
        {"_first_edd_fo": plus_days("__first", 3), "_current_edd_fo": current_delivery("__latest", as_of)}
    ).drop("__first", "__latest")


def tracked_links(
    tables: Mapping[str, DataFrame], lines: DataFrame, units: DataFrame, as_of, about: tuple[str, ...] = ("__unit_row", *LINE_LEVEL)
) -> DataFrame:
    """Links of order lines to units with what the line-level rules need ``about`` units, and the lights."""
    companies = tables["purchase_order_company"].select(
        F.col("id").alias("__company"), F.col("company_name").alias("_client_name"), F.col("iss_domain").alias("__dom")
    )
    links = tables["purchase_order_on_freight_unit"].select(
        "purchase_order_id", F.col("freight_unit_id").alias("_freight_unit_id"), "purchase_order_company_id",
        F.col("quantity").alias("_shipped"),
    )
    facts = with_unit_delivery(
        units.select("__unit", "__domain", "_fo_id", "_fo_serial", *about), as_of
    )
    df = (
        links.join(companies, F.col("purchase_order_company_id") == F.col("__company"))
        .join(lines, F.col("purchase_order_id") == F.col("__line"), "left")
        # Null-safe on both keys: a link without a unit has its (empty) facts too, and stays.
        .join(facts, F.col("_freight_unit_id").eqNullSafe(F.col("__unit")) & F.col("__dom").eqNullSafe(F.col("__domain")))
    )
    return df.withColumns(stage_lights(as_of))


def lit_links(tables: Mapping[str, DataFrame], lines: DataFrame, as_of) -> DataFrame:
    """Links of order lines to units with their lights, from payload dates alone."""
    units = staged(unit_dates(tables, _linked_units(tables)), "unit-dates")
    return tracked_links(tables, lines, units, as_of, tuple(LIGHT_LEVEL))


def with_order_delivery(df: DataFrame, as_of) -> DataFrame:
    """First and current expected delivery per order; an arrival counts once past."""
    return _with_order_delivery(df, as_of).drop("__order")


def _with_order_delivery(df: DataFrame, as_of) -> DataFrame:
    """`with_order_delivery`, and the order as ``__order``, which is never NULL: rows lie by it as they will be numbered."""
    arrived = F.when(F.col("_arrival_date") < as_of, F.col("_arrival_date"))
    df = df.withColumn("__order", F.struct("_po_no_ekporef"))
    totals = df.groupBy("__order").agg(
        F.min("_eta").alias("__first"), F.max(F.coalesce(arrived, F.col("_eta_wakeo"), F.col("_eta_simple"))).alias("__current")
    )
    return df.join(totals, "__order", "left").withColumns(
        {"_first_edd_po": plus_days("__first", 3), "_current_edd_po": plus_days("__current", 3)}
    ).drop("__first", "__current")


def with_line_ids(df: DataFrame) -> DataFrame:
    """Surrogate id per shipped row; rows of an order (``__order``) are numbered by line, then unit.

    The numbering only keeps ids apart, so it comes behind every join that may repeat a row.
    """
    order = ["__line", "_freight_unit_id", "purchase_order_company_id", "_shipped", "_shipment_serial_iss_job",
             "_supplier_lead_time", "__unit_row"]
    df = numbers_by_group(df, ["__order"], order, "__row")
    dash = F.lit("-")
    key = surrogate_key("_po_no_ekporef", dash, "__line", dash, F.lit("fo shipped"), dash, "_fo_serial", dash, "__row")
    return df.withColumn("_line_id", key).drop("__row")


def shipped_rows(tables: Mapping[str, DataFrame], tracked: DataFrame, units: DataFrame, as_of) -> DataFrame:
    """Row type 'Enriched': everything known about a line's share of a unit.

    Rules run on narrow rows, which are staged; the unit's published columns, those too that the rules have read, join last.
    """
    df = _with_order_delivery(tracked, as_of)
    suppliers = tables["supplier_lead_time"].select(
        F.col("supplier_id").try_cast("int").alias("__supplier"), F.col("avg_lead_time").alias("_supplier_lead_time")
    )
    df = df.withColumn("__supplier_no", F.col("_supplier_code").try_cast("int"))
    df = with_line_ids(df.join(suppliers, F.col("__supplier_no") == F.col("__supplier"), "left"))
    df = with_scores(df, PO_LINES, as_of)
    gaps = F.col("_crd_2_etd") + F.col("_etd_2_eta") + F.col("_eta_2_del") + F.col("_nbd_2_eta") + F.col("_nbd_2_del")
    df = df.withColumns(
        {
            "_line_type": F.lit("Enriched"),
            "_po_line_status": F.lit("Enriched"),
            "_qnty_shipped_remaning": F.col("_shipped"),
            "_inner_qnty_shipped": pieces_of("_shipped", "_po_uom", SHIPPED_UNIT_PIECES),
            "_avg_lt": gaps,
            "_master_line": F.lit("No"),
        }
    )
    about = [c for c in COLUMNS if c in units.columns and (c in LINE_LEVEL or c not in df.columns)]
    own = [c for c in COLUMNS if c in df.columns and c not in about]
    side = units.select(F.col("__unit_row").alias("__about"), *about)
    scored = staged(df.select("__unit_row", *own), "scored-links")
    return scored.join(side, F.col("__unit_row") == F.col("__about")).select(*own, *about)


def with_balance(tables: Mapping[str, DataFrame], lines: DataFrame) -> DataFrame:
    """Order lines with ``_balance_outer_qnty``: what is ordered and not shipped."""
    shipped = shipped_quantity(tables["purchase_order_on_freight_unit"]).withColumnRenamed("__line", "__shipped_line")
    balance = F.col("_original_po_qty") - F.coalesce(F.col("__shipped"), F.lit(0))
    df = lines.join(shipped, F.col("__line") == F.col("__shipped_line"), "left")
    return df.withColumn("_balance_outer_qnty", balance).drop("__shipped_line", "__shipped")


def master_rows(tables: Mapping[str, DataFrame], lines: DataFrame) -> DataFrame:
    """Exactly one row per order line with its balance; ``lines`` that have it already keep it."""
    companies = tables["purchase_order_company"].select(
        F.col("id").alias("__company"), F.col("company_name").alias("_client_name")
    )
    df = lines if "_balance_outer_qnty" in lines.columns else with_balance(tables, lines)
    df = df.join(companies, F.col("_client_id") == F.col("__company"), "left")
    status = F.col("__status")
    dash = F.lit("-")
    zero = F.lit(0.0)
    return df.withColumns(
        {
            "_line_type": line_type(status),
            "_line_id": surrogate_key("_po_no_ekporef", dash, "__line", dash, F.lit("po remaining"), dash, "_line_no"),
            "_po_outer_qty": F.col("_original_po_qty"),
            "_balance_inner_qnty": balance_pieces("_balance_outer_qnty", "_po_uom"),
            "_freight_unit_id": F.lit(0).cast("long"),
            "_fo_id": F.lit(0).cast("long"),
            "_po_inner_qnty": pieces_of("_original_po_qty", "_po_uom"),
            "_po_line_status": choose(
                [(surely_matches(status, "cancel"), F.lit("Cancelled")), (surely_matches(status, "close"), F.lit("Closed"))],
                title_words(status),
            ),
            "_days_order_placement_lt": F.coalesce(order_placement_days("_pr_appr_date", "_po_app_date"), F.lit(0)),
            "_ontime_order_placement_perf": placement_score("_pr_appr_date", "_po_app_date", whole=False),
            **{c: F.lit(0) for c in NO_DAYS},
            **{c: zero for c in NO_SCORE},
            "_shipped": F.lit(None).cast(QUANTITY),
            "_current_edd_po": F.lit(None).cast("date"),
            "_master_line": F.lit("Master"),
        }
    )


NO_DAYS = (
    "_days_supplier_production_lt", "_days_custom_clearance_lt", "_days_iss_cont_booking_lt", "_days_transit_lt",
    "_e2e_total_lt",
)
NO_SCORE = (
    "_e2e_total_lead_time_perf", "_iss_cont_booking_perf", "_supplier_committed_prod_rdy_perf",
    "_iss_transit_lead_time_perf", "_iss_custom_clear_perf",
)


def with_final_dates(masters: DataFrame, tracked: DataFrame, as_of, fixed: bool) -> DataFrame:
    """`_final_expected_del_date` of master rows.

    Quirk kept: master rows carry neither a shipped quantity nor a delivery
    date, so as published the column is always NULL. ``fixed`` compares ordered
    with shipped and takes the order's current date.
    """
    if not fixed:
        due = final_delivery("_line_type", "_original_po_qty", "_shipped", "_current_edd_po")
        return masters.withColumn("_final_expected_del_date", due)
    arrived = F.when(F.col("_arrival_date") < as_of, F.col("_arrival_date"))
    current = F.max(F.coalesce(arrived, F.col("_eta_wakeo"), F.col("_eta_simple")))
    per_order = tracked.groupBy(F.col("_po_no_ekporef").alias("__po")).agg(plus_days(current, 3).alias("__due"))
    shipped = F.col("_original_po_qty") - F.col("_balance_outer_qnty")
    out = masters.join(per_order, F.col("_po_no_ekporef") == F.col("__po"), "left")
    return out.withColumn(
        "_final_expected_del_date", final_delivery("_line_type", "_original_po_qty", shipped, "__due")
    ).drop("__po", "__due")


def po_line_view(
    tables: Mapping[str, DataFrame], as_of: AsOf = None, fx_date: dt.date = CHARGE_FX_DATE,
    customs_date: dt.date = CUSTOMS_FX_DATE, fixed_final_date: bool = False,
) -> DataFrame:
    """Shipped rows and master rows of every order line, with exception lights.

    Results that feed several branches are staged once: the numbered order lines, the facts per unit, and the tracked links
    (order totals, numbering, light rollup, output). Scored links and master rows are staged as well, so that what has been
    shuffled for one is gone before the other runs. Lights meet the lines before their published columns are made.
    """
    today = as_of_date(as_of)
    lines = staged(order_lines(tables), "order-lines")
    units = staged(line_units(tables, fx_date, customs_date), "line-units")
    tracked = staged(tracked_links(tables, lines, units, today), "tracked-links")
    shipped = shipped_rows(tables, tracked, units, today)
    lit = light_rollup(with_balance(tables, lines), tracked, KEYS, "_balance_outer_qnty", "_06_expt_status", STAGES)
    masters = with_final_dates(master_rows(tables, lit), tracked, today, fixed_final_date)
    masters = staged(masters.select(*[c for c in masters.columns if c in COLUMNS]), "master-rows")
    return shipped.unionByName(masters, allowMissingColumns=True).select(*COLUMNS)
