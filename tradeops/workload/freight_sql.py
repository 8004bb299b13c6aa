"""SQL twins of the freight reports, staged as common table expressions."""

from __future__ import annotations

from .base import AS_OF
from .finance import CHARGES_SQL, CUSTOMS_SQL


def _text(field: str) -> str:
    return f"json_extract_string(p, '$.{field}')"


def _date(field: str) -> str:
    return f"try_cast({_text(field)} as date)"


def _named(name: str) -> str:
    return f"list_extract(list_filter(cd, lambda x: x.name = '{name}'), 1).value"


def _event(*phrases: str) -> str:
    test = " or ".join(f"x.status ilike '%{p}%'" for p in phrases)
    return f"try_cast(list_min(list_transform(list_filter(su, lambda x: {test}), lambda x: x.date)) as date)"


def _boxes(feet: int) -> str:
    return (
        f"list_sum(list_transform(list_filter(eq, lambda x: x like '% x {feet} ft%'), "
        "lambda x: try_cast(nullif(regexp_extract(x, '^[0-9]+'), '') as int)))"
    )


def payload_sql(separator: str) -> str:
    """CTE pay: one row per unit and matching domain, payload flattened."""
    return f"""
arms as (
  select unit_no as pu, iss_domain as pd, shipment_response as p from @freight_unit_enrich
  union all select unit_no, remote_iss_domain, remote_shipment_response from @freight_unit_enrich),
raw as (
  select *, from_json(json_extract(p, '$.custom_dates'), '[{{"name":"VARCHAR","value":"VARCHAR"}}]') as cd,
    from_json(json_extract(p, '$.status_updates'), '[{{"status":"VARCHAR","date":"VARCHAR"}}]') as su,
    from_json(json_extract(p, '$.equipment'), '["VARCHAR"]') as eq,
    from_json(json_extract(p, '$.equipment_details'), '[{{"equipment_no":"VARCHAR"}}]') as ed,
    from_json(json_extract(p, '$.cargo'), '[{{"package_type":"VARCHAR"}}]') as cg from arms),
pay as (
  select pu, pd, p is not null as has_payload, {_text("serial_no")} as _shipment_serial_iss_job, {_text("id")} as _response_shipment_id, {_text("house_no")} as _hbl_hawb,
    {_text("master_no")} as _mbl_mawb, {_text("master_spo_no")} as _spo_number, {_text("service")} as p_service,
    {_text("shipping_terms")} as p_terms, {_text("carrier")} as p_carrier, {_text("operational_status")} as p_status,
    {_text("origin_port")} as p_oport, {_text("destination_port")} as p_dport, {_text("origin_country")} as p_ocountry,
    {_text("destination_country")} as p_dcountry, {_text("gross_volume")} as _cbm, {_text("gross_weight")} as _gw,
    {_text("chargeable_weight")} as _chw, {_text("package_count")} as _qnty,
    {_date("arrival_date")} as _arrival_date, {_date("loading_date")} as _departure_date, {_date("delivery_date")} as _del,
    {_date("pickup_date")} as _pickup_date, _pickup_date as _cargo_ho, {_date("pta_date")} as _pta, {_date("ptd_date")} as _ptd,
    {_date("eta_date")} as _eta_simple, {_date("etd_date")} as _etd_simple, {_date("eta_wakeo_date")} as _eta_wakeo,
    {_date("etd_wakeo_date")} as _etd_wakeo, coalesce(_pta, _eta_simple) as _eta, coalesce(_eta_wakeo, _eta_simple) as _revised_eta,
    coalesce(_eta_wakeo, _pta, _eta_simple) as _full_eta, coalesce(_ptd, _etd_simple) as _etd,
    coalesce(_etd_wakeo, _etd_simple) as _revised_etd, coalesce(_etd_wakeo, _ptd, _etd_simple) as _full_etd,
    try_cast({_named("Cargo Ready Date Actual")} as date) as _crd_actual, try_cast({_named("Cargo Ready Date Estimated")} as date) as _crd_estimated,
    coalesce(_crd_actual, _crd_estimated) as _crd, try_cast({_named("Goods Cleared at Origin Customs")} as date) as _goods_cleared_origin,
    try_cast({_named("Goods Cleared at Destination Customs")} as date) as _goods_cleared_destination,
    {_named("POD Date")} as pod_text, {_named("D/O Date")} as do_text, {_named("D/O Expiry Date")} as exp_text,
    {_event("Actual Time of Departure", "Vessel departure")} as _departure_date_actual,
    {_event("Actual Time of Arrival", "Vessel arrival")} as _arrival_date_actual,
    array_to_string(list_transform(ed, lambda x: x.equipment_no), '{separator}') as _container_no,
    nullif(array_to_string(list_sort(list_distinct(list_transform(cg, lambda x: x.package_type))), ', '), '') as _pack_type,
    array_to_string(list_transform(eq, lambda x: '"' || x || '"'), ' + ') as eq_text,
    {_boxes(20)} as _20_ft, {_boxes(40)} as _40_ft, coalesce(_20_ft, 0) + coalesce(_40_ft, 0) as _count_of_cont,
    coalesce(_20_ft, 0) + 2 * coalesce(_40_ft, 0) as _teus
  from raw)
"""


FACTS_SQL = (
    CHARGES_SQL
    + ","
    + CUSTOMS_SQL
    + """,
notes as (select parent_id as np, count(*) as n_notes from @attachments where label = 'AGI' and uploaded = 1 group by 1),
facts as (
  select s.id as f_id, s.serial_no as f_serial, n_notes, _amount_aed as _customs_invoice_aed, _amount_usd as _customs_invoice_usd, costs.*
  from @shipments_ops s left join notes on np = s.id left join customs_known on _customs_ship = s.id left join costs on _ship_serial = s.serial_no)
"""
)

PLACES_SQL = """
sea as (select port as c, first(country order by country, region) as cc, first(region order by country, region) as rr from @ports group by 1),
air as (select airport as c, first(country order by country, region) as cc, first(region order by country, region) as rr from @airports group by 1),
anyp as (select c, first(cc order by cc, rr) as cc, first(rr order by cc, rr) as rr from (
  select port as c, country as cc, region as rr from @ports union all select airport, country, region from @airports where airport <> 'TBA') u group by 1),
pname as (select code as c, min(name) as nn from @port_codes group by 1),
country as (select iso_2_char_code as c, max(country_name) as nn from @country_codes group by 1)
"""


def _area(side: str, field: str, land: str) -> str:
    return f"""upper(case when serial is null and mode in ('sea', 'air') then {side}any.{field} when mode = 'sea' and serial is not null then {side}sea.{field}
      when mode = 'air' and serial is not null then {side}air.{field} when {land} then 'Jebel Ali' else 'TBA' end)"""


# Columns every enriched row gets from the plan, the facts and the lookups;
# needs aliases b (base rows), fe and facts in scope.
ENRICHED = f"""
  _shipment_serial_iss_job as serial, split_part(fe.service, '_', 1) as mode,
  fe.id as _fe_id, case when serial is null then fe.service else p_service end as _mode, fe.routed_by as _routed_by,
  json_extract_string(fe.shipment_response, '$.serial_no') as _inbound_iss_job_no,
  json_extract_string(fe.remote_shipment_response, '$.serial_no') as _outbound_iss_job_no,
  fe.pr_number as _pr_number, fe.pr_date as _pr_date, case when fe.pr_number is null then 'Pending' else 'Logged' end as _req_status,
  case when fe.spo_number is null then 'Pending' else 'Received' end as _po_status, fe.grn_no as _grn_no,
  case when fe.grn_no is null then 'Pending' else 'Complete' end as _grn_status, fe.addl_po as _addl_po,
  fe.addl_po_grn_number as _addl_po_grn, fe.delivery_location as _delivery_location, fe.shipment_remarks as _ship_remarks_updates,
  fe.billing_notes as _ship_billing_remarks, case when fe.pre_alert_sent_at is null then 'No' else 'Yes' end as _pre_alert,
  fe.ancillary_charge_form_no as _aux_charge_form_no,
  case when f_id is not null then case when n_notes is not null then 'Yes' else 'No' end end as _dn,
  _org_charges_local as _org_charges_aed, _dest_charges_local as _dest_charges_aed, _frt_charges_local as _frt_charges_aed,
  _aux_charges_local as _aux_charges_aed, _org_charges_local + _frt_charges_local + _dest_charges_local as _p2p_value_aed,
  _p2p_value_aed + _aux_charges_local as _total_charges_aed, _org_charges_usd + _frt_charges_usd + _dest_charges_usd as _p2p_value_usd,
  _p2p_value_usd + _aux_charges_usd as _total_charges_usd, _p2p_value_aed as _spo_invoice_val_aed, _issued_invoices as _invoice_no,
  case when _issued_invoices is null then 'Pending' else 'Billed' end as _billing_status, car._carrier,
  case when serial is null then fe.origin_port else p_oport end as _origin_port_pol,
  upper(case when mode in ('sea', 'air') then oname.nn when fe.service = 'land_inbound' then 'Jebel Ali' else 'TBA' end) as _origin_port_name,
  {_area("o", "cc", "fe.service = 'land_inbound'")} as _origin_country,
  {_area("o", "rr", "mode = 'land'")} as _origin_region_org_reg,
  case when serial is null then fe.destination_port else p_dport end as _destination_port_code_dest,
  upper(case when mode in ('sea', 'air') and (serial is not null or fe.shipment_serial_no is not null) then dname.nn
    when mode = 'land' then 'Jebel Ali' else 'TBA' end) as _destination_port_name_dest,
  case when serial is null then fe.destination_country else p_dcountry end as _destination_country_code_dest,
  upper(dcountry.nn) as _destination_country_dest, {_area("d", "rr", "mode = 'land'")} as _destination_region_reg
"""


def _place_joins() -> str:
    out = []
    for side, actual, plan in (("o", "p_oport", "origin_port"), ("d", "p_dport", "destination_port")):
        key = f"case when _shipment_serial_iss_job is null then fe.{plan} else {actual} end"
        for table in ("sea", "air", "any"):
            name = "anyp" if table == "any" else table
            out.append(f"left join {name} {side}{table} on {side}{table}.c = {key}")
        out.append(f"left join pname {side}name on {side}name.c = {key}")
    key = "case when _shipment_serial_iss_job is null then fe.destination_country else p_dcountry end"
    out.append(f"left join country dcountry on dcountry.c = {key}")
    return "\n  ".join(out)


ENRICH_JOINS = f"""
  left join @freight_unit_enrich fe on fe.unit_no = b.unit_no
  left join facts on f_serial = _shipment_serial_iss_job
  left join (select name as _carrier, unnest(all_scacs) as scac from @carrier_shipping) car on scac = p_carrier
  {_place_joins()}
"""


def scores_sql(source: str, whole: bool, committed: str, inverted: bool, need_by_eta: str, need_by_if: str) -> str:
    """CTEs s1 (days), s2 (lead, state, scores) and s3 (reason, need-by) over ``source``."""
    div = (lambda a, b: f"cast(({a}) // ({b}) as double)") if whole else (lambda a, b: f"(({a}) / cast({b} as double))")
    nz = lambda c: f"coalesce(nullif({c}, 0), 1)"
    deviation = "abs(" + div("_e2e_total_lt - _days_total_comm_perf", nz("_days_total_comm_perf")) + ")"
    total = f"1 - {deviation}" if inverted else deviation
    d = f"date '{AS_OF}'"
    return f"""
s1 as (select *,
  coalesce(_po_app_date - _pr_appr_date, 0) as _days_order_placement_lt,
  case when _del is null or _crd is null or _po_app_date is null then 0 else _crd - _po_app_date end as _days_supplier_production_lt,
  case when _del is not null and _full_eta is not null then _del - _full_eta else 0 end as _days_custom_clearance_lt,
  case when _full_etd is not null then _full_etd - _crd else 0 end as _days_iss_cont_booking_lt,
  _full_eta - _full_etd as _days_transit_lt, _del - _pr_appr_date as _e2e_total_lt,
  case when _del is not null then _eta_wakeo - _eta_simple end as _days_delayed_eta,
  case when _del is not null then _etd_wakeo - _etd_simple end as _days_delayed_etd,
  _revised_eta - _revised_etd as _etd_2_eta, _del - _revised_eta as _eta_2_del, _po_need_by_date - _del as _nbd_2_del,
  case when _del is not null then _full_eta - _po_need_by_date end as _rdd_eta,
  case when _revised_etd is not null then _revised_etd - _crd else _full_etd - _crd end as _crd_2_etd, _crd - _po_creation_date as _po_2_crd,
  case when _po_app_date - _pr_appr_date <= 5 then 1.0 when _po_app_date - _pr_appr_date > 5
    then 1 - abs({div("_po_app_date - _pr_appr_date", "5")}) else 0.0 end as _ontime_order_placement_perf,
  case when _del is null or p_ocountry is null or coalesce(regexp_matches(p_status, 'cancel', 'i'), false) then 0 else {committed} end as _days_total_comm_perf
  from {source}),
s2 as (select *,
  case when _days_order_placement_lt + _days_supplier_production_lt + _days_custom_clearance_lt + _days_iss_cont_booking_lt + _days_transit_lt > 500 then 0
    else _days_order_placement_lt + _days_supplier_production_lt + _days_custom_clearance_lt + _days_iss_cont_booking_lt end as _actual_lead,
  _actual_lead - _days_total_comm_perf as over_by,
  case when _supplier_lead_time is null or _del is null or _full_eta is null or _full_etd is null or _pr_appr_date is null or over_by is null then null
    when over_by <= 15 then 'Healthy' when over_by <= 30 then 'Minor' when over_by <= 45 then 'Moderate' when over_by <= 60 then 'Major' else 'Severe' end as _health_check,
  coalesce(regexp_matches(_ship_focus_status, 'cancel', 'i'), false) as cancelled,
  case when _full_etd is null then 'Pending'
    when _shipment_serial_iss_job is not null and _full_eta <= {d} and _full_etd <= {d} and _del <= {d} then 'Delivered'
    when _shipment_serial_iss_job is not null and cancelled then 'Cancelled'
    when (_shipment_serial_iss_job is not null or _response_shipment_id is not null) and _full_eta > {d} and _full_etd <= {d} then 'In transit'
    when coalesce(_shipment_serial_iss_job, '') = '' and (_fo_id is not null or _full_etd > {d}) then 'Ongoing'
    when coalesce(_shipment_serial_iss_job, '') <> '' and not cancelled and _departure_date_actual is null then 'Ongoing'
    when _shipment_serial_iss_job is not null and _full_eta <= {d} and _full_etd <= {d} and (_del is null or _del > {d}) then 'Arrived' end as _status,
  case when _e2e_total_lt > 0 then {total} else 0 end as _e2e_total_lead_time_perf,
  case when _full_etd is not null and _days_iss_cont_booking_lt > 0 then case when _full_etd - _crd <= 7 then 1.0
    else 1 - abs(_full_etd - _crd) / 7.0 end else 0 end as _iss_cont_booking_perf,
  case when _po_app_date is null or _crd is null then 0.0 when _crd - _po_app_date <= _supplier_lead_time then 1.0
    when _crd - _po_app_date > _supplier_lead_time then 1 - abs(_crd - _po_app_date) / cast({nz("_supplier_lead_time")} as double) end as _supplier_committed_prod_rdy_perf,
  case when _del is null or _full_eta is null or _full_etd is null or _origin_country is null then 0.0
    when _full_eta - _full_etd <= _country_lead_time then 1.0 when _full_eta - _full_etd > _country_lead_time
    then 1 - abs({div("_full_eta - _full_etd", nz("_country_lead_time"))}) else 0.0 end as _iss_transit_lead_time_perf,
  case when _del is null or _full_eta is null then 0.0 when _del - _full_eta <= 3 then 1.0 else 1 - abs({div("_del - _full_eta", "3")}) end as _iss_custom_clear_perf
  from s1),
s3 as (select *,
  case when coalesce(_health_check, 'Healthy') = 'Healthy' then null when _ontime_order_placement_perf < 1 then 'PR to PO delay'
    when _supplier_committed_prod_rdy_perf < 1 then 'Product Readiness Delay' when _iss_cont_booking_perf < 1 then 'Booking delay'
    when _iss_transit_lead_time_perf < 1 then 'Trans Shipment delay' when _iss_custom_clear_perf < 1 then 'Custom Clearance Delay' end as _reason_code,
  case when _status in ('Cancelled', 'Pending', 'Not due') then null else _crd - _po_need_by_date end as _nbd_2_crd,
  case when {need_by_if} is not null then {need_by_eta} - _po_need_by_date end as _nbd_2_eta,
  _crd_2_etd + _etd_2_eta + _eta_2_del + _nbd_2_eta + _nbd_2_del as avg_row from s2)
"""


LINE_COLUMNS = """p.ship_to_location as _branch_bu, p.supplier_no as _supplier_code, p.supplier_name as _supplier_name, p.po_no as _po_no_ekporef,
  p.po_remarks as _po_remarks, p.po_desc as _commodity, p.item_code as _item_code, p.inco_term_po as _incoterms, p.req_app_dt as _pr_appr_date,
  p.po_app_dt as _po_app_date, p.po_date as _po_creation_date, p.po_app_dt + 2 as _po_recd_date, p.current_po_promised_dt as _po_need_by_date"""


# Units without a payload count no containers.
PAY = "pay.* replace (coalesce(_count_of_cont, 0) as _count_of_cont, coalesce(_teus, 0) as _teus)"

INNER_SQL = """
inner_qty as (
  select freight_unit_id as qf, case when count(*) > 1 then string_agg(po_no || ' - ' || item_code || ' - ' || cast(quantity as varchar), ' | '
      order by po_no || ' - ' || item_code || ' - ' || cast(quantity as varchar)) else cast(sum(quantity) as varchar) end as _inner_qty
  from @purchase_order_on_freight_unit left join @purchase_order_line on id = purchase_order_id group by 1)
"""


def shipped_sql() -> str:
    """CTEs up to s3 for the freight-order report's enriched rows."""
    return (
        "with "
        + ",".join([payload_sql("|"), FACTS_SQL, PLACES_SQL, INNER_SQL])
        + f""",
links as (select distinct purchase_order_id, freight_unit_id, purchase_order_company_id from @purchase_order_on_freight_unit),
base as (
  select p.id as _pid, l.purchase_order_company_id as _client_id, c.company_name as _client, u.id as fo, u.unit_no, u.serial_no as _iss_ref,
    u.shipment_serial_no as unit_serial, md5(cast(u.id as varchar)) as _fo_id, {LINE_COLUMNS}, slt.avg_lead_time as _supplier_lead_time, _inner_qty, {PAY}
  from @purchase_order_line p join links l on l.purchase_order_id = p.id join @purchase_order_company c on c.id = l.purchase_order_company_id
  join @freight_unit u on u.id = l.freight_unit_id and u.deleted_at is null
  left join pay on pu = u.unit_no and pd = c.iss_domain left join @supplier_lead_time slt on slt.supplier_id = p.supplier_no
  left join inner_qty on qf = l.freight_unit_id),
x as (
  select b.*, facts.*, {ENRICHED}, ctt.average_transit_time as _country_lead_time,
    case when unit_serial is null then fe.shipping_terms else p_terms end as _incoterms_fo, replace(eq_text, '"', '') as _eqpt_type
  from base b {ENRICH_JOINS} left join @country_transit_time ctt on ctt.code = p_ocountry),
"""
        + scores_sql("x", True, "_supplier_lead_time + _country_lead_time + 15", False, "_revised_eta", "_revised_etd")
    )


def freight_orders_sql(primary: list[str], largest: list[str], columns: list[str]) -> str:
    renamed = {
        "_pod_date": "pod_text", "_do_date": "do_text", "_do_exp": "exp_text", "_gross_weight": "_gw", "_chargeable_weight": "_chw",
        "_quantity": "_qnty", "_invoice_issue_date": "_issue_date", "_addl_invoice_issue_date": "_addl_issue_date",
        "_est_cargo_ready_date": "_crd_estimated",
    }
    main = [f"max({c}) filter (where rn = 1) as {c}" for c in (*primary, "_po_no_ekporef")]
    main += [f"max({renamed.get(c, c)}) as {c}" for c in largest]
    main += [
        "string_agg(distinct _po_no_ekporef, ' | ' order by _po_no_ekporef) filter (where rn <> 1) as _secondary_po",
        "string_agg(distinct _po_remarks, ' | ' order by _po_remarks) as _po_remarks",
        "string_agg(distinct _commodity, ' | ' order by _commodity) as _commodity",
        "max(avg_row) filter (where rn = 1) as _avg_lt", "'main' as _row_type",
    ]
    left = {
        "_fo_id": "md5(p.po_no || p.po_desc || cast(p.current_po_promised_dt as varchar) || cast(p.id as varchar))", "_pid": "p.id",
        "_po_qty_ordered": "ordered", "_remaining_quantity": "ordered - used", "_branch_bu": "p.ship_to_location",
        "_supplier_code": "p.supplier_no", "_supplier_name": "p.supplier_name", "_po_no_ekporef": "p.po_no", "_item_code": "p.item_code",
        "_po_remarks": "p.po_remarks", "_commodity": "p.po_desc", "_client_id": "c.id", "_client": "c.company_name",
        "_incoterms": "p.inco_term_po", "_pr_appr_date": "p.req_app_dt", "_po_app_date": "p.po_app_dt", "_po_creation_date": "p.po_date",
        "_po_recd_date": "p.po_app_dt + 2", "_po_need_by_date": "p.current_po_promised_dt",
        "_days_order_placement_lt": "p.po_app_dt - p.req_app_dt",
        "_status": f"""case when upper(p.status) = 'CANCELLED' then 'Cancelled' when upper(p.status) is null then null
          when p.current_po_promised_dt <= date '{AS_OF}' then 'Due' when p.current_po_promised_dt > date '{AS_OF}' + 90 then 'Not Due'
          when p.current_po_promised_dt > date '{AS_OF}' then 'Pending' end""",
        "_ontime_order_placement_perf": """case when p.po_app_dt - p.req_app_dt <= 5 then 1.0 when p.po_app_dt - p.req_app_dt > 5
          then 1 - abs((p.po_app_dt - p.req_app_dt) // 5) else 0.0 end""",
        "_supplier_committed_prod_rdy_perf": "0.0", "_row_type": "'remaining'",
    }
    return f"""{shipped_sql()},
ranked as (select *, row_number() over (partition by fo order by _po_need_by_date nulls last, _pid nulls last, _client_id nulls last, _fe_id nulls last,
    _shipment_serial_iss_job nulls last) as rn from s3),
main as (select _fo_id, {", ".join(main)} from ranked group by 1),
used as (select purchase_order_id as ul, sum(quantity) as uq from @purchase_order_on_freight_unit group by 1),
rest as (
  select {", ".join(f"{e} as {n}" for n, e in left.items())}
  from (select *, coalesce(try_cast(po_qty_ordered as double), 0.0) as ordered, coalesce(uq, 0.0) as used
        from @purchase_order_line left join used on ul = id) p
  join @purchase_order_company c on c.id = p.purchase_order_company_id
  left join @supplier_lead_time s on upper(s.supplier_name) = upper(p.supplier_name)
  where ordered - used > 0)
select * from main union all by name select * from rest
"""


def lights_sql(source: str) -> str:
    """The five stage lights as a select list over staged date columns."""
    d = f"date '{AS_OF}'"
    dep, arr = "coalesce(_departure_date_actual, _departure_date)", "coalesce(_arrival_date_actual, _arrival_date)"
    etd, eta = "coalesce(_etd_wakeo, _ptd, _etd)", "coalesce(_pta, _eta)"
    held = f"{arr} <= {d} and (_goods_cleared_destination is null or _goods_cleared_destination > {d}) and (_del is null or _del > {d})"
    wait = f"(_del is null or _del > {d}) and coalesce(_eta_wakeo, _eta) is not null"
    return f"""select *,
  case when _etd is not null and _eta is not null and _crd is not null then 'dark green' else 'green' end as _01_po_aknowledgment_expt,
  case when {dep} <= {d} then 'dark green' when {etd} <= _crd + 5 then 'green' when {etd} <= _crd + 7 then 'yellow' when {etd} > _crd + 7 then 'red' end
    as _02_po_pickup_departure_expt,
  case when {arr} <= {d} then 'dark green' when ({eta} >= _eta_wakeo or _eta_wakeo is null) and {dep} <= {d} and _eta is not null then 'green'
    when _eta_wakeo - {eta} > 10 and {dep} <= {d} and _eta is not null then 'red'
    when _eta_wakeo - {eta} > 0 and {dep} <= {d} and _eta is not null then 'yellow' end as _03_po_transit_expt,
  case when _goods_cleared_destination <= {d} or _del <= {d} then 'dark green' when {held} and {d} <= {arr} + 5 then 'green'
    when {held} and {d} > {arr} + 7 then 'red' when {held} and {d} > {arr} + 5 then 'yellow' end as _04_po_custom_clear_expt,
  case when _del <= {d} then 'dark green' when {wait} and _current_edd_fo <= _po_need_by_date then 'green'
    when {wait} and _current_edd_fo - _po_need_by_date > 3 then 'red' when {wait} and _current_edd_fo > _po_need_by_date then 'yellow' end
    as _05_po_delivery_expt
  from {source}"""


STAGE_NAMES = (
    "_01_po_aknowledgment_expt", "_02_po_pickup_departure_expt", "_03_po_transit_expt", "_04_po_custom_clear_expt",
    "_05_po_delivery_expt",
)


def _some(test: str) -> str:
    return " or ".join(f"coalesce(bool_or({s} {test}), false)" for s in STAGE_NAMES)


ROLLUP_SQL = f"""
flags as (select _po_no_ekporef as k1, _line_no as k2, {_some("= 'red'")} as red, {_some("= 'yellow'")} as yellow, {_some("<> 'yellow'")} as other,
    {_some("= 'green'")} as green, {" and ".join(f"coalesce(bool_or({s} = 'dark green'), false)" for s in STAGE_NAMES)} as dark
  from lit group by 1, 2)
"""

ROLLED = """case when k1 is null or red then 'red' when (yellow or other) and bal > 0 then 'yellow' when green and bal = 0 then 'green'
  when dark and bal = 0 then 'dark green' end"""


def tracked_sql() -> str:
    """CTEs lines, tracked and lit: order-line links with payload dates and lights."""
    d = f"date '{AS_OF}'"
    return (
        "with "
        + payload_sql(" | ")
        + f""",
lines as (select *, row_number() over (partition by po_no order by id) as _line_no, try_cast(po_qty_ordered as decimal(38, 6)) as qty from @purchase_order_line),
tracked as (
  select p.id as pid, _line_no, p.purchase_order_company_id as _client_id, p.qty as _original_po_qty, p.po_type as _po_type, p.po_uom as _po_uom,
    p.inco_term_desc_po as _incoterms_desc, p.status as line_status, {LINE_COLUMNS}, l.freight_unit_id as _freight_unit_id, l.quantity as _shipped,
    l.purchase_order_company_id as link_company, c.company_name as _client_name, u.id as _fo_id, u.unit_no, u.serial_no as _fo_serial,
    u.shipment_link as _shipment_link, {PAY}
  from @purchase_order_on_freight_unit l join @purchase_order_company c on c.id = l.purchase_order_company_id
  left join lines p on p.id = l.purchase_order_id left join @freight_unit u on u.id = l.freight_unit_id
  left join pay on pu = u.unit_no and pd = c.iss_domain),
edd as (select *, min(_eta) over (partition by _fo_id) + 3 as _first_edd_fo, max(coalesce(_eta_wakeo, _eta_simple)) over (partition by _fo_id) + 3 as due,
    case when due <= {d} and _del is null then {d} + 1 else due end as _current_edd_fo, min(_eta) over (partition by _po_no_ekporef) + 3 as _first_edd_po,
    max(coalesce(case when _arrival_date < {d} then _arrival_date end, _eta_wakeo, _eta_simple)) over (partition by _po_no_ekporef) + 3 as _current_edd_po
  from tracked),
lit as ({lights_sql("edd")})
"""
    )


def _pieces(quantity: str, more: str = "") -> str:
    return f"""case _po_uom when 'EACH' then {quantity} when 'CASE OF 6' then 6 * {quantity} when 'CASE OF 12' then 12 * {quantity}
      when 'CASE OF 24' then 24 * {quantity} {more} else 0 end"""


MASTER_SQL = f"""
moved as (select purchase_order_id as ml, sum(quantity) as mq from @purchase_order_on_freight_unit group by 1),
masters as (
  select p.id as pid, p._line_no, p.purchase_order_company_id as _client_id, c.company_name as _client_name, p.qty as _original_po_qty,
    p.qty as _po_outer_qty, p.qty - coalesce(mq, 0) as bal, p.po_uom as _po_uom, p.po_type as _po_type, p.inco_term_desc_po as _incoterms_desc,
    p.status as st, {LINE_COLUMNS}
  from lines p left join moved on ml = p.id left join @purchase_order_company c on c.id = p.purchase_order_company_id)
"""


def po_lines_sql(columns: list[str]) -> str:
    shipped = {
        "_line_type": "'Enriched'", "_po_line_status": "'Enriched'", "_qnty_shipped_remaning": "_shipped",
        "_line_id": "md5(_po_no_ekporef || '-' || cast(pid as varchar) || '-fo shipped-' || _fo_serial || '-' || cast(rn as varchar))",
        "_inner_qnty_shipped": _pieces("_shipped", "when 'CASE OF 32' then 32 * _shipped"), "_units_po_uom": _pieces("1"),
        "_cbm": "try_cast(_cbm as double)", "_gw": "try_cast(_gw as double)", "_chw": "try_cast(_chw as double)", "_qnty": "try_cast(_qnty as double)",
        "_eqpt_type": "eq_text", "_pod_date": "try_cast(pod_text as date)", "_do_date": "try_cast(do_text as date)",
        "_do_exp": "try_cast(exp_text as date)", "_invoice_issue_date": "try_cast(_issue_date as date)",
        "_addl_invoice_issue_date": "try_cast(_addl_issue_date as date)", "_avg_lt": "avg_row", "_master_line": "'No'",
    }
    absent = {"_po_outer_qty", "_balance_outer_qnty", "_balance_inner_qnty", "_po_inner_qnty", "_final_expected_del_date", "_06_expt_status"}
    enriched = ", ".join(f"{shipped.get(c, c)} as {c}" for c in columns if c not in absent)
    zeros = (
        "_days_supplier_production_lt", "_days_custom_clearance_lt", "_days_iss_cont_booking_lt", "_days_transit_lt", "_e2e_total_lt",
        "_e2e_total_lead_time_perf", "_iss_cont_booking_perf", "_supplier_committed_prod_rdy_perf", "_iss_transit_lead_time_perf",
        "_iss_custom_clear_perf", "_freight_unit_id", "_fo_id",
    )
    return f"""{tracked_sql()},
{FACTS_SQL}, {PLACES_SQL},
numbered as (
  select lit.*, avg_lead_time as _sup_lt, row_number() over (partition by _po_no_ekporef
    order by pid, _freight_unit_id, link_company, _shipped, _shipment_serial_iss_job nulls last, avg_lead_time nulls last) as rn
  from lit left join @supplier_lead_time on try_cast(supplier_id as int) = try_cast(_supplier_code as int)),
x as (
  select b.*, facts.*, {ENRICHED}, b._sup_lt as _supplier_lead_time, ctt.average_transit_time as _country_lead_time,
    case when serial is null then fe.shipping_terms else p_terms end as _incoterms_fo
  from numbered b {ENRICH_JOINS}
  left join @country_transit_time ctt on ctt.code = coalesce(p_ocountry, fe.origin_country)),
{scores_sql("x", False, "coalesce(_supplier_lead_time, 0) + coalesce(_country_lead_time, 0) + 15", True, "_full_eta", "_full_eta")},
{ROLLUP_SQL}, {MASTER_SQL},
shipped as (select {enriched} from s3),
master as (
  select case when regexp_matches(st, 'cancel', 'i') then 'Cancelled' when regexp_matches(st, 'close', 'i') then 'Closed'
      when regexp_matches(st, 'comple', 'i') then 'Completed' else 'Pending' end as _line_type,
    md5(_po_no_ekporef || '-' || cast(pid as varchar) || '-po remaining-' || cast(_line_no as varchar)) as _line_id, m.* exclude (pid, st, bal),
    bal as _balance_outer_qnty, {_pieces("bal")} as _balance_inner_qnty, {_pieces("1")} as _units_po_uom, {_pieces("_original_po_qty")} as _po_inner_qnty,
    case when regexp_matches(st, 'cancel', 'i') then 'Cancelled' when regexp_matches(st, 'close', 'i') then 'Closed'
      else array_to_string(list_transform(string_split(lower(st), ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ') end as _po_line_status,
    coalesce(_po_app_date - _pr_appr_date, 0) as _days_order_placement_lt,
    case when _po_app_date - _pr_appr_date <= 5 then 1.0 when _po_app_date - _pr_appr_date > 5 then 1 - (_po_app_date - _pr_appr_date) / 5.0 else 0.0 end
      as _ontime_order_placement_perf,
    {", ".join(f"0 as {z}" for z in zeros)}, 'Master' as _master_line, cast(null as date) as _final_expected_del_date, {ROLLED} as _06_expt_status
  from masters m left join flags on k1 = _po_no_ekporef and k2 = _line_no)
select * from shipped union all by name select * from master
"""
