"""Queries over purchase orders and freight."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import as_of_date, days_between, plus_days
from ..functions.payload import (
    container_counts as count_containers,
    equipment_items,
    equipment_text,
    event_date,
    listed,
    listed_distinct,
    named_count,
    named_value,
    parse_payload,
    ARRIVED,
    DEPARTED,
    CUSTOM_DATES,
    with_payload_dates,
)
from ..functions.rules import (
    doc_flag as flag_documents,
    final_delivery,
    pieces_of,
    sla_breach as breach,
    unit_pieces,
    volume_waterfall as waterfall,
)
from ..functions.text import surrogate_key
from ..operators.freight import (
    cargo_ready_estimates as ready_estimates,
    carrier_lookup,
    destination_place,
    distinct_links,
    inner_quantity_rows,
    inner_quantity_text,
    labelled_documents,
    origin_place,
    payload_arms,
    payload_defects as find_defects,
    places,
    resolve_payload,
)
from ..operators.grouping import attach_totals, lookup_table, text_list
from ..operators.money import charge_lists
from ..operators.orders import collapse_by_primary, light_rollup as roll_lights, number_lines, order_list_rows, remaining_quantity
from ..operators.ranking import list_rows
from ..plans.freight_orders import COLUMNS as FREIGHT_COLUMNS
from ..plans.freight_orders import FROM_PRIMARY, LARGEST, freight_order_view, freight_units, shipped_lines
from ..plans.po_lines import COLUMNS as LINE_COLUMNS
from ..plans.po_lines import lit_links, master_rows, order_lines, po_line_view, with_order_delivery
from ..plans.sla import country_sla as sla_by_country
from ..plans.sla import supplier_sla as sla_by_supplier
from ..plans.tracking import CHARGE_FX_DATE, CUSTOMS_FX_DATE
from ..sources.staging import staged
from . import freight_sql as twin
from .base import AS_OF, query
from .finance import CHARGES_SQL


def kinds(columns: list[str]) -> str:
    """Comparison spec of a report from its column names."""
    dates = {
        "_arrival_date", "_arrival_date_actual", "_del", "_departure_date", "_departure_date_actual", "_crd_actual", "_crd_estimated", "_crd",
        "_goods_cleared_origin", "_goods_cleared_destination", "_pickup_date", "_cargo_ho", "_eta", "_eta_simple", "_revised_eta", "_eta_wakeo",
        "_full_eta", "_etd", "_etd_simple", "_revised_etd", "_etd_wakeo", "_full_etd", "_pta", "_ptd", "_first_edd_po", "_current_edd_po",
        "_first_edd_fo", "_current_edd_fo", "_pr_date", "_pr_appr_date", "_po_app_date", "_po_creation_date", "_po_recd_date", "_po_need_by_date",
        "_est_cargo_ready_date", "_final_expected_del_date",
    }
    whole = {
        "_line_no", "_client_id", "_freight_unit_id", "_units_po_uom", "_20_ft", "_40_ft", "_count_of_cont", "_teus", "_fe_id", "_pid",
        "_supplier_lead_time", "_country_lead_time", "_actual_lead", "_days_total_comm_perf", "_avg_lt", "_rdd_eta", "_e2e_total_lt",
    }
    numbers = {"_original_po_qty", "_po_outer_qty", "_shipped", "_qnty_shipped_remaning", "_inner_qnty_shipped", "_po_inner_qnty",
               "_balance_outer_qnty", "_balance_inner_qnty", "_po_qty_ordered", "_remaining_quantity"}

    def kind(c: str) -> str:
        if c in dates:
            return "D"
        if c in whole or c.startswith("_days_") or "_2_" in c:
            return "l"
        if c in numbers or c.endswith("_perf") or "_charges_" in c or c.startswith(("_p2p_", "_total_", "_spo_inv", "_customs_inv")):
            return "n6"
        return "s"

    return " ".join(f"{kind(c)}:{c}" for c in columns)


# ------------------------------------------------------------------ whole reports


@query(kinds(FREIGHT_COLUMNS), twin.freight_orders_sql(FROM_PRIMARY, LARGEST, FREIGHT_COLUMNS))
def freight_order_report(t):
    return freight_order_view(t, as_of=AS_OF)


_LINE_KINDS = kinds(LINE_COLUMNS)
for _date in ("_pod_date", "_do_date", "_do_exp", "_invoice_issue_date", "_addl_invoice_issue_date"):
    _LINE_KINDS = _LINE_KINDS.replace(f"s:{_date}", f"D:{_date}")
for _number in ("_cbm", "_gw", "_chw", "_qnty"):
    _LINE_KINDS = _LINE_KINDS.replace(f"s:{_number} ", f"n6:{_number} ")
_LINE_KINDS = _LINE_KINDS.replace("s:_fo_id", "l:_fo_id")


@query(_LINE_KINDS, twin.po_lines_sql(LINE_COLUMNS))
def po_line_report(t):
    return po_line_view(t, as_of=AS_OF)


_SLA_PAYLOAD = "with " + twin.payload_sql("|")


@query(
    "s:serial_no,_shipment_serial_iss_job,_origin_country_code,_origin_country,_sla_status D:_crd_actual,_delivery_date "
    "l:_sla_country_lead_time,_actual_duration",
    _SLA_PAYLOAD + """,
m as (
  select u.serial_no, _shipment_serial_iss_job, p_ocountry as _origin_country_code, _crd_actual, _del as _delivery_date
  from @freight_unit u left join @purchase_order_on_freight_unit l on l.freight_unit_id = u.id
  join @purchase_order_company c on c.id = l.purchase_order_company_id left join pay on pu = u.unit_no and pd = c.iss_domain)
select m.*, iso_country_name as _origin_country, average_transit_time as _sla_country_lead_time, _delivery_date - _crd_actual as _actual_duration,
  max(case when _delivery_date - _crd_actual > average_transit_time then 'Breached SLA' else 'Within SLA' end) as _sla_status
from m left join @country_codes on iso_2_char_code = _origin_country_code left join @country_transit_time on code = _origin_country_code
where _delivery_date is not null group by 1, 2, 3, 4, 5, 6, 7
""",
)
def country_sla(t):
    return sla_by_country(t)


@query(
    "l:_po_id,_po_line_no,_supplier_sla_lt,_supplier_reaction_time,_supplier_lead_time_sla,_reaction_time_var "
    "s:_line_id,_po_no,_item_description,_po_uom,_item_code,_shipment_serial_iss_job,_reaction_sla_status D:_po_approval_date,_crd_actual",
    _SLA_PAYLOAD + """
select p.id as _po_id, md5(cast(p.id as varchar) || p.item_code || _shipment_serial_iss_job) as _line_id, po_line_num as _po_line_no, po_no as _po_no,
  po_desc as _item_description, po_uom as _po_uom, item_code as _item_code, po_app_dt as _po_approval_date, _crd_actual, avg_lead_time as _supplier_sla_lt,
  _shipment_serial_iss_job, _crd_actual - po_app_dt as _supplier_reaction_time, avg_lead_time as _supplier_lead_time_sla,
  _supplier_reaction_time - avg_lead_time as _reaction_time_var,
  case when _reaction_time_var > 0 then 'Breached SLA' else 'Within SLA' end as _reaction_sla_status
from @purchase_order_line p left join @supplier_lead_time s on cast(s.supplier_id as int) = cast(p.supplier_no as int)
left join @purchase_order_on_freight_unit l on l.purchase_order_id = p.id left join @freight_unit u on u.id = l.freight_unit_id
join @purchase_order_company c on c.id = l.purchase_order_company_id left join pay on pu = u.unit_no and pd = c.iss_domain
where _crd_actual is not null
""",
)
def supplier_sla(t):
    return sla_by_supplier(t)


# --------------------------------------------------------------- staged reports


def _shipped(t):
    return shipped_lines(t, freight_units(t, CHARGE_FX_DATE, CUSTOMS_FX_DATE), as_of_date(AS_OF))


_KEY = "l:_pid s:_fo_id,_shipment_serial_iss_job"


@query(
    f"{_KEY} D:_eta,_revised_eta,_full_eta,_etd,_revised_etd,_full_etd,_crd,_del,_goods_cleared_destination",
    twin.shipped_sql() + " select * from s3",
)
def date_waterfalls(t):
    return _shipped(t)


@query(
    f"{_KEY} " + kinds("""_days_order_placement_lt _days_supplier_production_lt _days_custom_clearance_lt _days_iss_cont_booking_lt _days_transit_lt
    _e2e_total_lt _days_delayed_eta _days_delayed_etd _etd_2_eta _eta_2_del _nbd_2_del _rdd_eta _crd_2_etd _po_2_crd _nbd_2_crd _nbd_2_eta""".split()),
    twin.shipped_sql() + " select * from s3",
)
def lead_times(t):
    return _shipped(t)


@query(f"{_KEY} l:_actual_lead,_days_total_comm_perf s:_health_check", twin.shipped_sql() + " select * from s3")
def health_bands(t):
    return _shipped(t)


_SCORES = "_ontime_order_placement_perf,_iss_cont_booking_perf,_supplier_committed_prod_rdy_perf,_iss_transit_lead_time_perf,_iss_custom_clear_perf,_e2e_total_lead_time_perf"


@query(f"{_KEY} n6:{_SCORES}", twin.shipped_sql() + " select * from s3")
def perf_scores(t):
    return _shipped(t)


@query(f"{_KEY} s:_status,_reason_code", twin.shipped_sql() + " select * from s3")
def status_machine(t):
    return _shipped(t)


def _tracked(t):
    return lit_links(t, order_lines(t), as_of_date(AS_OF))


_LINK = "l:__line,_line_no,_freight_unit_id n2:_shipped"
_LINK_SQL = twin.tracked_sql() + " select *, pid as __line from lit"


@query(f"{_LINK} D:_first_edd_fo,_current_edd_fo,_first_edd_po,_current_edd_po", _LINK_SQL)
def expected_delivery(t):
    # The order's dates are totals of the links, which are read twice.
    links = _tracked(t).select(
        "__line", "_line_no", "_freight_unit_id", "_shipped", "_first_edd_fo", "_current_edd_fo",
        "_po_no_ekporef", "_arrival_date", "_eta", "_eta_wakeo", "_eta_simple",
    )
    return with_order_delivery(staged(links, "dated-links"), as_of_date(AS_OF))


@query(f"{_LINK} s:{','.join(twin.STAGE_NAMES)}", _LINK_SQL)
def stage_lights(t):
    return _tracked(t)


@query(
    "s:_line_id,_po_no_ekporef,_06_expt_status l:_line_no n6:_balance_outer_qnty,_balance_inner_qnty",
    twin.tracked_sql() + f""", {twin.ROLLUP_SQL}, {twin.MASTER_SQL}
select md5(_po_no_ekporef || '-' || cast(pid as varchar) || '-po remaining-' || cast(_line_no as varchar)) as _line_id, _po_no_ekporef, _line_no,
  bal as _balance_outer_qnty, {twin._pieces("bal")} as _balance_inner_qnty, {twin.ROLLED} as _06_expt_status
from masters left join flags on k1 = _po_no_ekporef and k2 = _line_no
""",
)
def light_rollup(t):
    # What lights, balances and ids of a line read of it.
    lines = staged(
        order_lines(t).select(
            "__line", "_line_no", "_po_no_ekporef", "_po_need_by_date", "_client_id", "_original_po_qty", "_po_uom", "__status",
            "_pr_appr_date", "_po_app_date",
        ),
        "order-lines",
    )
    shipped = lit_links(t, lines, as_of_date(AS_OF))
    return roll_lights(master_rows(t, lines), shipped, ["_po_no_ekporef", "_line_no"], "_balance_outer_qnty", "_06_expt_status")


# ------------------------------------------------------------- payload operators


_PAYLOADS = "select unit_no, shipment_response as p from @freight_unit_enrich"


def _payloads(t):
    return t["freight_unit_enrich"].select("unit_no", parse_payload("shipment_response").alias("_p"))


@query(
    "s:unit_no,serial,service l:seen",
    "select unit_no, json_extract_string(shipment_response, '$.serial_no') as serial, "
    "case when serial is null then service else json_extract_string(shipment_response, '$.service') end as service, "
    "case when shipment_response is null then 0 else 1 end as seen from @freight_unit_enrich",
)
def json_payload(t):
    e = t["freight_unit_enrich"].select("unit_no", "service", "shipment_response", parse_payload("shipment_response").alias("_p"))
    return e.select(
        "unit_no", F.col("_p.serial_no").alias("serial"),
        F.when(F.col("_p.serial_no").isNull(), F.col("service")).otherwise(F.col("_p.service")).alias("service"),
        F.col("shipment_response").isNotNull().cast("int").alias("seen"),
    )


@query(
    "l:event_id,k",
    "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events",
)
def json_event_key(t):
    return t["events"].select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


_CD = """from_json(json_extract(p, '$.custom_dates'), '[{"name":"VARCHAR","value":"VARCHAR"}]')"""


@query(
    "s:unit_no D:" + ",".join(CUSTOM_DATES) + " l:duplicates",
    f"with r as (select unit_no, {_CD} as cd from ({_PAYLOADS}) x) select unit_no, "
    + ", ".join(f"try_cast({twin._named(label)} as date) as {name}" for name, label in CUSTOM_DATES.items())
    + ", len(list_filter(cd, lambda x: x.name = 'POD Date')) as duplicates from r",
)
def json_named_pick(t):
    return _payloads(t).select(
        "unit_no",
        *[named_value("_p.custom_dates", label).try_cast("date").alias(name) for name, label in CUSTOM_DATES.items()],
        named_count("_p.custom_dates", "POD Date").alias("duplicates"),
    )


@query(
    "s:unit_no D:departed,arrived",
    f"""with r as (select unit_no, from_json(json_extract(p, '$.status_updates'), '[{{"status":"VARCHAR","date":"VARCHAR"}}]') as su from ({_PAYLOADS}) x)
select unit_no, {twin._event(*DEPARTED)} as departed, {twin._event(*ARRIVED)} as arrived from r""",
)
def json_min_event(t):
    return _payloads(t).select(
        "unit_no", event_date("_p.status_updates", DEPARTED).alias("departed"), event_date("_p.status_updates", ARRIVED).alias("arrived")
    )


@query(
    "s:pu,pd,_container_no,_pack_type,equipment,bare l:_20_ft,_40_ft,_count_of_cont,_teus",
    "with " + twin.payload_sql(" | ") + """ select *, eq_text as equipment, replace(eq_text, '"', '') as bare from pay where pd is not null""",
)
def container_counts(t):
    arms = payload_arms(t["freight_unit_enrich"]).select(
        F.col("unit_no").alias("pu"), F.col("domain").alias("pd"), parse_payload("payload").alias("_p")
    )
    arms = arms.withColumn("items", equipment_items("_p.equipment"))
    return arms.withColumns(
        {
            **count_containers("items"),
            "equipment": equipment_text("items"),
            "bare": equipment_text("items", keep_quotes=False),
            "_container_no": listed("_p.equipment_details", "equipment_no", " | "),
            "_pack_type": listed_distinct("_p.cargo", "package_type", ", "),
        }
    )


@query(
    "l:id s:unit_no,serial D:_full_eta",
    "with " + twin.payload_sql("|") + """
select u.id, u.unit_no, _shipment_serial_iss_job as serial, _full_eta from @freight_unit u
left join pay on pu = u.unit_no and pd = 'd' || cast(cast(floor(u.id / 100) as bigint) % 25 as varchar)
""",
)
def domain_payload(t):
    units = t["freight_unit"].select("id", "unit_no", F.concat(F.lit("d"), (F.floor(F.col("id") / 100) % 25).cast("string")).alias("dom"))
    rows = resolve_payload(units, t["freight_unit_enrich"], "unit_no", "dom")
    rows = with_payload_dates(rows.withColumn("_p", parse_payload("_payload")))
    return rows.withColumn("serial", F.col("_p.serial_no"))


_PLACE_SPEC = (
    "s:unit_no,_origin_port_pol,_origin_port_name,_origin_country,_origin_region_org_reg,_destination_port_code_dest,"
    "_destination_port_name_dest,_destination_country_code_dest,_destination_country_dest,_destination_region_reg"
)


@query(
    _PLACE_SPEC,
    "with " + twin.PLACES_SQL + f""",
fe as (select *, json_extract_string(shipment_response, '$.serial_no') as _shipment_serial_iss_job, json_extract_string(shipment_response, '$.origin_port') as p_oport,
  json_extract_string(shipment_response, '$.destination_port') as p_dport, json_extract_string(shipment_response, '$.destination_country') as p_dcountry
  from @freight_unit_enrich)
select fe.unit_no, _shipment_serial_iss_job as serial, split_part(fe.service, '_', 1) as mode, {twin.ENRICHED[twin.ENRICHED.index("case when serial is null then fe.origin_port"):]}
from fe {twin._place_joins()}
""",
)
def port_lookup(t):
    e = t["freight_unit_enrich"].withColumn("_p", parse_payload("shipment_response")).withColumns(
        {"serial": F.col("_p.serial_no"), "po": F.col("_p.origin_port"), "pd": F.col("_p.destination_port"), "pc": F.col("_p.destination_country")}
    ).drop("_p")
    dim = places(t["ports"], t["airports"], t["port_codes"])
    e = origin_place(e, dim, "service", "serial", "origin_port", "po")
    return destination_place(
        e, dim, t["country_codes"], "service", "serial", "shipment_serial_no", "destination_port", "pd", "destination_country", "pc"
    )


@query(
    "s:unit_no,code,_carrier",
    "select unit_no, json_extract_string(remote_shipment_response, '$.carrier') as code, _carrier from @freight_unit_enrich "
    "left join (select name as _carrier, unnest(all_scacs) as scac from @carrier_shipping) c on scac = json_extract_string(remote_shipment_response, '$.carrier')",
)
def carrier_alias(t):
    e = t["freight_unit_enrich"].select("unit_no", F.get_json_object("remote_shipment_response", "$.carrier").alias("code"))
    return carrier_lookup(e, t["carrier_shipping"], "code")


@query(
    "s:serial_no D:_est_cargo_ready_date",
    """
select json_extract_string(shipment_details, '$.serial_no') as serial_no, try_cast(max(e.date) as date) as _est_cargo_ready_date
from (select shipment_details, unnest(from_json(statuses, '[{"status":"VARCHAR","date":"VARCHAR"}]')) as e from @shipment_details) x
where e.status = 'Estimated Cargo Date' group by 1
""",
)
def cargo_ready_estimates(t):
    return ready_estimates(t["shipment_details"])


# --------------------------------------------------------------- order operators


@query(
    "l:l_orderkey,l_linenumber,l_partkey n5:_analytical_volume s:_analytical_units,_analytical_volume_type",
    """
select l_orderkey, l_linenumber, l_partkey, coalesce(nullif(l_tax, 0), nullif(l_discount, 0), case when l_quantity > 25 then l_quantity end, 0) as _analytical_volume,
  case when l_tax <> 0 then 'TAX' when l_discount <> 0 then 'DISC' when l_quantity > 25 then 'PCS' else 'NA' end as _analytical_units,
  case when l_tax <> 0 then 'Tax rate' when l_discount <> 0 then 'Discount' when l_quantity > 25 then 'Pieces' else 'NA' end as _analytical_volume_type
from lineitem
""",
)
def volume_waterfall(t):
    rows = t["lineitem"].withColumns(
        {
            "tax": F.nullif("l_tax", F.lit(0.0)),
            "disc": F.nullif("l_discount", F.lit(0.0)),
            "pcs": F.when(F.col("l_quantity") > 25, F.col("l_quantity")),
        }
    )
    measures = (("tax", "TAX", "Tax rate"), ("disc", "DISC", "Discount"), ("pcs", "PCS", "Pieces"))
    return rows.withColumns(waterfall(measures))


@query(
    "l:purchase_order_id,freight_unit_id,purchase_order_company_id",
    "select distinct purchase_order_id, freight_unit_id, purchase_order_company_id from @purchase_order_on_freight_unit",
)
def bridge_dedupe(t):
    return distinct_links(t["purchase_order_on_freight_unit"])


@query(
    "l:o_orderkey s:o_orderstatus",
    "select o_orderkey, o_orderstatus from orders where exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity > 45)",
)
def semi_exists(t):
    big = t["lineitem"].where(F.col("l_quantity") > 45).select("l_orderkey")
    return t["orders"].join(big, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")


@query(
    "l:l_orderkey,l_partkey,l_suppkey,parts s:flag,flags,others D:shipped,latest n2:price,most",
    """
with r as (select *, 'F' || cast(l_linenumber as varchar) as part, row_number() over (partition by l_orderkey order by case when l_partkey % 9 = 0 then null else
  cast(l_shipdate as date) end nulls last, l_partkey, l_suppkey, l_linenumber) as rn from lineitem)
select l_orderkey, max(l_partkey) filter (where rn = 1) as l_partkey, max(l_suppkey) filter (where rn = 1) as l_suppkey,
  max(l_returnflag) filter (where rn = 1) as flag, max(case when l_partkey % 9 = 0 then null else cast(l_shipdate as date) end) filter (where rn = 1) as shipped,
  max(cast(l_shipdate as date)) as latest, max(l_extendedprice) filter (where rn = 1) as price, max(l_extendedprice) as most,
  max(l_partkey) + max(l_suppkey) as parts, string_agg(distinct l_returnflag, ' | ' order by l_returnflag) as flags,
  string_agg(distinct part, ' | ' order by part) filter (where rn <> 1) as others
from r group by 1
""",
)
def collapse_primary(t):
    rows = t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_returnflag").alias("flag"), F.col("l_returnflag").alias("flags"),
        F.when(F.col("l_partkey") % 9 != 0, F.col("l_shipdate").cast("date")).alias("shipped"),
        F.col("l_shipdate").cast("date").alias("latest"), F.col("l_extendedprice").alias("price"),
        F.concat(F.lit("F"), F.col("l_linenumber").cast("string")).alias("part"),
    )
    out = collapse_by_primary(
        rows, "l_orderkey", "part", ["shipped", "l_partkey", "l_suppkey", "l_linenumber"],
        ["l_partkey", "l_suppkey", "flag", "shipped", "price"],
        {"latest": F.max("latest"), "most": F.max("price"), "p": F.max("l_partkey"), "s": F.max("l_suppkey")}, ["flags"], "others",
    )
    return out.withColumn("parts", F.col("p") + F.col("s"))


@query(
    "l:id,units s:po_no n2:ordered,shipped_quantity,remaining_quantity,pieces",
    """
with u as (select purchase_order_id, sum(quantity) as q from @purchase_order_on_freight_unit group by 1)
select p.id, po_no, try_cast(po_qty_ordered as double) as ordered, coalesce(q, 0) as shipped_quantity, coalesce(ordered, 0) - coalesce(q, 0) as remaining_quantity,
  case po_uom when 'EACH' then 1 when 'CASE OF 6' then 6 when 'CASE OF 12' then 12 when 'CASE OF 24' then 24 else 0 end as units, units * remaining_quantity as pieces
from @purchase_order_line p left join u on purchase_order_id = p.id where remaining_quantity > 0
""",
)
def remaining_qty(t):
    lines = t["purchase_order_line"].withColumn("ordered", F.col("po_qty_ordered").try_cast("double"))
    rows = remaining_quantity(lines, t["purchase_order_on_freight_unit"], ordered="ordered")
    return rows.withColumns({"units": unit_pieces("po_uom"), "pieces": pieces_of("remaining_quantity", "po_uom")})


@query(
    "l:freight_unit s:_inner_qty",
    "with " + twin.INNER_SQL + " select qf as freight_unit, _inner_qty from inner_qty",
)
def inner_qty_text(t):
    return inner_quantity_text(t["purchase_order_on_freight_unit"], t["purchase_order_line"]).withColumnRenamed("__fu", "freight_unit")


@query(
    "l:o_orderkey s:flag",
    """
select o.o_orderkey, case when s.id is not null then case when n is not null then 'Yes' else 'No' end end as flag
from orders o left join (select id from @shipments_ops where id % 4 <> 0) s on s.id = o.o_orderkey
left join (select parent_id, count(*) as n from @attachments where label = 'AGI' and uploaded = 1 group by 1) a on parent_id = s.id
""",
)
def doc_flag(t):
    known = t["shipments_ops"].where(F.col("id") % 4 != 0).select(F.col("id").alias("ship"))
    docs = labelled_documents(t["attachments"], "AGI", "docs")
    rows = t["orders"].select("o_orderkey").join(known, F.col("o_orderkey") == F.col("ship"), "left")
    rows = rows.join(docs, F.col("ship") == F.col("__parent"), "left")
    return rows.withColumn("flag", flag_documents("ship", "docs"))


@query(
    "l:nation,orders,target,total s:status",
    """
with d as (select s_nationkey as nation, l_orderkey, cast(l_shipdate as date) - cast(o_orderdate as date) as days
  from lineitem join orders on o_orderkey = l_orderkey join supplier on s_suppkey = l_suppkey),
a as (select nation as n, cast(floor(avg(days)) as bigint) as target from d group by 1),
l as (select nation, l_orderkey, target, max(case when days > target then 'Breached SLA' else 'Within SLA' end) as status from d join a on n = nation group by 1, 2, 3)
select nation, target, status, count(distinct l_orderkey) as orders, count(*) as total from l group by 1, 2, 3
""",
)
def sla_breach(t):
    days = (
        t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
        .select(F.col("s_nationkey").alias("nation"), "l_orderkey", days_between(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")).alias("days"))
    )
    days = attach_totals(days, ["nation"], {"target": F.floor(F.avg("days"))})
    labelled = days.groupBy("nation", "l_orderkey", "target").agg(F.max(breach("days", "target")).alias("status"))
    return labelled.groupBy("nation", "target", "status").agg(F.count("*").alias("orders"), F.count("*").alias("total"))


@query(
    "l:o_orderkey D:due,final",
    """
select o_orderkey, cast(o_orderdate as date) + 3 as due, case when t in ('Pending', 'Closed', 'Completed') and a = b then due end as final
from (select *, case o_orderstatus when 'F' then 'Closed' when 'O' then 'Pending' else 'Enriched' end as t, o_orderkey % 3 as a,
  case when o_orderkey % 7 = 0 then null else o_orderkey % 5 end as b from orders) x
""",
)
def master_date(t):
    rows = t["orders"].withColumns(
        {
            "line": F.expr("case o_orderstatus when 'F' then 'Closed' when 'O' then 'Pending' else 'Enriched' end"),
            "ordered": F.col("o_orderkey") % 3,
            "shipped": F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey") % 5),
            "due": plus_days(F.col("o_orderdate").cast("date"), 3),
        }
    )
    return rows.withColumn("final", final_delivery("line", "ordered", "shipped", "due"))


@query(
    "l:id,n s:po_no,key",
    """
select id, po_no, row_number() over (partition by po_no order by id) as n, md5(po_no || '-' || cast(id as varchar) || '-line-' || cast(n as varchar)) as key
from @purchase_order_line
""",
)
def line_hash(t):
    rows = number_lines(t["purchase_order_line"], name="n")
    return rows.withColumn("key", surrogate_key("po_no", F.lit("-"), "id", F.lit("-line-"), "n"))


@query(
    "s:c_mktsegment,nations,balances l:biggest",
    """
with c as (select distinct c_mktsegment, 'N' || cast(c_nationkey as varchar) as n from customer)
select c.c_mktsegment, string_agg(n, ' | ' order by n) as nations, max(s) as balances, max(b) as biggest
from c join (select c_mktsegment as k, string_agg(case when c_acctbal < -900 then cast(cast(floor(c_acctbal / 10) as bigint) as varchar) end, ', '
  order by cast(cast(floor(c_acctbal / 10) as bigint) as varchar)) as s, min(c_custkey) as b from customer group by 1) t on k = c.c_mktsegment group by 1
""",
)
def text_lists(t):
    c = t["customer"].withColumns(
        {
            "n": F.concat(F.lit("N"), F.col("c_nationkey").cast("string")),
            "low": F.when(F.col("c_acctbal") < -900, F.floor(F.col("c_acctbal") / 10).cast("string")),
        }
    )
    nations = text_list(c, ["c_mktsegment"], "n", " | ", "nations", distinct=True)
    balances = text_list(c, ["c_mktsegment"], "low", ", ", "balances").withColumnRenamed("c_mktsegment", "k")
    first = lookup_table(c, "c_mktsegment", ["c_custkey"]).select(F.col("c_mktsegment").alias("k2"), F.col("c_custkey").alias("biggest"))
    return nations.join(balances, F.col("c_mktsegment") == F.col("k"), "left").join(first, F.col("c_mktsegment") == F.col("k2"), "left")



def _placed(rows: str, keys: str) -> str:
    """Child rows (keys, value, times) with the position where each value begins."""
    return f"""select *, 1 + coalesce(sum(times) over (partition by {keys} order by value rows between unbounded preceding and 1 preceding), 0) as position
  from ({rows}) counted"""


@query(
    "s:c_mktsegment,value l:position,times",
    _placed("""select c_mktsegment, cast(cast(floor(c_acctbal / 100) as bigint) as varchar) as value, count(*) as times from customer
  where c_acctbal is not null group by all""", "c_mktsegment"),
)
def text_list_rows(t):
    rows = t["customer"].withColumn("value", F.floor(F.col("c_acctbal") / 100).cast("string"))
    return list_rows(rows, ["c_mktsegment"], "value")


@query(
    "l:_ship_id,position,times s:list,value",
    "with " + CHARGES_SQL + """, lines as (
  select ship as _ship_id, unnest([
    {'list': '_aux_charge_type', 'value': case when category = 'Ancillary Charge' then info end},
    {'list': '_issued_invoices', 'value': case when category <> 'Ancillary Charge' then inv end},
    {'list': '_issue_date', 'value': case when category <> 'Ancillary Charge' then mon end},
    {'list': '_addl_issued_invoices', 'value': case when category = 'Ancillary Charge' then inv end},
    {'list': '_addl_issue_date', 'value': case when category = 'Ancillary Charge' then mon end}], recursive := true)
  from sorted_items)
""" + _placed("select _ship_id, list, value, count(*) as times from lines where value is not null group by all", "_ship_id, list"),
)
def charge_list_rows(t):
    return charge_lists(
        t["shipments_ops"], t["cost_revenue_items"], t["charge_service_mapping"], t["issued_invoices"],
        t["snapshot_rates"], t["domain_currency"], t["freight_unit"],
    )


@query(
    "l:freight_unit_id,position,times s:value",
    _placed("""select freight_unit_id, po_no || ' - ' || item_code || ' - ' || cast(quantity as varchar) as value, count(*) as times
  from @purchase_order_on_freight_unit join @purchase_order_line on id = purchase_order_id
  where po_no is not null and item_code is not null and quantity is not null group by all""", "freight_unit_id"),
)
def inner_qty_rows(t):
    return inner_quantity_rows(t["purchase_order_on_freight_unit"], t["purchase_order_line"])


_ORDER_RANK = """row_number() over (partition by l_orderkey order by case when l_partkey % 9 = 0 then null else cast(l_shipdate as date) end nulls last,
    l_partkey, l_suppkey, l_linenumber)"""


@query(
    "l:l_orderkey,position s:list,value",
    f"""
with r as (select l_orderkey, l_returnflag, l_linestatus, 'F' || cast(l_linenumber as varchar) as part, {_ORDER_RANK} as rn from lineitem),
lists as (
  select l_orderkey, 'others' as list, part as value from r where rn <> 1
  union select l_orderkey, 'l_returnflag', l_returnflag from r
  union select l_orderkey, 'l_linestatus', l_linestatus from r)
select l_orderkey, list, value, row_number() over (partition by l_orderkey, list order by value) as position from lists where value is not null
""",
)
def order_list_children(t):
    rows = t["lineitem"].withColumns(
        {
            "part": F.concat(F.lit("F"), F.col("l_linenumber").cast("string")),
            "shipped": F.when(F.col("l_partkey") % 9 != 0, F.col("l_shipdate").cast("date")),
        }
    )
    order = ["shipped", "l_partkey", "l_suppkey", "l_linenumber"]
    return order_list_rows(rows, "l_orderkey", "part", order, ["l_returnflag", "l_linestatus"], "others")


_ALL_NAMES = ", ".join(f"'{label}'" for label in CUSTOM_DATES.values())


@query(
    "s:unit_no,side,state l:repeated",
    f"""
with sides as (
  select unit_no, 'own' as side, case when id % 130 = 0 then left(shipment_response, length(shipment_response) - 7) else shipment_response end as p
  from @freight_unit_enrich
  union all select unit_no, 'remote', remote_shipment_response from @freight_unit_enrich),
sound as (select *, case when json_valid(p) then p end as j from sides),
dates as (select *, from_json(json_extract(j, '$.custom_dates'), '[{{"name":"VARCHAR","value":"VARCHAR"}}]') as cd from sound)
select unit_no, side, case when coalesce(trim(p), '') = '' then 'absent' when j is null then 'damaged'
    when json_extract_string(j, '$.serial_no') is null then 'unnamed' else 'named' end as state,
  coalesce(list_sum(list_transform([{_ALL_NAMES}], lambda n: greatest(len(list_filter(cd, lambda x: x.name = n)) - 1, 0))), 0) as repeated
from dates
""",
)
def payload_defects(t):
    # Some texts are cut short, as a broken transfer would leave them.
    short = F.expr("left(shipment_response, length(shipment_response) - 7)")
    damaged = F.when(F.col("id") % 130 == 0, short).otherwise(F.col("shipment_response"))
    return find_defects(t["freight_unit_enrich"].withColumn("shipment_response", damaged))
