"""Report input tables derived from the test tables.

Each table is one SELECT over the test tables (written ``@orders``, ``@lineitem``,
...) or over another derived table, in SQL that both engines read alike. Spark
runs it through temporary views, the twin query through common table
expressions, so both sides start from the same rows.
"""

from __future__ import annotations


def _pair(name: str, expr: str) -> str:
    """JSON member that is left out where the expression is NULL."""
    return f"""case when {expr} is null then '' else ',"{name}":"' || cast({expr} as string) || '"' end"""


def _object(first: str, first_expr: str, members: dict[str, str], tail: str = "''") -> str:
    body = " || ".join(_pair(n, e) for n, e in members.items())
    return f"""'{{"{first}":"' || {first_expr} || '"' || {body} || {tail} || '}}'"""


def _named(name: str, expr: str) -> str:
    return f"""case when {expr} is null then '' else ',{{"name":"{name}","value":"' || cast({expr} as string) || '"}}' end"""


# A unit gathers a supplier's lines of one month; its dates hang on the first ship day.
_UNIT_BASE = """
select id, l_suppkey as supp, top_order, base_day, id % 25 as nk,
  base_day + cast(20 + id % 30 as int) as eta0,
  case when id % 5 = 0 then null else base_day + cast(18 + id % 33 as int) end as eta_live0,
  case when id % 7 = 0 then base_day + cast(22 + id % 9 as int) end as pta0,
  case when id % 6 = 0 then null else base_day + cast(id % 11 as int) end as etd_live0,
  case when id % 8 = 0 then base_day + cast(id % 5 as int) end as ptd0,
  case when id % 3 = 0 then null else base_day + cast(24 + id % 45 as int) end as del0,
  case when id % 4 = 1 then base_day + cast(-(id % 14) as int) end as crd_a,
  case when id % 3 = 1 then base_day + cast(-(id % 9) as int) end as crd_e
from (select l_suppkey * 100 + (year(l_shipdate) - 1995) * 12 + month(l_shipdate) as id, l_suppkey,
        max(l_orderkey) as top_order, min(cast(l_shipdate as date)) as base_day
      from @lineitem group by 1, 2) g
"""

_PAYLOAD_FIELDS = {
    "id": "id * 3",
    "service": "case id % 4 when 1 then 'sea_inbound' when 2 then 'air_outbound' else 'land_inbound' end",
    "shipping_terms": "case when id % 2 = 0 then 'FOB' else 'CIF' end",
    "house_no": "'H' || cast(id as string)",
    "master_no": "case when id % 3 = 0 then null else 'M' || cast(id % 500 as string) end",
    "master_spo_no": "case when id % 5 = 2 then 'SPO' || cast(id as string) end",
    "carrier": "'CA' || cast(id % 9 as string)",
    "operational_status": "case when id % 29 = 0 then 'ops_Cancelled' else 'ops_open' end",
    "origin_port": "'P' || cast(id % 30 as string)",
    "destination_port": "'P' || cast((id + 7) % 33 as string)",
    "origin_country": "case when id % 13 = 0 then null else 'N' || cast(id % 25 as string) end",
    "destination_country": "'N' || cast((id + 3) % 27 as string)",
    "arrival_date": "case when id % 4 = 2 then eta0 + 1 end",
    "loading_date": "case when id % 3 = 2 then base_day + 1 end",
    "delivery_date": "del0",
    "pickup_date": "case when id % 2 = 1 then base_day + -2 end",
    "pta_date": "pta0",
    "ptd_date": "ptd0",
    "eta_date": "case when id % 17 = 0 then null else eta0 end",
    "etd_date": "case when id % 16 = 0 then null else base_day end",
    "eta_wakeo_date": "eta_live0",
    "etd_wakeo_date": "etd_live0",
    "gross_volume": "id % 60",
    "gross_weight": "id % 9000",
    "chargeable_weight": "id % 7000",
    "package_count": "id % 40",
}

_ARRAYS = (
    """',"equipment":["' || cast(1 + id % 3 as string) || ' x 20 ft dry", "' || cast(1 + id % 2 as string) || ' x 40 ft high"' """
    """ || case when id % 6 = 0 then ', "loose cargo"]' else ']' end"""
    """ || ',"equipment_details":[{"equipment_no":"EQ' || cast(id as string) || '"},{"equipment_no":"EQ' || cast(id % 7 as string) || '"}]'"""
    """ || case when id % 9 = 0 then ',"cargo":[]' else ',"cargo":[{"package_type":"PALLET"},{"package_type":"BOX"},{"package_type":"PALLET"}]' end"""
    """ || ',"custom_dates":[{"name":"Other","value":"x"}' || """
    + " || ".join(
        [
            _named("Cargo Ready Date Actual", "crd_a"),
            _named("Cargo Ready Date Estimated", "crd_e"),
            _named("Goods Cleared at Origin Customs", "case when id % 6 = 1 then base_day + 1 end"),
            _named("Goods Cleared at Destination Customs", "case when id % 6 = 2 then eta0 + 2 end"),
            _named("POD Date", "case when id % 10 = 3 then eta0 + 5 end"),
            _named("D/O Date", "case when id % 10 = 4 then eta0 + 3 end"),
            _named("D/O Expiry Date", "case when id % 10 = 4 then eta0 + 13 end"),
        ]
    )
    + """ || ']' || ',"status_updates":[{"status":"Booked","date":"1990-01-01"}'"""
    """ || case when id % 3 = 0 then ',{"status":"Vessel Departure confirmed","date":"' || cast(base_day + 2 as string) || '"},{"status":"Actual time of departure","date":"' || cast(base_day + 1 as string) || '"}' else '' end"""
    """ || case when id % 5 = 0 then ',{"status":"Vessel arrival","date":"' || cast(eta0 + 2 as string) || '"}' else '' end || ']'"""
)

_OWN = _object("x", "'1'", {"serial_no": "case when id % 4 = 0 then null else 'SH' || cast(top_order as string) end", **_PAYLOAD_FIELDS}, _ARRAYS)
_REMOTE = _object("x", "'2'", {"serial_no": "'SH' || cast(top_order - top_order % 3 as string)", **_PAYLOAD_FIELDS}, _ARRAYS)


def _transactions(account: str, kind: str) -> str:
    """One ledger side: a document per order, its rows by line number."""
    return f"""
select
  case when mirrored then co else ac end as {account},
  case when mirrored then ac else co end as company,
  case when l_orderkey % 13 = 0 then null
       when l_linenumber = 6 then co || '-CN-' || cast(l_orderkey as string)
       when l_orderkey % 3 = 0 then co || '-FTI-' || cast(l_orderkey as string)
       else co || '-INV-' || cast(l_orderkey as string) end as invoice,
  case when l_linenumber = 3 and l_orderkey % 2 = 0 then 'xLog' || cast(l_orderkey as string)
       when l_linenumber = 2 and l_orderkey % 13 = 0 then null
       else 'VCH' || cast(l_orderkey as string) end as voucher,
  case when l_orderkey % 9 = 0 then null else l_shipdate end as voucher_date,
  l_shipdate + interval '36' hour as posted_date,
  case when l_linenumber in (1, 2, 6, 7) then '{kind}' when l_linenumber = 3 then 'General Journal' else 'Settlement' end
    as transaction_type,
  case when l_returnflag = 'R' or l_linenumber = 6 then -l_extendedprice else l_extendedprice end as amount,
  case when l_suppkey % 2 = 0 then 'AED' else 'USD' end as currency,
  l_tax * 100 as settled_amount,
  case when l_linenumber = 6 then 'VCH' || cast(l_orderkey as string) end as last_settlement_voucher
from (select *,
        case when l_orderkey % 10 = 9 then 'EXT' || cast(l_orderkey as string) else 'E' || cast(l_orderkey % 8 as string) end as ac,
        'E' || cast((l_orderkey + 1) % 8 as string) as co, l_linenumber = 7 and l_orderkey % 10 <> 9 as mirrored
      from @lineitem) t
"""


# Id of a line. An order may list a line number several times: the other keys are mixed into 24 bits below the number, so
# ids stay inside a bigint for order keys up to 10^10.
_LINE_ID = (
    "((l_orderkey * 8 + l_linenumber) * 16777216"
    " + (l_partkey * 7919 + l_suppkey * 104729 + (year(l_shipdate) * 372 + month(l_shipdate) * 31 + day(l_shipdate)) * 613) % 16777213)"
)

DERIVED: dict[str, str] = {
    # ---- sales
    "shipments_fact": """
select o_orderkey as id, 'SH' || cast(o_orderkey as string) as serial_no,
  case when o_orderkey % 31 = 0 then null else o_orderdate end as operational_date,
  case o_orderkey % 4 when 0 then 'sea_inbound' when 1 then 'air_outbound' when 2 then 'land_inbound' else 'ltl' end as service,
  case when o_orderkey % 5 = 0 then null else n_name end as origin,
  case when o_orderkey % 7 = 0 then null else 'PORT' || cast(o_orderkey % 40 as string) end as destination,
  case when o_orderkey % 6 = 0 then null else lower(c_mktsegment) end as line_of_business,
  case when o_orderkey % 8 = 0 then null else lower(o_orderpriority) end as shipment_type,
  'd' || cast(c_nationkey as string) as iss_domain, lower(n_name) as area_name,
  case when c_custkey % 3 = 0 then ' ' || lower(c_name) || ' ' else c_name end as crm_client,
  c_custkey as crm_contact_id, 'fin_' || lower(o_orderstatus) as financial_status,
  'ops_' || lower(o_orderstatus) as operational_status,
  case when o_orderkey % 15 = 0 then null else 'seller  ' || cast(c_custkey % 17 as string) end as sales_user,
  case when o_orderkey % 4 = 0 then null else ' doc ' || cast(c_custkey % 5 as string) end as documentation_user,
  case when o_orderkey % 10 = 0 then null else 'op ' || cast(c_custkey % 6 as string) || ' ' end as operations_user,
  ' mgr ' || cast((c_custkey + o_orderkey % 2) % 5 as string) as account_manager,
  'https://ship.example.com/' || cast(o_orderkey as string) as url_to_shipment,
  o_totalprice as expected_revenue_usd, o_totalprice * 0.25 as expected_profit_usd,
  o_totalprice * 4 as expected_revenue_local, cast(null as double) as expected_profit_local,
  o_totalprice * 2 as dax_revenue_local, o_totalprice * 0.5 as dax_gp_local,
  case when o_orderkey % 9 = 0 then null else o_totalprice end as dax_revenue_usd, o_totalprice * 0.125 as dax_gp_usd,
  case when o_orderkey % 9 = 1 then o_totalprice * 0.5 end as chargeable_weight_air,
  case when o_orderkey % 9 in (1, 2) then o_totalprice * 0.25 end as chargeable_weight_ltl,
  case when o_orderkey % 9 in (2, 3) then cast(o_orderkey % 20 as double) end as trucks_ftl,
  case when o_orderkey % 9 in (3, 4) then cast(o_orderkey % 12 as double) end as teu_fcl,
  case when o_orderkey % 9 in (4, 5, 6) then cast(o_orderkey % 30 as double) end as cbm_lcl,
  case when o_orderkey % 9 = 7 then cast(o_orderkey % 50 as double) end as cbm_projects
from @orders join @customer on o_custkey = c_custkey join @nation on c_nationkey = n_nationkey
""",
    "contacts": """
select c_custkey as id, case when c_custkey % 7 = 0 then ' ' || lower(c_name) else c_name end as name,
  case when c_custkey % 9 = 0 then null else ' mgr ' || cast(c_custkey % 5 as string) end as account_manager_name,
  'd' || cast(c_nationkey as string) as iss_domain, ' acc' || cast(c_custkey as string) || ' ' as customer_accounting_id,
  case when c_custkey % 4 = 0 then null else ' t' || cast(c_custkey as string) end as tax_id
from @customer where c_custkey % 11 <> 0
""",
    "journal": """
select l_shipdate as accountingdate, 'SH' || cast(l_orderkey as string) as jobmaster,
  case when l_returnflag = 'R' then 'cost' else 'revenue' end as name,
  cast(case l_linenumber when 1 then 30000 when 2 then 30001 when 3 then 40000 when 4 then 41003 when 5 then 30017
    else 55555 end as int) as mainaccount,
  case l_suppkey % 3 when 0 then 'AED' when 1 then 'EUR' else 'USD' end as accountingcurrency,
  case when l_partkey % 12 = 0 then null else cast(l_extendedprice as decimal(18,2)) end as accountingcurrencyamount_inv,
  cast(cast(l_extendedprice as decimal(18,2)) * cast(0.25 as decimal(4,2)) as decimal(18,4)) as reportingcurrencyamount_inv
from @lineitem
""",
    "fx_daily": """
select distinct case l_suppkey % 3 when 0 then 'AED' when 1 then 'EUR' else 'USD' end as fromcurrency, 'USD' as tocurrency,
  l_shipdate as startdate,
  cast(case l_suppkey % 3 when 0 then 0.25 when 1 then 1.125 else 1.0 end as decimal(9,4)) as exrate
from @lineitem where not (l_suppkey % 3 = 1 and day(l_shipdate) = 10)
""",
    "account_manager_changes": """
select o_custkey as contact_id, case when o_orderkey % 4 = 0 then ' ' else '' end || 'mgr ' || cast(o_orderkey % 6 as string)
    as new_account_manager,
  o_orderdate + interval '1' hour * cast(o_orderkey % 24 as int) as changed_at
from @orders where o_orderkey % 6 < 2
""",
    "budget_sales": """
select 'seller  ' || cast(n_nationkey as string) as sales_user from @nation where n_nationkey % 2 = 0
union all select ' mgr ' || cast(n_nationkey as string) || ' ' from @nation where n_nationkey in (1, 3)
union all select 'mgr ' || cast(n_nationkey as string) from @nation where n_nationkey in (1, 4)
union all select 'Seller  4' from @region
""",
    "crm_users": """
select case when n_nationkey % 3 = 0 then ' seller  ' else 'seller  ' end || cast(n_nationkey as string) as name,
  'user' || cast(n_nationkey as string) || '@mail.example' as email, 'd' || cast(n_nationkey as string) as iss_domain,
  cast(case when n_nationkey % 5 = 0 then 0 else 1 end as int) as active
from @nation
union all
select 'mgr ' || cast(n_regionkey as string), 'alt' || cast(n_nationkey as string) || '@mail.example', 'd0', cast(1 as int)
from @nation
""",
    "sales_global_entitlement": "select lower(r_name) as name, upper(r_name) || '@ALL.EXAMPLE' as email from @region",
    "login_local_entitlement": "select case when n_nationkey % 2 = 0 then 'USER' else 'GUEST' end || cast(n_nationkey as string) || '@mail.example' as email from @nation",
    "domain_catalog": "select 'd' || cast(n_nationkey as string) as iss_domain from @nation",
    # ---- ledger
    "journal_accruals": """
select case o_orderkey % 7 when 0 then 'ACYE2' || cast(o_orderkey % 9 as string) || cast(o_custkey as string)
      when 1 then 'xbvp' || cast(o_custkey as string) when 2 then 'BCR' || cast(o_custkey as string)
      when 3 then null else 'AC' || cast(o_custkey as string) end as voucher,
  case when o_orderkey % 11 = 0 then 'long1' else ' e' || cast(o_orderkey % 9 as string) end as dataarea,
  case o_orderkey % 8 when 0 then '' when 1 then null when 2 then 'other7' else 'c' || cast(o_custkey % 9 as string) || ' ' end as counterparty,
  cast(case o_orderkey % 5 when 0 then 21015 when 1 then 15002 when 2 then 20200 when 3 then 40000 else 21015 end as int) as mainaccount,
  o_orderdate + interval '5' hour as accountingdate, o_totalprice as transactioncurrencyamount,
  case when o_orderkey % 2 = 0 then 'AED' else 'USD' end as transactioncurrencycode,
  o_orderkey as generaljournalaccountentryrecid
from @orders
""",
    "vendor_transactions": _transactions("vendor_account", "Vendor"),
    "customer_transactions": _transactions("customer_account", "Customer"),
    "branch_domain": """
select 'E' || cast(n_nationkey as string) as company, 'd' || cast(n_nationkey as string) as iss_domain from @nation where n_nationkey <> 5
union all select 'E' || cast(n_nationkey as string), 'b' || cast(n_nationkey as string) from @nation
""",
    "global_entitlement": "select lower(r_name) || '@all.example' as email from @region",
    "office_entitlement": """
select 'user' || cast(n_nationkey as string) || '@mail.example' as email, 'e' || cast(n_nationkey % 10 as string) as office
from @nation union all select 'user1@mail.example', 'e1' from @region where r_regionkey = 0
""",
    "issued_invoices": """
select o_orderkey as id, 'd' || cast((o_orderkey + 1) % 8 as string) as iss_domain,
  case when o_orderkey % 17 = 0 then null
    else 'E' || cast((o_orderkey + 1) % 8 as string) || case when o_orderkey % 3 = 0 then '-FTI-' else '-INV-' end || cast(o_orderkey as string) end as serial_no,
  cast(o_orderdate as date) as issue_date, cast(case when o_orderkey % 14 = 0 then 1 else 0 end as int) as voided
from @orders
""",
    "issued_credit_notes": """
select o_orderkey as id, 'd' || cast((o_orderkey + 1) % 8 as string) as iss_domain,
  'E' || cast((o_orderkey + 1) % 8 as string) || case when o_orderkey % 2 = 0 then '-CN-' else '-INV-' end || cast(o_orderkey as string) as serial_no,
  o_totalprice as total
from @orders where o_orderkey % 4 <> 3
""",
    "attachments": """
select o_orderkey * 2 as id, o_orderkey as parent_id, case when o_orderkey % 2 = 0 then 'IssuedInvoice' else 'Shipment' end as parent_type,
  case o_orderkey % 3 when 0 then 'AGI' else 'PKL' end as label, cast(case when o_orderkey % 13 = 0 then 0 else 1 end as int) as uploaded,
  o_orderkey % 5 <> 0 as shared_with_customer, 'd' || cast(o_orderkey % 8 as string) as iss_domain,
  'file' || cast(o_orderkey as string) || '.pdf' as name,
  o_orderdate + interval '1' hour * cast(o_orderkey % 200 as int) as created_at, 'user' || cast(o_custkey % 30 as string) as created_by
from @orders
union all
select o_orderkey * 2 + 1, o_orderkey, 'Shipment', case when o_orderkey % 2 = 0 then 'PKL' else 'AGI' end, cast(1 as int), true,
  'd1', 'second.pdf', o_orderdate + interval '90' minute, 'user0'
from @orders where o_orderkey % 6 = 1
""",
    # ---- charges and customs
    "shipments_ops": """
select o_orderkey as id, 'SH' || cast(o_orderkey as string) as serial_no,
  case when o_orderkey % 23 = 0 then 'ops_Cancelled' else 'ops_' || lower(o_orderstatus) end as operational_status,
  case o_orderkey % 3 when 0 then ' sea_inbound' when 1 then 'air_outbound' else 'land_inbound' end as service,
  'd' || cast(o_custkey % 25 as string) as iss_domain, o_orderdate + interval '7' hour as created_at, o_custkey as contact_id,
  'B' || cast(o_orderkey as string) as booking_no, 'H' || cast(o_orderkey as string) as house_no,
  'N' || cast(o_custkey % 25 as string) as origin_country, 'N' || cast(o_orderkey % 25 as string) as destination_country,
  lower(o_orderpriority) as line_of_business, ' doc ' || cast(o_custkey % 5 as string) as documentation_user_name,
  case when o_orderkey % 4 = 0 then null else 'op ' || cast(o_custkey % 6 as string) end as operations_user_name
from @orders
""",
    "cost_revenue_items": """
select l_orderkey as shipment_id, 'd' || cast(o_custkey % 25 as string) as iss_domain,
  case l_suppkey % 3 when 0 then 'USD' when 1 then 'AED' else 'EUR' end as currency,
  case l_linenumber when 1 then 'Pickup ' when 2 then 'handling' when 3 then 'Freight' when 4 then 'storage' when 5 then 'Inspection' else 'misc' end as charge_name,
  l_extendedprice as selling_rate, l_quantity as selling_quantity,
  case l_suppkey % 3 when 0 then 4.0 when 1 then 1.0 else 4.5 end as selling_local_exchange_rate,
  case when l_partkey % 4 = 0 then null else 'info' || cast(l_partkey % 5 as string) end as extra_info,
  case when l_partkey % 6 = 0 then null when l_partkey % 6 = 1 then '' else cast(l_orderkey as string) || '.0,7.0' end as customer_invoice_id
from @lineitem join @orders on l_orderkey = o_orderkey
""",
    "domain_currency": "select 'd' || cast(n_nationkey as string) as iss_domain, case when n_nationkey % 2 = 0 then 'AED' else 'EUR' end as currency from @nation where n_nationkey <> 7",
    "snapshot_rates": """
select 'AED' as cur2, date '2025-03-13' as d, 0.25 as exchange_rate from @region where r_regionkey = 0
union all select 'EUR', date '2025-03-13', 1.125 from @region where r_regionkey = 0
union all select 'EUR', date '2025-03-12', 9.0 from @region where r_regionkey = 0
""",
    "charge_service_mapping": """
select case n_nationkey % 3 when 0 then 'Sea_inbound' when 1 then 'AIR_outbound' else 'land_inbound ' end as service,
  case floor(n_nationkey / 3) when 0 then 'PICKUP' when 1 then 'Handling' when 2 then 'FREIGHT ' when 3 then 'Inspection' else 'extra ' || cast(n_nationkey as string) end as charge,
  case when n_nationkey = 8 then 'Retired' else 'Active' end as status,
  case floor(n_nationkey / 3) when 0 then 'Origin Charge' when 1 then 'Destination Charge' when 2 then 'Freight Charge' else 'Ancillary Charge' end as category
from @nation
""",
    "customs": """
select o_orderkey as shipment_id, case when o_orderkey % 9 = 0 then null else cast(o_orderdate as date) end as bill_of_entry_date,
  case o_orderkey % 4 when 0 then 'AED' when 1 then 'EUR' when 2 then 'GBP' else null end as declaration_currency,
  'import' as declaration_type, case when o_orderkey % 10 = 1 then null else o_totalprice end as declaration_value
from @orders where o_orderkey % 2 = 0 or o_orderkey % 7 = 0
""",
    "customs_rates": """
select 'EUR' as cost_exchange_rate, 'AED' as selling_exchange_rate, cast(null as double) as from_rate, 4.25 as to_rate, timestamp '2025-09-30 08:00:00' as created_at from @region where r_regionkey = 0
union all select 'GBP', 'AED', 5.0, 9.0, timestamp '2025-09-30 09:00:00' from @region where r_regionkey = 0
union all select 'EUR', 'AED', 1.0, 1.0, timestamp '2025-09-29 09:00:00' from @region where r_regionkey = 0
""",
    # ---- portal
    "portal_user": """
select c_custkey as id, lower(c_name) as name, case c_custkey % 10 when 0 then 'Admin' when 1 then 'Viewer' else 'Editor' end as role,
  case when c_custkey % 12 = 0 then 'TesTer' else 'u' end || cast(c_custkey as string) || case when c_custkey % 3 = 0 then '@own.example' else '@mail.example' end as email,
  timestamp '2024-01-01 00:00:00' + interval '1' hour * cast(c_custkey % 700 as int) as created_at,
  cast(c_custkey % 7 as bigint) as organization_id
from @customer
""",
    "companies_on_users": "select c_custkey as user_id, cast(floor(c_custkey / 15) as bigint) as company_id from @customer where c_custkey % 8 <> 0 union all select c_custkey, cast(floor(c_custkey / 20) as bigint) from @customer where c_custkey % 20 = 1",
    "company": "select s_suppkey as id, case when s_suppkey % 25 = 3 then null else lower(s_name) end as name, s_suppkey * 3 as ext_id from @supplier",
    "company_branch": "select s_suppkey as company_id, 'Branch ' || cast(s_nationkey as string) as name, lower(n_name) as country, 'city' || cast(s_nationkey as string) as city from @supplier join @nation on s_nationkey = n_nationkey where s_suppkey % 4 <> 0 union all select s_suppkey, 'Second', 'land', 'town' from @supplier where s_suppkey % 6 = 1",
    "organization": "select cast(r_regionkey as bigint) as id, r_name as name from @region",
    "user_login_history": "select user_id from @events where event_type in ('signup', 'click') and user_id % 3 <> 0 union all select cast(floor(event_id / 7) as bigint) from @events where event_type = 'view' and event_id % 10 <> 0",
    "shipments_tracker": "select case when l_linenumber = 7 then null else 'SH' || cast(l_orderkey as string) end as serial_no, l_shipdate as creation_date from @lineitem where l_orderkey % 5 <> 0",
    "ocr_log": """
select 'SH' || cast(cast(floor(event_id / 2) as bigint) as string) as serial_number,
  case when event_type in ('click', 'purchase') then '{"serial_number":"S' || cast(event_id as string) || '"}' else '{"other":1}' end as request_payload,
  case when event_type = 'error' then null else props end as ocr_payload,
  ts as created_at, case when event_id % 4 = 0 then null else ts + interval '1' minute * cast(event_id % 70000 as int) end as ocr_at,
  case when event_id % 6 = 0 then 'AGI' else 'PKL' end as label, cast(case when event_id % 10 = 0 then 1 else 0 end as int) as is_deleted,
  'https://files.example.com/' || cast(event_id as string) as attachment_url, case when event_id % 3 = 0 then '' else 'pdf' end as attachment_ext
from @events
""",
    # ---- purchase orders and freight
    "unit_base": _UNIT_BASE,
    "purchase_order_company": "select cast(n_nationkey as bigint) as id, 'Company ' || cast(n_nationkey as string) as company_name, 'd' || cast(n_nationkey as string) as iss_domain from @nation",
    "purchase_order_line": f"""
select {_LINE_ID} as id,
  'PO' || cast(l_orderkey as string) as po_no, l_linenumber as po_line_num, p_name as po_desc,
  case when l_partkey % 3 = 0 then null else 'remark ' || cast(l_partkey % 4 as string) end as po_remarks,
  case when l_partkey % 2 = 0 then 'STD' else 'URG' end as po_type,
  case l_partkey % 6 when 0 then 'EACH' when 1 then 'CASE OF 6' when 2 then 'CASE OF 12' when 3 then 'CASE OF 24' when 4 then 'CASE OF 32' else 'DRUM' end as po_uom,
  'I' || cast(l_partkey as string) as item_code,
  case when l_suppkey % 14 = 0 then '0' || cast(l_suppkey as string) else cast(l_suppkey as string) end as supplier_no,
  'Supplier ' || cast(l_suppkey as string) as supplier_name,
  'BU' || cast(l_suppkey % 6 as string) as ship_to_location, 'FOB' as inco_term_po, 'free on board' as inco_term_desc_po,
  case when l_partkey % 10 = 0 then null else cast(l_shipdate as date) + cast(-40 - l_partkey % 20 as int) end as req_app_dt,
  case when l_partkey % 15 = 0 then null else cast(l_shipdate as date) + cast(-42 + l_partkey % 9 as int) end as po_app_dt,
  cast(l_shipdate as date) + -45 as po_date,
  case when l_partkey % 21 = 0 then null else cast(l_shipdate as date) + cast(l_partkey % 70 as int) end as current_po_promised_dt,
  case when l_partkey % 50 = 7 then null else cast(cast(l_quantity as int) as string) end as po_qty_ordered,
  case l_partkey % 9 when 0 then 'CANCELLED' when 1 then 'closed short' when 2 then 'Completed' when 3 then null else 'open order' end as status,
  l_suppkey % 25 as purchase_order_company_id
from @lineitem join @part on l_partkey = p_partkey
""",
    "purchase_order_on_freight_unit": f"""
select {_LINE_ID} as purchase_order_id,
  case when l_partkey % 41 <> 7 then l_suppkey * 100 + (year(l_shipdate) - 1995) * 12 + month(l_shipdate) end as freight_unit_id,
  'U' || cast(l_suppkey * 100 + (year(l_shipdate) - 1995) * 12 + month(l_shipdate) as string) as freight_unit_no,
  l_suppkey % 25 as purchase_order_company_id,
  case when l_partkey % 3 = 0 then l_quantity else floor(l_quantity / 2) end as quantity
from @lineitem where l_linenumber <> 5
union all
select {_LINE_ID}, l_suppkey * 100 + (year(l_shipdate) - 1995) * 12 + 7,
  'U' || cast(l_suppkey * 100 + (year(l_shipdate) - 1995) * 12 + 7 as string),
  l_suppkey % 25, floor(l_quantity / 4)
from @lineitem where l_linenumber = 4
""",
    "freight_unit": """
select id, 'U' || cast(id as string) as unit_no, 'FO' || cast(id as string) as serial_no,
  case when id % 4 = 0 then null else 'SH' || cast(top_order as string) end as shipment_serial_no,
  'https://track.example.com/' || cast(id as string) as shipment_link,
  case when id % 19 = 0 then timestamp '2001-01-01 00:00:00' end as deleted_at
from @unit_base
""",
    "freight_unit_enrich": f"""
select id * 10 as id, 'U' || cast(id as string) as unit_no,
  case when id % 3 = 0 then 'd99' else 'd' || cast(supp % 25 as string) end as iss_domain,
  case when id % 3 = 0 or id % 14 = 1 then 'd' || cast(supp % 25 as string) else 'd98' end as remote_iss_domain,
  case when id % 31 = 0 then null else {_OWN} end as shipment_response, {_REMOTE} as remote_shipment_response,
  case id % 5 when 0 then 'sea_inbound' when 1 then 'air_inbound' when 2 then 'land_inbound' when 3 then 'land_outbound' else 'rail' end as service,
  'EXW' as shipping_terms, 'agent ' || cast(id % 4 as string) as routed_by,
  case when id % 37 = 0 then 'TBA' else 'P' || cast(id % 35 as string) end as origin_port, 'N' || cast(id % 26 as string) as origin_country,
  'P' || cast((id + 5) % 35 as string) as destination_port, 'N' || cast((id + 2) % 25 as string) as destination_country,
  'Dock ' || cast(id % 3 as string) as delivery_location,
  case when id % 4 = 0 then null else 'SH' || cast(top_order as string) end as shipment_serial_no,
  case when id % 3 = 1 then 'PR' || cast(id as string) end as pr_number, case when id % 3 = 1 then base_day + -60 end as pr_date,
  case when id % 4 = 1 then 'S' || cast(id as string) end as spo_number, case when id % 5 = 1 then 'G' || cast(id as string) end as grn_no,
  case when id % 6 = 1 then 'A' || cast(id as string) end as addl_po, case when id % 7 = 1 then 'AG' || cast(id as string) end as addl_po_grn_number,
  'note ' || cast(id % 5 as string) as shipment_remarks, case when id % 2 = 1 then 'bill' end as billing_notes,
  case when id % 2 = 0 then timestamp '1999-01-01 00:00:00' end as pre_alert_sent_at,
  case when id % 8 = 1 then 'F' || cast(id as string) end as ancillary_charge_form_no
from @unit_base where id % 23 <> 0
""",
    "ports": "select 'P' || cast(n_nationkey as string) as port, lower(n_name) as country, 'r' || cast(n_regionkey as string) as region from @nation union all select 'P3', 'zz', 'zz' from @region",
    "airports": "select 'P' || cast(n_nationkey + 9 as string) as airport, 'air ' || n_name as country, 'ar' || cast(n_regionkey as string) as region from @nation union all select 'TBA', 'nowhere', 'none' from @region where r_regionkey = 0",
    "port_codes": "select 'P' || cast(n_nationkey + 4 as string) as code, 'port of ' || n_name as name from @nation union all select 'P5', 'zz' from @region",
    "country_codes": """
select 'N' || cast(n_nationkey as string) as iso_2_char_code, lower(n_name) as country_name, 'Iso ' || n_name as iso_country_name, 'd' || cast(n_nationkey as string) as country_level from @nation
union all select 'N2', 'aa', 'Iso NATION_2', 'd2' from @region where r_regionkey = 0
""",
    "supplier_lead_time": "select cast(s_suppkey as string) as supplier_id, 'SUPPLIER ' || cast(s_suppkey as string) as supplier_name, cast(10 + s_suppkey % 40 as int) as avg_lead_time from @supplier where s_suppkey % 10 <> 3",
    "country_transit_time": "select 'N' || cast(n_nationkey as string) as code, cast(12 + n_nationkey as int) as average_transit_time from @nation where n_nationkey % 6 <> 5",
    "carrier_shipping": "select 'CA' || cast(n_nationkey as string) as carrier_scac, 'Carrier ' || n_name as name, split('CA' || cast(n_nationkey as string) || ',CX' || cast(n_nationkey as string), ',') as all_scacs from @nation",
    "shipment_details": """
select '{"serial_no":"FO' || cast(id as string) || '"}' as shipment_details,
  '[{"status":"Estimated Cargo Date","date":"' || cast(base_day as string) || '"},{"status":"Other","date":"2030-01-01"},{"status":"Estimated Cargo Date","date":"'
    || cast(base_day + cast(id % 5 as int) as string) || '"}]' as statuses
from @unit_base where id % 4 <> 2
""",
}

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
