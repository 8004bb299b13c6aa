"""Declared schemas of the input tables (DDL strings); nothing is inferred."""

from __future__ import annotations

MONEY = "decimal(38,6)"
RATE = "decimal(28,12)"  # rates keep more places than amounts

SCHEMAS: dict[str, str] = {
    # purchase orders and freight
    "purchase_order_line": f"""id bigint, po_no string, po_line_num int, po_desc string, po_remarks string,
        po_type string, po_uom string, item_code string, supplier_no string, supplier_name string,
        ship_to_location string, inco_term_po string, inco_term_desc_po string, req_app_dt date, po_app_dt date,
        po_date date, current_po_promised_dt date, po_qty_ordered string, status string,
        purchase_order_company_id bigint""",
    "purchase_order_on_freight_unit": f"""purchase_order_id bigint, freight_unit_id bigint, freight_unit_no string,
        purchase_order_company_id bigint, quantity {MONEY}""",
    "purchase_order_company": "id bigint, company_name string, iss_domain string",
    "freight_unit": """id bigint, unit_no string, serial_no string, shipment_serial_no string,
        shipment_link string, deleted_at timestamp""",
    "freight_unit_enrich": """id bigint, unit_no string, iss_domain string, remote_iss_domain string,
        shipment_response string, remote_shipment_response string, service string, shipping_terms string,
        routed_by string, origin_port string, origin_country string, destination_port string,
        destination_country string, delivery_location string, shipment_serial_no string, pr_number string,
        pr_date date, spo_number string, grn_no string, addl_po string, addl_po_grn_number string,
        shipment_remarks string, billing_notes string, pre_alert_sent_at timestamp,
        ancillary_charge_form_no string""",
    "ports": "port string, country string, region string",
    "airports": "airport string, country string, region string",
    "port_codes": "code string, name string",
    "country_codes": "iso_2_char_code string, country_name string, iso_country_name string, country_level string",
    "supplier_lead_time": "supplier_id string, supplier_name string, avg_lead_time int",
    "country_transit_time": "code string, average_transit_time int",
    "carrier_shipping": "carrier_scac string, name string, all_scacs array<string>",
    "shipment_details": "shipment_details string, statuses string",
    # charges, invoices, customs
    "shipments_ops": """id bigint, serial_no string, operational_status string, service string, iss_domain string,
        created_at timestamp, contact_id bigint, booking_no string, house_no string, origin_country string,
        destination_country string, line_of_business string, documentation_user_name string,
        operations_user_name string""",
    "cost_revenue_items": f"""shipment_id bigint, iss_domain string, currency string, charge_name string,
        selling_rate {MONEY}, selling_quantity {MONEY}, selling_local_exchange_rate {RATE}, extra_info string,
        customer_invoice_id string""",
    "domain_currency": "iss_domain string, currency string",
    "snapshot_rates": f"cur2 string, d date, exchange_rate {RATE}",
    "charge_service_mapping": "service string, charge string, status string, category string",
    "issued_invoices": "id bigint, iss_domain string, serial_no string, issue_date date, voided int",
    "issued_credit_notes": f"id bigint, iss_domain string, serial_no string, total {MONEY}",
    "attachments": """id bigint, parent_id bigint, parent_type string, label string, uploaded int,
        shared_with_customer boolean, iss_domain string, name string, created_at timestamp, created_by string""",
    "customs": f"""shipment_id bigint, bill_of_entry_date date, declaration_currency string,
        declaration_type string, declaration_value {MONEY}""",
    "customs_rates": f"""cost_exchange_rate string, selling_exchange_rate string, from_rate {RATE},
        to_rate {RATE}, created_at timestamp""",
    # ledger and intercompany
    "journal_accruals": f"""voucher string, dataarea string, counterparty string, mainaccount int,
        accountingdate timestamp, transactioncurrencyamount {MONEY}, transactioncurrencycode string,
        generaljournalaccountentryrecid bigint""",
    "vendor_transactions": f"""vendor_account string, company string, invoice string, voucher string,
        voucher_date timestamp, posted_date timestamp, transaction_type string, amount {MONEY}, currency string,
        settled_amount {MONEY}, last_settlement_voucher string""",
    "customer_transactions": f"""customer_account string, company string, invoice string, voucher string,
        voucher_date timestamp, posted_date timestamp, transaction_type string, amount {MONEY}, currency string,
        settled_amount {MONEY}, last_settlement_voucher string""",
    "branch_domain": "company string, iss_domain string",
    "global_entitlement": "email string",
    "office_entitlement": "email string, office string",
    # sales
    "shipments_fact": f"""id bigint, serial_no string, operational_date timestamp, service string, origin string,
        destination string, line_of_business string, shipment_type string, iss_domain string, area_name string,
        crm_client string, crm_contact_id bigint, financial_status string, operational_status string,
        sales_user string, documentation_user string, operations_user string, account_manager string,
        url_to_shipment string, expected_revenue_usd {MONEY}, expected_profit_usd {MONEY},
        expected_revenue_local {MONEY}, expected_profit_local {MONEY}, dax_revenue_local {MONEY},
        dax_gp_local {MONEY}, dax_revenue_usd {MONEY}, dax_gp_usd {MONEY}, chargeable_weight_air {MONEY},
        chargeable_weight_ltl {MONEY}, trucks_ftl {MONEY}, teu_fcl {MONEY}, cbm_lcl {MONEY},
        cbm_projects {MONEY}""",
    "contacts": """id bigint, name string, account_manager_name string, iss_domain string,
        customer_accounting_id string, tax_id string""",
    "journal": f"""accountingdate timestamp, jobmaster string, name string, mainaccount int,
        accountingcurrency string, accountingcurrencyamount_inv {MONEY}, reportingcurrencyamount_inv {MONEY}""",
    "fx_daily": f"fromcurrency string, tocurrency string, startdate timestamp, exrate {RATE}",
    "account_manager_changes": "contact_id bigint, new_account_manager string, changed_at timestamp",
    "budget_sales": "sales_user string",
    "crm_users": "name string, email string, iss_domain string, active int",
    "sales_global_entitlement": "name string, email string",
    "login_local_entitlement": "email string",
    # portal users and documents
    "portal_user": """id bigint, name string, role string, email string, created_at timestamp,
        organization_id bigint""",
    "companies_on_users": "user_id bigint, company_id bigint",
    "company": "id bigint, name string, ext_id bigint",
    "company_branch": "company_id bigint, name string, country string, city string",
    "organization": "id bigint, name string",
    "user_login_history": "user_id bigint",
    "domain_catalog": "iss_domain string",
    "shipments_tracker": "serial_no string, creation_date timestamp",
    "ocr_log": """serial_number string, request_payload string, ocr_payload string, created_at timestamp,
        ocr_at timestamp, label string, is_deleted int, attachment_url string, attachment_ext string""",
}
