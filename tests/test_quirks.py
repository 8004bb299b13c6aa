"""Published behaviours that look odd but are kept, pinned one by one."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradeops.functions.text import title_words
from tradeops.operators.access import any_of_join
from tradeops.operators.freight import destination_place, origin_place, places
from tradeops.operators.money import charge_pivot, customs_values, first_invoice_id, fx_to_usd
from tradeops.plans import ic_accruals, ic_client_side, ic_entitlements, ic_loans, ic_payments, ic_vendor_side, login_entitlements, portal_users
from tradeops.plans.freight_orders import open_lines
from tradeops.plans.po_lines import po_line_view
from tradeops.sources import Tables, latest, publish
from tradeops.sources.publish import registry
from tradeops.sources.schemas import SCHEMAS
from tradeops.sources.staging import staging_root
from tradeops.sources.tables import conform, snake


def tables(spark, **data):
    """All input tables, empty unless rows (as dicts) are given."""
    frames = {}
    for name, ddl in SCHEMAS.items():
        schema = spark.createDataFrame([], ddl).schema
        listed = [tuple(r.get(f.name) for f in schema) for r in data.get(name, [])]
        frames[name] = spark.createDataFrame(listed, schema)
    return Tables(frames)


def txn(account_column, **values):
    base = {account_column: "E1", "company": "E2", "currency": "USD", "voucher_date": dt.datetime(2024, 1, 1)}
    return base | values


def money(x):
    from decimal import Decimal

    return Decimal(str(x))


def test_payables_label_and_crosswise_keys(spark):
    rows = [
        txn("vendor_account", invoice="I1", voucher="V1", transaction_type="Vendor", amount=money(10)),
        txn("vendor_account", invoice="E2-CN-1", voucher="V2", transaction_type="vendor", amount=money(-4), last_settlement_voucher="V1"),
        txn("vendor_account", invoice="J1", voucher="xLOG1", transaction_type="General Journal", amount=money(5)),
        txn("vendor_account", invoice="J1", voucher="S", transaction_type="Settlement", amount=money(-5)),
        txn("vendor_account", invoice=None, voucher=None, transaction_type="Vendor", amount=money(1)),
    ]
    t = tables(spark, vendor_transactions=rows)
    faithful = {r["_invoice"]: r for r in ic_client_side(t).collect()}
    assert set(faithful) == {"I1", "E2-CN-1", "J1", None}
    assert {r["_src"] for r in faithful.values()} == {"MANUAL DOCS."}
    assert faithful["I1"]["_credit_note_match_manual"] is None and faithful["J1"]["_amount_settle_negative"] is None
    fixed = {r["_invoice"]: r for r in ic_client_side(t, faithful=False).collect()}
    assert None not in fixed and fixed["J1"]["_src"] == "AUTO DOCS."
    assert fixed["I1"]["_credit_note_match_manual"] == "MATCHED CN" and fixed["I1"]["_cancel_amount_manual"] == money(-4)
    assert fixed["J1"]["_amount_settle_negative"] == money(-5) and fixed["J1"]["_amount_settle_positive"] == money(0)


def test_receivables_match_straight_and_need_a_document(spark):
    rows = [
        txn("customer_account", invoice="I1", voucher="V1", transaction_type="Customer", amount=money(10)),
        txn("customer_account", invoice="X-CN-1", voucher="V2", transaction_type="Customer", amount=money(-4), last_settlement_voucher="V1"),
        txn("customer_account", invoice=None, voucher=None, transaction_type="Customer", amount=money(1)),
        txn("customer_account", customer_account="E1234", invoice="I5", transaction_type="Customer", amount=money(1)),
    ]
    got = {r["_invoice"]: r for r in ic_vendor_side(tables(spark, customer_transactions=rows)).collect()}
    assert set(got) == {"I1", "X-CN-1"}
    assert got["I1"]["_cancel_amount_manual"] == money(-4) and got["X-CN-1"]["_doc_type"] == "CR. NOTE"
    assert got["X-CN-1"]["_url_vault"].endswith("/X/X-CN-1.pdf")


def test_accruals_loans_payments_filters(spark):
    base = {"dataarea": "e1", "counterparty": "e2", "accountingdate": dt.datetime(2024, 1, 2, 5)}
    rows = [
        base | {"voucher": "A", "mainaccount": 21015}, base | {"voucher": "A", "mainaccount": 21015},
        base | {"voucher": "xYe24", "mainaccount": 21015}, base | {"voucher": None, "mainaccount": 21015},
        base | {"voucher": "A", "mainaccount": 21015, "counterparty": "e2345"},
        base | {"voucher": "L", "mainaccount": 15002, "counterparty": ""}, base | {"voucher": "L2", "mainaccount": 15002, "counterparty": None},
        base | {"voucher": "bvpBCR", "mainaccount": 1}, base | {"voucher": "xBCRx", "mainaccount": 1}, base | {"voucher": "bcr", "mainaccount": None},
    ]
    t = tables(spark, journal_accruals=rows)
    accruals = ic_accruals(t).collect()
    assert sorted((r["_voucher"] or "", r["_rows"]) for r in accruals) == [("", 1), ("A", 2), ("A", 2)]
    assert [(r["_voucher"], r["_client"]) for r in ic_loans(t).collect()] == [("L", "NA")]
    assert sorted((r["_doc"], r["_side"]) for r in ic_payments(t).collect()) == [("bvpBCR", "CLIENT"), ("xBCRx", "VENDOR")]


def test_local_charges_add_usd_items_only(spark):
    ship = [{"id": 1, "serial_no": "S", "service": " Sea ", "iss_domain": "d", "operational_status": "ok"}]
    item = {"shipment_id": 1, "iss_domain": "d", "charge_name": "fee", "selling_quantity": money(2), "selling_rate": money(10), "customer_invoice_id": "7.0,8.0"}
    items = [
        item | {"currency": "USD", "selling_local_exchange_rate": money(4), "extra_info": "b"},
        item | {"currency": "EUR", "selling_local_exchange_rate": money(5), "extra_info": "a"},
        item | {"currency": "EUR", "charge_name": "unknown", "selling_local_exchange_rate": money(5)},
    ]
    t = tables(
        spark, shipments_ops=ship, cost_revenue_items=items, domain_currency=[{"iss_domain": "d", "currency": "AED"}],
        snapshot_rates=[{"cur2": "AED", "d": dt.date(2025, 3, 13), "exchange_rate": money(0.25)}],
        charge_service_mapping=[{"service": "SEA", "charge": " FEE", "status": "Active", "category": "Freight Charge"}],
        issued_invoices=[{"id": 7, "iss_domain": "d", "serial_no": "INV7", "issue_date": dt.date(2024, 3, 1), "voided": 0}],
    )
    names = ("shipments_ops", "cost_revenue_items", "charge_service_mapping", "issued_invoices", "snapshot_rates", "domain_currency")
    got = charge_pivot(*[t[n] for n in names]).first()
    assert (float(got["_frt_charges_usd"]), float(got["_frt_charges_local"]), got["_org_charges_usd"]) == (45.0, 80.0, None)
    assert (got["_issued_invoices"], got["_issue_date"], got["_aux_charge_type"]) == ("INV7 | INV7", "MAR-2024 | MAR-2024", None)
    every = charge_pivot(*[t[n] for n in names], local_for_all=True).first()
    assert float(every["_frt_charges_local"]) == 180.0


def test_invoice_id_strips_every_dot_zero(spark):
    df = spark.createDataFrame([("12.0,13.0",), ("1.05",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(first_invoice_id("v")).collect()] == [12, 15, None, None]


def test_customs_value_published_unchanged_if_local(spark):
    c = {"shipment_id": 1, "bill_of_entry_date": dt.date(2025, 9, 1), "declaration_value": money(100)}
    rates = [{"cost_exchange_rate": "EUR", "selling_exchange_rate": "AED", "to_rate": money(4), "created_at": dt.datetime(2025, 9, 30, 8)}]
    t = tables(
        spark, customs=[c | {"declaration_currency": "AED"}, c | {"shipment_id": 2, "declaration_currency": "EUR"}, c | {"declaration_currency": None}],
        customs_rates=rates,
    )
    got = {r[0]: (float(r[1]), float(r[2])) for r in customs_values(t["customs"], t["customs_rates"]).collect()}
    assert got == {1: (100.0, 100.0), 2: (400.0, 1440.0)}


def test_missing_rate_falls_back_to_reporting_amount(spark):
    row = {"accountingdate": dt.datetime(2024, 1, 1), "accountingcurrency": "EUR", "accountingcurrencyamount_inv": money(8), "reportingcurrencyamount_inv": money(3)}
    t = tables(spark, journal=[row])
    got = fx_to_usd(t["journal"], t["fx_daily"]).first()
    assert (float(got["_amount_usd"]), float(got["_amount"])) == (3.0, 8.0)


def test_places_quirks(spark):
    t = tables(
        spark, ports=[{"port": "P", "country": "sealand", "region": "sr"}],
        airports=[{"airport": "TBA", "country": "nowhere", "region": "x"}, {"airport": "Q", "country": "airland", "region": "ar"}],
        port_codes=[{"code": "P", "name": "port p"}], country_codes=[{"iso_2_char_code": "N", "country_name": "b"}, {"iso_2_char_code": "N", "country_name": "a"}],
    )
    rows = [
        ("sea planned", "sea_x", None, "P", None), ("sea named", "sea_x", "S", "zz", "P"), ("air named", "air_x", "S", None, "TBA"),
        ("air planned tba", "air_x", None, "TBA", None), ("land in", "land_inbound", None, None, None),
        ("land out", "land_outbound", None, None, None), ("rail", "rail", None, None, None),
    ]
    df = spark.createDataFrame(rows, "k string, service string, serial string, plan string, actual string")
    dim = places(t["ports"], t["airports"], t["port_codes"])
    got = {r.k: (r["_origin_port_name"], r["_origin_country"], r["_origin_region_org_reg"]) for r in origin_place(df, dim, "service", "serial", "plan", "actual").collect()}
    assert got == {
        "sea planned": ("PORT P", "SEALAND", "SR"), "sea named": ("PORT P", "SEALAND", "SR"), "air named": (None, "NOWHERE", "X"),
        "air planned tba": (None, None, None), "land in": ("JEBEL ALI", "JEBEL ALI", "JEBEL ALI"),
        # The region knows every land service, name and country only the inbound one.
        "land out": ("TBA", "TBA", "JEBEL ALI"), "rail": ("TBA", "TBA", "TBA"),
    }
    d = df.withColumns({"ps": F.lit(None).cast("string"), "c": F.lit("N")})
    out = {r.k: (r["_destination_port_name_dest"], r["_destination_country_dest"]) for r in destination_place(
        d, dim, t["country_codes"], "service", "serial", "ps", "plan", "actual", "c", "c").collect()}
    assert out["sea planned"] == ("TBA", "B") and out["sea named"] == ("PORT P", "B") and out["land out"] == ("JEBEL ALI", "B")


def test_duplicate_entitlements_stay_duplicated(spark):
    t = tables(
        spark, vendor_transactions=[txn("vendor_account"), txn("vendor_account", company="E3", vendor_account="LONGER")],
        office_entitlement=[{"email": "a@x", "office": "e1"}] * 2,
    )
    got = ic_entitlements(t).collect()
    assert sorted(map(tuple, got)) == [("A@X", "E1")] * 2
    pairs = spark.createDataFrame([("E1", "E1"), ("E1", "E2")], "a string, b string")
    assert any_of_join(pairs, ["a", "b"], spark.createDataFrame([("E1",)], "o string"), "o").count() == 2


def test_login_entitlements_sorted_and_active_only(spark):
    t = tables(
        spark, global_entitlement=[{"email": "z@x"}], domain_catalog=[{"iss_domain": "d1"}, {"iss_domain": "d2"}],
        login_local_entitlement=[{"email": "A@x"}, {"email": "b@x"}],
        crm_users=[{"email": "a@X", "iss_domain": "d1", "active": 1}, {"email": "b@x", "iss_domain": "d1", "active": 0}],
    )
    assert [tuple(r) for r in login_entitlements(t).collect()] == [("A@X", "d1"), ("Z@X", "*")]


def test_portal_users_fan_out_by_branch(spark):
    t = tables(
        spark, portal_user=[{"id": 1, "name": "n", "role": "Editor", "email": "aTesT@own.example"}, {"id": 2, "role": "Admin"}, {"id": 3, "role": None}],
        companies_on_users=[{"user_id": u, "company_id": 5} for u in (1, 2, 3)], company=[{"id": 5, "name": "c"}],
        company_branch=[{"company_id": 5, "name": "b1"}, {"company_id": 5, "name": "b2"}], user_login_history=[{"user_id": 1}] * 3,
    )
    got = portal_users(t, "own.example", "Admin").collect()
    assert [(r["_user_id"], r["_active"], r["_user_type"], r["_is_test"], r["_company_focus"]) for r in got] == [(1, 2, "INTERNAL", "TesT", "NA")] * 2


LINE = {"id": 1, "po_no": "P", "po_uom": "CASE OF 6", "po_qty_ordered": "10", "supplier_no": "7", "supplier_name": "s", "purchase_order_company_id": 1, "status": "Closed"}
FREIGHT = {
    "purchase_order_line": [LINE, LINE | {"id": 2, "po_qty_ordered": None}],
    "purchase_order_company": [{"id": 1, "company_name": "c", "iss_domain": "d"}],
    "purchase_order_on_freight_unit": [{"purchase_order_id": 1, "freight_unit_id": 9, "purchase_order_company_id": 1, "quantity": money(10)}],
    "freight_unit": [{"id": 9, "unit_no": "U", "serial_no": "F9"}],
    "freight_unit_enrich": [{
        "id": 3, "unit_no": "U", "iss_domain": "d", "service": "sea_x",
        "shipment_response": '{"serial_no":"S","eta_date":"2024-05-01","etd_date":"2024-04-01","delivery_date":"2024-05-04"}',
    }],
}


def test_line_view_has_one_master_per_line_and_no_final_date(spark):
    t = tables(spark, **FREIGHT)
    got = po_line_view(t, as_of="2024-06-01").collect()
    masters = [r for r in got if r["_master_line"] == "Master"]
    assert len(got) == 3 and len(masters) == 2
    assert {r["_final_expected_del_date"] for r in got} == {None}
    first = next(r for r in masters if r["_line_no"] == 1)
    assert (float(first["_balance_outer_qnty"]), first["_06_expt_status"], first["_line_type"]) == (0.0, "green", "Closed")
    assert next(r for r in masters if r["_line_no"] == 2)["_06_expt_status"] == "red"
    fixed = po_line_view(t, as_of="2024-06-01", fixed_final_date=True).where("_master_line = 'Master' and _line_no = 1").first()
    assert fixed["_final_expected_del_date"] == dt.date(2024, 5, 4)


def test_links_without_a_unit_stay_and_ids_are_unique(spark):
    links = [
        {"purchase_order_id": 1, "freight_unit_id": u, "purchase_order_company_id": 1, "quantity": money(q)} for u, q in ((9, 4), (None, 9))
    ]
    t = tables(
        spark, **FREIGHT | {"purchase_order_on_freight_unit": links},
        supplier_lead_time=[{"supplier_id": "7", "supplier_name": n, "avg_lead_time": d} for n, d in (("a", 1), ("b", 2))],
    )
    got = po_line_view(t, as_of="2024-06-01").collect()
    shipped = [r for r in got if r["_line_type"] == "Enriched"]
    assert sorted((r["_freight_unit_id"], float(r["_shipped"])) for r in shipped if r["_freight_unit_id"]) == [(9, 4.0)] * len(
        [r for r in shipped if r["_freight_unit_id"]]
    )
    assert any(r["_freight_unit_id"] is None and float(r["_shipped"]) == 9.0 for r in shipped)
    # A key with a missing part is missing too: rows without a unit carry none.
    ids = [r["_line_id"] for r in got if r["_line_id"] is not None]
    assert len(set(ids)) == len(ids) == len(got) - sum(r["_line_type"] == "Enriched" and r["_fo_serial"] is None for r in got)


def test_open_lines_double_for_doubled_supplier_names(spark):
    open_line = LINE | {"id": 4, "po_qty_ordered": "3"}
    t = tables(
        spark, **FREIGHT | {"purchase_order_line": [LINE, open_line]},
        supplier_lead_time=[{"supplier_id": "7", "supplier_name": "S", "avg_lead_time": 1}, {"supplier_id": "8", "supplier_name": "s", "avg_lead_time": 2}],
    )
    got = open_lines(t, F.lit(dt.date(2024, 6, 1))).collect()
    assert [r["_pid"] for r in got] == [4, 4]
    # The id has no guard against missing parts.
    assert got[0]["_fo_id"] is None


def test_publish_replaces_only_its_own_key(spark, tmp_path):
    root = str(tmp_path)
    publish(spark.range(3), root, "sales", "ids")
    publish(spark.range(5), root, "sales", "other")
    publish(spark.range(1), root, "sales", "ids")
    assert (latest(spark, root, "sales", "ids").count(), latest(spark, root, "sales", "other").count()) == (1, 5)
    assert registry(spark, root).count() == 2
    with pytest.raises(LookupError):
        latest(spark, root, "sales", "none")


def test_tables_read_files_and_rename(spark, tmp_path):
    spark.createDataFrame([("P1", "c", "r")], SCHEMAS["ports"]).write.parquet(f"{tmp_path}/ports")
    spark.createDataFrame([("P1", "c", "r")], SCHEMAS["ports"]).write.json(f"{tmp_path}/json/ports")
    assert Tables.from_files(spark, str(tmp_path))["ports"].first().port == "P1"
    assert Tables.from_files(spark, f"{tmp_path}/json", "json")["ports"].first().region == "r"
    odd = spark.createDataFrame([("S1", 1)], "`Serial No` string, Rest int")
    assert snake(odd, {"Serial No": "serial_no"}).columns == ["serial_no"]
    spark.createDataFrame([("P2", "c", "r")], SCHEMAS["ports"]).createOrReplaceTempView("ports")
    jdbc = Tables.from_jdbc(spark, "jdbc:none", {"ports": "x.ports"}, single_read=["ports"])
    assert list(jdbc) == ["ports"] and len(Tables.from_catalog(spark, "db")) == len(SCHEMAS)
    with pytest.raises(ValueError, match="ports"):
        Tables.from_jdbc(spark, "jdbc:none", {"ports": "x.ports"}, {"ports": {"numPartitions": "4"}})


def test_sources_are_renamed_and_typed(spark):
    odd = spark.createDataFrame([("7", "x", 3), ("no number", "y", 4)], "`User Id` string, `company_id` string, Rest int")
    got = conform(odd, "companies_on_users", {"user_id": "User Id"})
    assert got.schema == StructType.fromDDL(SCHEMAS["companies_on_users"])
    assert [tuple(r) for r in got.collect()] == [(7, None), (None, None)]


def test_words_start_after_any_mark(spark):
    df = spark.createDataFrame([("o'brien-SMITH_jr 2nd",), ("",), (None,), ("éLAN vital",)], "s string")
    assert [r[0] for r in df.select(title_words("s")).collect()] == ["O'Brien-Smith_Jr 2nd", "", None, "Élan Vital"]


def test_staging_uses_the_configured_folder(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": "shared://folder/"}.get(key, default)

    class Session:
        conf = Conf()

    assert staging_root(Session()) == "shared://folder"
    # Where nothing is configured, the session's own checkpoint folder serves.
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert staging_root(spark) == named.rstrip("/")
