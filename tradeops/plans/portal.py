"""Portal reports: packing-list uploads and portal users."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import Age, clock_label, days_between, elapsed_hours, minute_label
from ..functions.rules import activity_bucket, present
from ..functions.text import blank_to_null, captured, clean_upper, or_na, part
from ..operators.grouping import fanout_left_join

TRACKED_SINCE = dt.date(2025, 5, 1)  # fixed value
PACKING_LIST = "PKL"  # fixed value: attachment label


def ocr_state(ocr: DataFrame, label: str = PACKING_LIST) -> DataFrame:
    """Per serial: was a request seen, did it answer, when, and how long it took."""
    asked = F.get_json_object("request_payload", "$.serial_number").isNotNull()
    answered = F.col("ocr_payload").isNotNull() & F.col("ocr_at").isNotNull()
    state = (
        ocr.where((F.col("label") == label) & (F.col("is_deleted").cast("int") == 0))
        .groupBy(F.col("serial_number").alias("__ocr_serial"))
        .agg(
            F.max(F.when(asked, "Success")).alias("_request"),
            F.max("created_at").alias("_request_at"),
            F.max(F.when(answered, "Success").otherwise("Fail")).alias("_response"),
            F.max("ocr_at").alias("_response_at"),
            F.max("attachment_url").alias("_attachment_url"),
            F.max("attachment_ext").alias("__ext"),
        )
    )
    age = Age("_response_at", "_request_at")
    return state.withColumns({"_sla": age.label(), "_sla_hours": age.nominal_hours()})


def tracked_shipments(tracker: DataFrame, facts: DataFrame) -> DataFrame:
    """First seen date and link per serial; both sides reduced before they meet."""
    seen = (
        tracker.where(F.col("serial_no").isNotNull())
        .groupBy(F.col("serial_no").alias("__serial"))
        .agg(F.min("creation_date").alias("_creation_date_avs"))
    )
    links = facts.groupBy(F.col("serial_no").alias("__fact_serial")).agg(F.max("url_to_shipment").alias("_shipment_url"))
    return seen.join(links, F.col("__serial") == F.col("__fact_serial"), "left").drop("__fact_serial")


def upload_delay(uploaded: str, created: str) -> dict:
    """Days between the dates and hours between the times, rounded."""
    return {
        "_attach_delay_days": days_between(uploaded, created),
        "_attach_delay_hours": F.round(elapsed_hours(uploaded, created), 0),
    }


def packing_list_tracker(
    tables: Mapping[str, DataFrame], since: dt.date = TRACKED_SINCE, label: str = PACKING_LIST
) -> DataFrame:
    """One row per tracked shipment and packing-list attachment."""
    s = tables["shipments_ops"].where(F.col("created_at").cast("date") >= F.lit(since))
    a = tables["attachments"].where(
        (F.col("parent_type") == "Shipment") & (F.col("label") == label) & (F.col("uploaded").cast("int") == 1)
    ).select(
        F.col("parent_id").alias("__parent"), F.col("id").alias("__attachment"), F.col("created_at").alias("__uploaded"),
        F.col("name").alias("_file_name"), F.col("created_by").alias("_user"),
    )
    c = tables["contacts"].select(
        F.col("id").alias("__contact"), F.col("name").alias("__company"), F.col("iss_domain").alias("__contact_domain")
    )
    y = tables["country_codes"].groupBy(F.col("country_level").alias("__level")).agg(
        F.max("iso_country_name").alias("_country")
    )
    # A shipment may carry very many attachments.
    rows = (
        fanout_left_join(s, a, [("id", "__parent")])
        .join(tracked_shipments(tables["shipments_tracker"], tables["shipments_fact"]), F.col("serial_no") == F.col("__serial"))
        .join(c, F.col("contact_id") == F.col("__contact"), "left")
        .join(y, F.col("__contact_domain") == F.col("__level"), "left")
        .join(ocr_state(tables["ocr_log"], label), F.col("serial_no") == F.col("__ocr_serial"), "left")
    )
    service = clean_upper(F.replace(F.col("service"), F.lit("_"), F.lit(" ")))
    read = (F.col("_request") == "Success") & (F.col("_response") == "Success")
    delay = upload_delay("__uploaded", "created_at")
    return rows.select(
        F.col("serial_no").alias("_serial"),
        "_creation_date_avs",
        F.col("created_at").cast("date").alias("_shipment_creation_date"),
        F.col("__uploaded").cast("date").alias("_upload_date"),
        clock_label("__uploaded").alias("_upload_time"),
        *[expr.alias(name) for name, expr in delay.items()],
        clean_upper("__company").alias("_company_focus"),
        "_file_name",
        "_user",
        F.col("iss_domain").alias("_iss_dom"),
        F.col("booking_no").alias("_booking_no"),
        F.col("house_no").alias("_house_no"),
        F.col("origin_country").alias("_country_origin"),
        F.col("destination_country").alias("_country_destination"),
        service.alias("_service_full"),
        part(service, " ", 1).alias("_service_type"),
        part(service, " ", 2).alias("_service_direction"),
        clean_upper("line_of_business").alias("_lob"),
        clean_upper("documentation_user_name").alias("_doc_user"),
        clean_upper("operations_user_name").alias("_oper_user"),
        "_country",
        "_shipment_url",
        present("__attachment", "Has PKL", "No PKL").alias("_has_pkl"),
        F.when(read, "OCR OK").otherwise("No OCR").alias("_ocr"),
        "_request",
        F.col("_request_at").cast("date").alias("_request_date_link"),
        F.col("_response_at").cast("date").alias("_response_date_link"),
        minute_label("_request_at").alias("_request_date"),
        "_response",
        minute_label("_response_at").alias("_response_date"),
        or_na(blank_to_null("__ext")).alias("_attachment_ext"),
        "_attachment_url",
        "_sla",
        "_sla_hours",
    )


def login_counts(logins: DataFrame) -> DataFrame:
    return logins.groupBy(F.col("user_id").alias("__user")).agg(F.count("*").alias("__logins"))


def user_type(email: str, internal_domain: str):
    own = part(email, "@", 2) == internal_domain
    return F.when(own, "INTERNAL").otherwise("EXTERNAL")


def portal_users(tables: Mapping[str, DataFrame], internal_domain: str, admin_role: str) -> DataFrame:
    """One row per portal user, company and branch; login counts repeat on each.

    ``internal_domain`` is the mail domain of own staff, ``admin_role`` the role
    left out of the report.
    """
    u = tables["portal_user"].where(F.col("role") != admin_role)
    member = tables["companies_on_users"].select(F.col("user_id").alias("__member"), F.col("company_id").alias("__of"))
    company = tables["company"].where(F.col("name").isNotNull()).select(
        F.col("id").alias("__company"), F.col("name").alias("__company_name"), "ext_id"
    )
    branch = tables["company_branch"].select(
        F.col("company_id").alias("__branch_of"), F.col("name").alias("_branch"), "country", "city"
    )
    contact = tables["contacts"].select(
        F.col("id").alias("__contact"), F.col("name").alias("__contact_name"), "account_manager_name", "iss_domain",
        "customer_accounting_id", "tax_id",
    )
    org = tables["organization"].select(F.col("id").alias("__org"), F.col("name").alias("__org_name"))
    # A company may have very many branches: they fan out on the company's side, behind inner joins.
    offices = fanout_left_join(company, branch, [("__company", "__branch_of")])
    rows = (
        u.join(member, F.col("id") == F.col("__member"))
        .join(offices, F.col("__of") == F.col("__company"))
        .join(login_counts(tables["user_login_history"]), F.col("id") == F.col("__user"), "left")
        .join(contact, F.col("ext_id") == F.col("__contact"), "left")
        .join(org, F.col("organization_id") == F.col("__org"), "left")
    )
    return rows.select(
        F.col("id").alias("_user_id"),
        F.upper("name").alias("_user_name"),
        F.col("role").alias("_user_role"),
        user_type("email", internal_domain).alias("_user_type"),
        F.upper("email").alias("_user_email"),
        captured("email", "test").alias("_is_test"),
        F.col("created_at").cast("date").alias("_user_created_date"),
        F.upper("__company_name").alias("_company"),
        "_branch",
        F.upper("country").alias("_branch_country"),
        F.upper("city").alias("_branch_city"),
        activity_bucket("__logins").alias("_active"),
        F.upper(or_na("__contact_name")).alias("_company_focus"),
        F.trim("customer_accounting_id").alias("_accounting_id_focus"),
        F.trim("tax_id").alias("_tax_id_focus"),
        clean_upper("account_manager_name").alias("_account_manager_focus"),
        or_na("iss_domain").alias("_iss_dom"),
        or_na("account_manager_name").alias("_acc_manager"),
        F.col("__org_name").alias("name"),
    )

