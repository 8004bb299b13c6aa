"""Intercompany reconciliation: ledger documents, links, credit notes, settlements."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import choose, flag_set, joined, part, surrogate_key
from ..sources.staging import staged
from .grouping import spread_left_join

MANUAL, AUTO = "MANUAL DOCS.", "AUTO DOCS."  # fixed values
CODE_LENGTH = 4  # fixed value: longest code of a group company


@dataclass(frozen=True)
class Side:
    """Which ledger a reconciliation reads and how its documents are named."""

    account: str  # account column of the transactions
    manual_type: str  # transaction type of manual documents
    account_role: str  # published name of the account
    company_role: str  # published name of the company
    auto_label: str  # label of journal documents
    require_document: bool  # leave out rows without invoice and voucher
    vendor_is_account: bool


# Quirks kept: payables label journal documents as manual, and keep rows
# without any document.
PAYABLES = Side("vendor_account", "VENDOR", "_vendor", "_client", MANUAL, False, True)
RECEIVABLES = Side("customer_account", "CUSTOMER", "_client", "_vendor", AUTO, True, False)
PAYABLES_CORRECTED = Side("vendor_account", "VENDOR", "_vendor", "_client", AUTO, True, True)


@dataclass(frozen=True)
class Templates:
    """Patterns of published links; hosts are the deployment's own."""

    attachment: str = "https://%s.example.com/attachments/%s"
    invoice: str = "https://vault.example.com/invoice/inv%s"
    credit_note: str = "https://vault.example.com/invoice/icn%s"
    free_text: str = "https://files.example.com/%s/%s.pdf"


def transaction_type(c: str = "transaction_type") -> Column:
    return F.upper(F.col(c))


def document_ledger(txns: DataFrame, mapping: DataFrame, side: Side) -> DataFrame:
    """Manual and journal documents between group companies.

    Both kinds come from one scan; the kind is a label, not a second arm.
    """
    kind, account, company = transaction_type(), F.col(side.account), F.col("company")
    document = F.coalesce("invoice", "voucher")
    vendor, client = (account, company) if side.vendor_is_account else (company, account)
    domains = mapping.groupBy(F.col("company").alias("__company")).agg(F.max("iss_domain").alias("_iss_domain"))
    rows = txns.where(kind.isin(side.manual_type, "GENERAL JOURNAL") & (F.length(account) <= CODE_LENGTH))
    if side.require_document:
        rows = rows.where(document.isNotNull())
    rows = rows.join(domains, company == F.col("__company"), "left")
    return rows.select(
        F.when(kind == side.manual_type, F.lit(MANUAL)).otherwise(F.lit(side.auto_label)).alias("_src"),
        account.alias(side.account_role),
        company.alias(side.company_role),
        "_iss_domain",
        document.alias("_invoice"),
        joined(document, F.lit("_"), vendor, F.lit("-"), client).alias("_inv_id"),
        surrogate_key(document, F.lit("_"), vendor, F.lit("-"), client).alias("md5"),
        F.when(F.col("invoice").ilike("%-CN-%"), F.lit("CR. NOTE")).otherwise(F.lit("INVOICE")).alias("_doc_type"),
        F.coalesce(F.col("voucher_date").cast("date"), F.col("posted_date").cast("date")).alias("_post_date"),
        F.col("voucher").alias("_voucher"),
        F.col("voucher_date").cast("date").alias("_voucher_date"),
        F.col("amount").alias("_amount"),
        F.col("currency").alias("_currency"),
        F.col("settled_amount").alias("_settle_amount"),
    )


DOCUMENT_IDS = ("_inv_id", "md5")


def with_document_ids(docs: DataFrame) -> DataFrame:
    """Add the ids of `document_ledger`, which hang on a row's other columns: long texts that need not travel with it."""
    key = ["_invoice", F.lit("_"), "_vendor", F.lit("-"), "_client"]
    return docs.withColumns({"_inv_id": joined(*key), "md5": surrogate_key(*key)})


def shared_attachments(attachments: DataFrame, parent_type: str, templates: Templates) -> DataFrame:
    """(parent, link) of the attachments a customer may open, one row each."""
    url = F.when(
        F.col("id").isNotNull() & F.col("iss_domain").isNotNull(),
        F.format_string(templates.attachment, F.col("iss_domain"), F.col("id").cast("string")),
    )
    shared = attachments.where((F.col("parent_type") == parent_type) & flag_set("shared_with_customer"))
    return shared.select(F.col("parent_id").alias("__parent"), url.alias("__url"))


def link_targets(invoices: DataFrame, credit_notes: DataFrame, attachments: DataFrame, templates: Templates) -> DataFrame:
    """(kind, serial, domain) -> attachment link and vault link, one row per attachment; both kinds in one table.

    Quirk kept: credit notes look their attachments up as if they were
    invoices; their own attachment link is never published, only repeated rows.
    """

    def named(documents: DataFrame, kind: str, vault: str) -> DataFrame:
        return documents.where(F.col("serial_no").isNotNull()).select(
            F.lit(kind).alias("__kind"), F.col("id").cast("long").alias("__id"), F.col("serial_no").alias("__serial"),
            F.col("iss_domain").alias("__domain"), F.format_string(vault, F.col("id").cast("string")).alias("__vault"),
        )

    both = named(invoices, "invoice", templates.invoice).unionByName(named(credit_notes, "credit note", templates.credit_note))
    out = spread_left_join(both, shared_attachments(attachments, "IssuedInvoice", templates), [("__id", "__parent")])
    return out.select("__kind", "__serial", "__domain", "__url", "__vault")


def met_links(invoices: DataFrame, credit_notes: DataFrame, attachments: DataFrame, templates: Templates = Templates()) -> DataFrame:
    """(serial, domain) -> links of invoices, credit notes or both, staged: the same for every ledger."""
    targets = staged(link_targets(invoices, credit_notes, attachments, templates).where(F.col("__domain").isNotNull()), "links")
    inv = targets.where(F.col("__kind") == "invoice").drop("__kind")
    cn = targets.where(F.col("__kind") == "credit note").select(
        F.col("__serial").alias("__cn_serial"), F.col("__domain").alias("__cn_domain"), F.col("__vault").alias("__cn_vault")
    )
    # Links of either kind that share serial and domain meet each other: documents, far more rows, then move once.
    keys = [("__serial", "__cn_serial"), ("__domain", "__cn_domain")]
    listed = inv.select(F.col("__serial").alias("__s"), F.col("__domain").alias("__d")).distinct()
    alone = cn.join(listed, (F.col("__cn_serial") == F.col("__s")) & (F.col("__cn_domain") == F.col("__d")), "left_anti")
    alone = alone.withColumnsRenamed({b: a for a, b in keys})
    met = spread_left_join(inv, cn, keys).drop("__cn_serial", "__cn_domain")
    return staged(met.unionByName(alone, allowMissingColumns=True), "met-links")


def document_links(
    docs: DataFrame, invoices: DataFrame, credit_notes: DataFrame, attachments: DataFrame,
    templates: Templates = Templates(),
) -> DataFrame:
    """Add `_url` and `_url_vault`.

    A document may carry very many attachments, so the joins tolerate hot keys
    on the link side. The links are staged; ``docs`` is read more than once
    and should be staged too.
    """
    links = met_links(invoices, credit_notes, attachments, templates)
    free_text = F.upper(part("_invoice", "-", 2)).isin("FTI", "CN")
    path = F.format_string(templates.free_text, part("_invoice", "-", 1), F.col("_invoice"))
    return (
        spread_left_join(docs, links, [("_invoice", "__serial"), ("_iss_domain", "__domain")])
        .withColumns(
            {"_url": F.col("__url"), "_url_vault": F.when(free_text, path).otherwise(F.coalesce("__vault", "__cn_vault"))}
        )
        .drop("__serial", "__domain", "__url", "__vault", "__cn_vault")
    )


def credit_notes_by_voucher(txns: DataFrame, account: str, manual_type: str) -> DataFrame:
    """Credit notes summed per voucher they settle, account and company."""
    return (
        txns.where(
            F.col("invoice").ilike("%-CN-%")
            & F.col("last_settlement_voucher").isNotNull()
            & (transaction_type() == manual_type)
        )
        .groupBy(
            F.col("last_settlement_voucher").alias("__to_voucher"),
            F.col(account).alias("__cn_account"),
            F.col("company").alias("__cn_company"),
        )
        .agg(F.sum("amount").alias("_cancel_amount_manual"))
    )


def credit_note_match(docs: DataFrame, txns: DataFrame, side: Side, swapped: bool | None = None) -> DataFrame:
    """Match manual documents with the credit notes issued against their voucher.

    Only vouchers that have credit notes can match, so the summed notes are
    joined to their originals first (inner) and the few results, staged, to the
    manual documents. One invoice may stand for very many originals, so that join
    tolerates hot keys on its right side; ``docs`` is read more than once and should be staged.
    Quirk kept for payables: account and company are compared crosswise.
    """
    swapped = side.vendor_is_account if swapped is None else swapped
    notes = credit_notes_by_voucher(txns, side.account, side.manual_type)
    originals = txns.where((transaction_type() == side.manual_type) & F.col("invoice").isNotNull()).select(
        F.col("invoice").alias("__orig_invoice"), F.col("voucher").alias("__orig_voucher"),
        F.col(side.account).alias("__orig_account"), F.col("company").alias("__orig_company"),
    )
    matched = originals.join(
        notes,
        (F.col("__orig_voucher") == F.col("__to_voucher"))
        & (F.col("__orig_account") == F.col("__cn_account"))
        & (F.col("__orig_company") == F.col("__cn_company")),
    ).select(
        "__orig_invoice", "__cn_account", "__cn_company",
        F.lit("MATCHED CN").alias("_credit_note_match_manual"), "_cancel_amount_manual",
    )
    account_is, company_is = (side.company_role, side.account_role) if swapped else (side.account_role, side.company_role)
    pairs = [("_invoice", "__orig_invoice"), (account_is, "__cn_account"), (company_is, "__cn_company")]
    out = spread_left_join(docs, staged(matched, "credit-notes"), pairs, only=F.col("_src") == MANUAL)
    return out.drop("__orig_invoice", "__cn_account", "__cn_company")


def settlement_totals(txns: DataFrame, account: str) -> DataFrame:
    """Negative and positive settlement totals per document, account and company."""
    amount = F.col("amount")
    return (
        txns.where(F.col("invoice").isNotNull() & (transaction_type() == "SETTLEMENT"))
        .groupBy(
            F.col("invoice").alias("__s_invoice"), F.col("transaction_type").alias("__s_type"),
            F.col("currency").alias("__s_currency"), F.col(account).alias("__s_account"),
            F.col("company").alias("__s_company"),
        )
        .agg(
            F.sum(F.when(amount < 0, amount).otherwise(0)).alias("_amount_settle_negative"),
            F.sum(F.when(amount > 0, amount).otherwise(0)).alias("_amount_settle_positive"),
        )
    )


def settlement_split(docs: DataFrame, txns: DataFrame, side: Side, swapped: bool | None = None) -> DataFrame:
    """Add settlement totals to journal documents posted by the logistics system.

    An invoice may be posted very often, so the join to the journal documents tolerates hot keys on its right side;
    ``docs`` is read more than once and should be staged.
    """
    swapped = side.vendor_is_account if swapped is None else swapped
    totals = settlement_totals(txns, side.account)
    journal = txns.where(
        (F.length(side.account) <= CODE_LENGTH)
        & F.col("voucher").ilike("%LOG%")
        & F.col("invoice").isNotNull()
        & (transaction_type() == "GENERAL JOURNAL")
    ).select(
        F.col("invoice").alias("__j_invoice"), F.col(side.account).alias("__j_account"), F.col("company").alias("__j_company")
    )
    settled = journal.join(
        totals,
        (F.col("__j_invoice") == F.col("__s_invoice"))
        & (F.col("__j_account") == F.col("__s_account"))
        & (F.col("__j_company") == F.col("__s_company")),
        "left",
    ).select("__j_invoice", "__j_account", "__j_company", "_amount_settle_negative", "_amount_settle_positive")
    account_is, company_is = (side.company_role, side.account_role) if swapped else (side.account_role, side.company_role)
    pairs = [("_invoice", "__j_invoice"), (account_is, "__j_account"), (company_is, "__j_company")]
    out = spread_left_join(docs, staged(settled, "settlements"), pairs, only=F.col("_src") == AUTO)
    return out.drop("__j_invoice", "__j_account", "__j_company")


def payment_side(voucher: Column | str) -> Column:
    from ..functions.text import surely_matches

    return choose(
        [(surely_matches(voucher, "bvp"), F.lit("CLIENT")), (surely_matches(voucher, "bcr"), F.lit("VENDOR"))]
    )
