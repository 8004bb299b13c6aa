"""Intercompany reconciliation: accruals, loans, payments and both document sides."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, clean_upper, joined, lacks, or_na, surely_matches, surrogate_key
from ..operators.access import visible_to
from ..operators.grouping import attach_totals
from ..operators.recon import (
    AUTO,
    CODE_LENGTH,
    DOCUMENT_IDS,
    PAYABLES,
    PAYABLES_CORRECTED,
    RECEIVABLES,
    Side,
    Templates,
    credit_note_match,
    document_ledger,
    document_links,
    payment_side,
    settlement_split,
    with_document_ids,
)
from ..sources.staging import staged
from .access_lists import ic_entitlements

ACCRUAL_ACCOUNT = 21015  # fixed value
LOAN_ACCOUNTS = (15002, 15003, 23002, 24101, 12200, 20200)  # fixed values
YEAR_END = r"ye\d\d"  # fixed value: vouchers of year-end closings


def _group_codes() -> Column:
    return (F.length("dataarea") <= CODE_LENGTH) & (F.length("counterparty") <= CODE_LENGTH)


def ic_accruals(tables: Mapping[str, DataFrame], account: int = ACCRUAL_ACCOUNT) -> DataFrame:
    """Accrual entries between group companies, without year-end vouchers."""
    rows = tables["journal_accruals"].where(
        (F.col("mainaccount") == account) & _group_codes() & lacks("voucher", YEAR_END)
    )
    key = ["voucher", F.lit("_"), "dataarea", F.lit("-"), "counterparty"]
    rows = attach_totals(rows, ["voucher"], {"_rows": F.count("*")})
    return rows.select(
        F.col("voucher").alias("_voucher"),
        joined(*key).alias("_row_id"),
        surrogate_key(*key).alias("md5"),
        F.upper("dataarea").alias("_vendor"),
        F.upper("counterparty").alias("_client"),
        F.col("accountingdate").cast("date").alias("_date"),
        F.col("transactioncurrencyamount").alias("_amount"),
        F.col("transactioncurrencycode").alias("_currency"),
        "_rows",
    )


def ic_loans(tables: Mapping[str, DataFrame], accounts: tuple[int, ...] = LOAN_ACCOUNTS) -> DataFrame:
    """Loan-account entries with cleaned company codes."""
    rows = tables["journal_accruals"].where(F.col("mainaccount").isin(*accounts) & _group_codes())
    rows = rows.withColumns(
        {"_vendor": clean_upper("dataarea"), "_client": clean_upper(or_na(blank_to_null("counterparty")))}
    )
    key = ["voucher", F.lit("_"), "_vendor", F.lit("_"), "_client"]
    return rows.select(
        "_vendor",
        "_client",
        F.col("mainaccount").alias("_account"),
        F.col("voucher").alias("_voucher"),
        joined(*key).alias("_doc_id"),
        surrogate_key(*key).alias("_md5"),
        F.col("generaljournalaccountentryrecid").alias("_record_id"),
        F.col("accountingdate").cast("date").alias("_date"),
        F.col("transactioncurrencyamount").alias("_amount"),
        F.col("transactioncurrencycode").alias("_currency"),
    )


def ic_payments(tables: Mapping[str, DataFrame], not_accounts: tuple[int, ...] = LOAN_ACCOUNTS) -> DataFrame:
    """Payment vouchers outside the loan accounts; the voucher text names the side."""
    rows = tables["journal_accruals"].where(
        surely_matches("voucher", "bvp|bcr") & ~F.col("mainaccount").isin(*not_accounts)
    )
    rows = rows.withColumns({"_payer": F.upper("dataarea"), "_payee": F.upper("counterparty")})
    key = ["voucher", F.lit("_"), "_payer", F.lit("-"), "_payee"]
    return rows.select(
        payment_side("voucher").alias("_side"),
        F.lit("PAYMENT").alias("_doc_type"),
        F.col("accountingdate").cast("date").alias("_date"),
        F.col("voucher").alias("_doc"),
        joined(*key).alias("_doc_id"),
        surrogate_key(*key).alias("_md5"),
        "_payer",
        "_payee",
        F.col("transactioncurrencycode").alias("_cur"),
        F.col("transactioncurrencyamount").alias("_amount"),
    )


def _settled(tables: Mapping[str, DataFrame], txns: DataFrame, side: Side, swapped: bool, viewer: str | None) -> tuple[DataFrame, list[str]]:
    """A side's documents without ids and links, and the names of their ledger columns. Steps read them several times, so they
    are staged before and behind; rows stay narrow. A document is matched with credit notes or split by settlements, as its label says.
    """
    docs = document_ledger(txns, tables["branch_domain"], side)
    published = docs.columns
    if viewer is not None:
        docs = visible_to(docs, ["_vendor", "_client"], ic_entitlements(tables), "_office", "_email", viewer)
    docs = staged(docs.drop(*DOCUMENT_IDS), "ledger-documents")
    posted = F.col("_src") == AUTO
    matched = credit_note_match(docs.where(~posted), txns, side, swapped)
    docs = matched.unionByName(settlement_split(docs.where(posted), txns, side, swapped), allowMissingColumns=True)
    return staged(docs, "settled-documents"), published


def _linked(tables: Mapping[str, DataFrame], docs: DataFrame, published: list[str], templates: Templates) -> DataFrame:
    docs = document_links(
        docs, tables["issued_invoices"], tables["issued_credit_notes"], tables["attachments"], templates
    )
    return with_document_ids(docs).select(
        *published, "_credit_note_match_manual", "_cancel_amount_manual", "_amount_settle_negative",
        "_amount_settle_positive", "_url", "_url_vault",
    )


def _payables(tables: Mapping[str, DataFrame], faithful: bool, viewer: str | None = None) -> tuple[DataFrame, list[str]]:
    return _settled(tables, tables["vendor_transactions"], PAYABLES if faithful else PAYABLES_CORRECTED, faithful, viewer)


def _receivables(tables: Mapping[str, DataFrame], viewer: str | None = None) -> tuple[DataFrame, list[str]]:
    return _settled(tables, tables["customer_transactions"], RECEIVABLES, False, viewer)


def ic_client_side(
    tables: Mapping[str, DataFrame], templates: Templates = Templates(), faithful: bool = True, viewer: str | None = None
) -> DataFrame:
    """Payables documents, or those that ``viewer`` (an e-mail address of the office list) may see.

    ``faithful=False`` corrects the kept quirks: journal documents get their own
    label, keys are compared straight, and rows without any document are left out.
    """
    return _linked(tables, *_payables(tables, faithful, viewer), templates)


def ic_vendor_side(tables: Mapping[str, DataFrame], templates: Templates = Templates(), viewer: str | None = None) -> DataFrame:
    """Receivables documents, or those that ``viewer`` may see."""
    return _linked(tables, *_receivables(tables, viewer), templates)


def ic_both_sides(tables: Mapping[str, DataFrame], templates: Templates = Templates(), faithful: bool = True) -> DataFrame:
    """Documents of both ledgers; ``_side`` tells them apart. They meet their links together: these are made and sorted once."""
    (client, published), (vendor, _) = _payables(tables, faithful), _receivables(tables)
    both = client.withColumn("_side", F.lit("PAYABLES")).unionByName(vendor.withColumn("_side", F.lit("RECEIVABLES")))
    linked = _linked(tables, both, [*published, "_side"], templates)
    return linked.select(*[c for c in linked.columns if c != "_side"], "_side")
