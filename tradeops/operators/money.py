"""Charges, customs values and currency conversion."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_label
from ..functions.text import clean_upper, flag_set, part
from .grouping import join_groups, times
from .ranking import list_rows

LOCAL_CURRENCY = "AED"  # fixed value
CHARGE_FX_DATE = dt.date(2025, 3, 13)  # fixed value: snapshot used for charges
CUSTOMS_FX_DATE = dt.date(2025, 9, 30)  # fixed value: snapshot used for customs
CUSTOMS_USD_FACTOR = 3.6  # fixed value

# Output stem -> charge category.
CHARGE_CLASSES = {
    "_org_charges": "Origin Charge",
    "_dest_charges": "Destination Charge",
    "_frt_charges": "Freight Charge",
    "_aux_charges": "Ancillary Charge",
}
AUX_CLASS = "Ancillary Charge"


def first_invoice_id(c: Column | str) -> Column:
    """First id of a '12.0,13.0' list; every '.0' is stripped, blanks give NULL."""
    return F.replace(part(c, ",", 1), F.lit(".0"), F.lit("")).try_cast("bigint")


def charge_lines(
    shipments: DataFrame, items: DataFrame, mapping: DataFrame, invoices: DataFrame, rates: DataFrame,
    currencies: DataFrame, fx_date: dt.date,
) -> DataFrame:
    """Charge items with shipment, category, USD factor and invoice.

    Items are the streamed side of inner joins to shipments, so a shipment with
    very many items is a hot key that adaptive execution can split.
    """
    ship = shipments.select(
        F.col("id").alias("__ship"), F.col("serial_no").alias("__serial"),
        F.col("operational_status").alias("__status"), F.col("iss_domain").alias("__domain"),
        clean_upper("service").alias("__service"),
    )
    fx = (
        currencies.select(F.col("iss_domain").alias("__fx_domain"), "currency")
        .join(
            rates.where(F.col("d") == F.lit(fx_date)).select(F.col("cur2").alias("__cur"), "exchange_rate"),
            F.col("currency") == F.col("__cur"),
            "left",
        )
        .select("__fx_domain", F.col("exchange_rate").alias("__fx"))
    )
    classes = mapping.where(F.col("status") == "Active").select(
        clean_upper("service").alias("__m_service"), clean_upper("charge").alias("__m_charge"),
        F.col("category").alias("__class"),
    )
    bills = invoices.where(flag_set("voided") == F.lit(False)).select(
        F.col("id").alias("__invoice"), F.col("iss_domain").alias("__inv_domain"),
        F.col("serial_no").alias("__inv_serial"), month_label(F.col("issue_date").cast("date")).alias("__month"),
    )
    lines = items.select(
        "shipment_id", "iss_domain", "currency", "selling_rate", "selling_quantity", "selling_local_exchange_rate",
        "extra_info", clean_upper("charge_name").alias("__charge"),
        first_invoice_id("customer_invoice_id").alias("__item_invoice"),
    ).withColumnRenamed("currency", "__item_cur")
    return (
        lines.join(ship, (F.col("shipment_id") == F.col("__ship")) & (F.col("iss_domain") == F.col("__domain")))
        .join(fx, F.col("__domain") == F.col("__fx_domain"), "left")
        .join(
            classes,
            (F.col("__service") == F.col("__m_service")) & (F.col("__charge") == F.col("__m_charge")),
            "left",
        )
        .join(
            bills,
            (F.col("__item_invoice") == F.col("__invoice")) & (F.col("iss_domain") == F.col("__inv_domain")),
            "left",
        )
    )


def with_units(shipments: DataFrame, units: DataFrame | None) -> DataFrame:
    """Shipments that a freight unit names."""
    if units is None:
        return shipments
    named = units.select(F.col("shipment_serial_no").alias("__serial")).where(F.col("__serial").isNotNull()).distinct()
    return shipments.join(named, F.col("serial_no") == F.col("__serial"), "left_semi")


def charge_lists(
    shipments: DataFrame, items: DataFrame, mapping: DataFrame, invoices: DataFrame, rates: DataFrame,
    currencies: DataFrame, units: DataFrame | None = None, fx_date: dt.date = CHARGE_FX_DATE,
) -> DataFrame:
    """(_ship_id, list, position, value, times): the lists of `charge_pivot` as child rows, however long they are."""
    rows = charge_lines(with_units(shipments, units), items, mapping, invoices, rates, currencies, fx_date)
    aux, other = F.col("__class") == AUX_CLASS, F.col("__class") != AUX_CLASS
    lists = {
        "_aux_charge_type": (aux, "extra_info"), "_issued_invoices": (other, "__inv_serial"), "_issue_date": (other, "__month"),
        "_addl_issued_invoices": (aux, "__inv_serial"), "_addl_issue_date": (aux, "__month"),
    }
    entries = [F.struct(F.lit(name).alias("list"), F.when(cond, F.col(c)).alias("value")) for name, (cond, c) in lists.items()]
    entries_ = rows.select(F.col("__ship").alias("_ship_id"), F.inline(F.array(*entries)))
    return list_rows(entries_, ["_ship_id", "list"], "value")


def charge_pivot(
    shipments: DataFrame, items: DataFrame, mapping: DataFrame, invoices: DataFrame, rates: DataFrame,
    currencies: DataFrame, units: DataFrame | None = None, fx_date: dt.date = CHARGE_FX_DATE,
    classes: dict[str, str] = CHARGE_CLASSES, local_for_all: bool = False, sep: str = " | ",
) -> DataFrame:
    """Charges per shipment by class in USD and local currency, with text lists.

    Quirk kept: local amounts add up USD items only, unless ``local_for_all``.
    Amounts and texts are first reduced per (shipment, class, texts), so a
    shipment's final row is built from distinct texts, not from all its items.
    """
    wanted = with_units(shipments, units)
    is_usd = F.col("__item_cur") == "USD"
    value = F.col("selling_rate") * F.col("selling_quantity")
    local = value * F.col("selling_local_exchange_rate")
    rows = charge_lines(wanted, items, mapping, invoices, rates, currencies, fx_date)
    head = ["__ship", "__serial", "__status"]
    reduced = rows.groupBy(*head, "__class", "extra_info", "__inv_serial", "__month").agg(
        F.sum(F.when(is_usd, value).when(~is_usd, local * F.col("__fx"))).alias("__usd"),
        F.sum(local if local_for_all else F.when(is_usd, local)).alias("__local"),
        F.count("*").alias("__n"),
    )
    aux, other = F.col("__class") == AUX_CLASS, F.col("__class") != AUX_CLASS

    def cell(cond: Column, c: str, name: str) -> Column:
        entry = F.struct(F.col(c).alias("v"), times(F.col(c), F.col("__n"), sep).alias("t"))
        entries = F.sort_array(F.collect_list(F.when(cond & F.col(c).isNotNull(), entry)))
        return F.nullif(F.array_join(F.transform(entries, lambda e: e["t"]), sep), F.lit("")).alias(name)

    sums = []
    for stem, label in classes.items():
        chosen = F.col("__class") == label
        sums.append(F.sum(F.when(chosen, F.col("__usd"))).alias(f"{stem}_usd"))
        sums.append(F.sum(F.when(chosen, F.col("__local"))).alias(f"{stem}_local"))
    per_shipment = reduced.groupBy(*head).agg(
        *sums,
        cell(aux, "extra_info", "_aux_charge_type"),
        cell(other, "__inv_serial", "_issued_invoices"),
        cell(other, "__month", "_issue_date"),
        cell(aux, "__inv_serial", "_addl_issued_invoices"),
        cell(aux, "__month", "_addl_issue_date"),
    )
    every = wanted.select(
        F.col("id").alias("__ship"), F.col("serial_no").alias("__serial"), F.col("operational_status").alias("__status")
    ).distinct()
    return join_groups(every, per_shipment, head).withColumnsRenamed(
        {"__ship": "_ship_id", "__serial": "_ship_serial", "__status": "_ship_focus_status"}
    )


def customs_values(
    customs: DataFrame, rates: DataFrame, local: str = LOCAL_CURRENCY, fx_date: dt.date = CUSTOMS_FX_DATE,
    usd_factor: float = CUSTOMS_USD_FACTOR,
) -> DataFrame:
    """Declared customs value per declaration in local currency and "USD".

    Quirk kept: a value declared locally is published unchanged under both
    names, any other is multiplied by the rate and, for USD, by the factor.
    """
    snapshot = rates.where(
        (F.col("created_at").cast("date") == F.lit(fx_date))
        & (F.col("cost_exchange_rate") != local)
        & (F.col("selling_exchange_rate") == local)
    ).select(F.col("cost_exchange_rate").alias("__cur"), F.coalesce("from_rate", "to_rate").alias("__rate"))
    declared = customs.where(
        F.col("declaration_value").isNotNull()
        & F.col("bill_of_entry_date").isNotNull()
        & F.col("declaration_currency").isNotNull()
    )
    native = F.col("declaration_currency") == local
    value = F.col("declaration_value")
    return declared.join(snapshot, F.col("declaration_currency") == F.col("__cur"), "left").select(
        F.col("shipment_id").alias("__customs_ship"),
        F.when(native, value).otherwise(value * F.col("__rate")).alias("_amount_aed"),
        F.when(native, value).otherwise(value * F.col("__rate") * F.lit(usd_factor)).alias("_amount_usd"),
    )


def usd_rates(rates: DataFrame) -> DataFrame:
    return rates.where(F.col("tocurrency") == "USD").select(
        F.col("fromcurrency").alias("__from"), F.col("startdate").alias("__rate_day"), F.col("exrate").alias("__rate")
    )


def fx_to_usd(ledger: DataFrame, rates: DataFrame, scale: int = 3) -> DataFrame:
    """Ledger amounts in USD by the day's rate.

    Quirk kept: without a rate the reporting-currency amount stands in.
    """
    cond = (F.col("accountingcurrency") == F.col("__from")) & (F.col("accountingdate") == F.col("__rate_day"))
    own, reported = F.col("accountingcurrencyamount_inv"), F.col("reportingcurrencyamount_inv")
    return (
        ledger.join(usd_rates(rates), cond, "left")
        .withColumns(
            {
                "_amount_usd": F.round(F.coalesce(own * F.col("__rate"), reported), scale),
                "_amount": F.round(F.coalesce(own, reported), scale),
            }
        )
        .drop("__from", "__rate_day", "__rate")
    )
