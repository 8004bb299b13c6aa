"""Entitlement lists: which user may see which office pair, domain or sales id."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_upper, flag_set, name_key, squeeze, title_words
from ..operators.access import codes_of, grants, observed_pairs
from ..operators.ranking import dense_ids

OFFICE_CODE_LENGTH = 5  # fixed value


def office_codes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every office code seen as a company or as a short account code."""
    v, c = tables["vendor_transactions"], tables["customer_transactions"]
    return codes_of(
        [
            (v, "company", None),
            (v, "vendor_account", OFFICE_CODE_LENGTH),
            (c, "company", None),
            (c, "customer_account", OFFICE_CODE_LENGTH),
        ],
        "_name",
    )


def office_pairs(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Pairs of offices that deal with each other, with the key that links both directions."""
    v, c = tables["vendor_transactions"], tables["customer_transactions"]
    return observed_pairs(
        [(v, "company", "vendor_account", OFFICE_CODE_LENGTH), (c, "company", "customer_account", OFFICE_CODE_LENGTH)]
    )


def ic_entitlements(tables: Mapping[str, DataFrame]) -> DataFrame:
    """User x office: local users see the pairs of their office, global users those of every office (`*`).

    With ``office_pairs`` this resolves to the pairs a user sees, without listing each pair for each user.
    """
    everyone = tables["global_entitlement"].select(F.col("email").alias("_email"))
    local = tables["office_entitlement"].select(F.upper("email").alias("_email"), F.upper("office").alias("_office"))
    known = office_codes(tables).select(F.col("_name").alias("_office"))
    return grants(local.join(known, "_office", "left_semi").select("_email", "_office"), everyone, "_office")


def login_entitlements(tables: Mapping[str, DataFrame]) -> DataFrame:
    """User x domain, sorted by user; global users have the domain `*`."""
    everyone = tables["global_entitlement"].select(F.upper("email").alias("_email"))
    listed = tables["login_local_entitlement"].select(F.upper("email").alias("__listed")).distinct()
    local = (
        tables["crm_users"]
        .where(flag_set("active"))
        .select(F.upper("email").alias("_email"), "iss_domain")
        .join(listed, F.col("_email") == F.col("__listed"), "left_semi")
    )
    return grants(local, everyone, "iss_domain").orderBy("_email")


def sales_ids(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Budgeted sellers' name keys, numbered in order."""
    budget = tables["budget_sales"].select(F.upper(F.trim(squeeze(F.trim(F.col("sales_user"))))).alias("__key"))
    return dense_ids(budget, "__key", "_id")


def sales_entitlements(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Sales id x user: every budgeted seller sees the own id; global users see all, which is one row without an id.

    The ids equal those of the gross-profit report: both number the same names.
    """
    ids = sales_ids(tables)
    mail = (
        tables["crm_users"]
        .groupBy(name_key("name").alias("__name"))
        .agg(F.max("email").alias("__mail"))
    )
    local = ids.join(mail, F.col("__key") == F.col("__name"), "left").select(
        "_id",
        title_words(F.replace(F.col("__key"), F.lit("_"), F.lit(" "))).alias("_user"),
        clean_upper("__mail").alias("_email"),
    )
    everyone = tables["sales_global_entitlement"].select(
        F.lit(None).cast("long").alias("_id"), F.col("name").alias("_user"), F.col("email").alias("_email")
    )
    return local.unionByName(everyone)

