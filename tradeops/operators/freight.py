"""Freight units, payload resolution, places and carriers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payload import CUSTOM_DATES, checked_payload, parse_payload, payload_or_plan, payload_state, repeated_names
from ..functions.text import joined, part
from .grouping import times
from .ranking import list_rows

LAND_PORT = "Jebel Ali"  # fixed value: the one land gateway
UNKNOWN_PLACE = "TBA"  # fixed value: placeholder for places not yet known


def distinct_links(links: DataFrame) -> DataFrame:
    """Order line x freight unit x ordering company, without repeats."""
    return links.select("purchase_order_id", "freight_unit_id", "purchase_order_company_id").distinct()


SIDES = (("own", "iss_domain", "shipment_response"), ("remote", "remote_iss_domain", "remote_shipment_response"))


def payload_sides(enrich: DataFrame, own: str = SIDES[0][2], remote: str = SIDES[1][2], kept: tuple[str, ...] = ("unit_no",)) -> DataFrame:
    """(kept.., side, domain, payload): both sides of a unit's shipment as rows, from one scan of the unit."""
    pairs = [
        F.struct(F.lit(side).alias("side"), F.col(domain).alias("domain"), F.col(payload).alias("payload"))
        for (side, domain, _), payload in zip(SIDES, (own, remote))
    ]
    return enrich.select(*kept, F.inline(F.array(*pairs)))


def payload_arms(enrich: DataFrame, own: str = SIDES[0][2], remote: str = SIDES[1][2]) -> DataFrame:
    """(unit_no, domain, payload) for both sides of a unit's shipment; ``own`` and ``remote`` name its payloads."""
    return payload_sides(enrich, own, remote).where(F.col("domain").isNotNull()).drop("side")


def plan_serials(enrich: DataFrame) -> DataFrame:
    """Units with the serials both payloads name, `__in` (own) and `__out` (remote), in place of their texts."""
    own, remote = (parse_payload(payload)["serial_no"] for _, _, payload in SIDES)
    return enrich.withColumns({"__in": own, "__out": remote}).drop(*[payload for _, _, payload in SIDES])


def resolve_payload(
    units: DataFrame, enrich: DataFrame, unit: str, domain: str, name: str = "_payload",
    domains: DataFrame | None = None, read: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Give each unit the payload of the side its ordering company's domain matches.

    Own and remote side can both match (two rows); with neither the payload is
    NULL. One equi-join over the two sides instead of a correlated union.
    ``domains`` (one column) lists every domain of ``units``; sides of others meet no unit and are left out at once.
    ``read`` replaces the text by what is needed of it before the join, row by row, so that no text travels.
    """
    arms = payload_arms(enrich)
    if domains is not None:
        known = domains.select(F.col(domains.columns[0]).alias("__known")).distinct()
        arms = arms.join(known, F.col("domain") == F.col("__known"), "left_semi")
    arms = arms.select(
        F.col("unit_no").alias("__arm_unit"), F.col("domain").alias("__arm_domain"), F.col("payload").alias(name)
    )
    if read is not None:
        arms = read(arms)
    cond = (F.col(unit) == F.col("__arm_unit")) & (F.col(domain) == F.col("__arm_domain"))
    return units.join(arms, cond, "left").drop("__arm_unit", "__arm_domain")


def payload_defects(enrich: DataFrame) -> DataFrame:
    """(unit_no, side, state, repeated) of both payloads of every unit: see `payload_state` and `repeated_names`.

    Without it a text that is no JSON looks like a unit that has not shipped.
    """
    rows = payload_sides(enrich).withColumn("__p", checked_payload("payload"))
    return rows.select(
        "unit_no", "side", payload_state("payload", "__p").alias("state"),
        repeated_names("__p.custom_dates", list(CUSTOM_DATES.values())).alias("repeated"),
    )


def places(ports: DataFrame, airports: DataFrame, port_names: DataFrame) -> DataFrame:
    """One row per place code with everything the lookups need.

    Sea ports, airports and code names are merged by a single aggregate, so a
    freight row needs one join per end of its journey instead of three.
    """
    sea = ports.select(
        F.col("port").alias("code"), F.lit("sea").alias("kind"), "country", "region", F.lit(None).cast("string").alias("name")
    )
    air = airports.select(
        F.col("airport").alias("code"), F.lit("air").alias("kind"), "country", "region", F.lit(None).cast("string").alias("name")
    )
    named = port_names.select(
        "code", F.lit("name").alias("kind"), F.lit(None).cast("string").alias("country"),
        F.lit(None).cast("string").alias("region"), "name",
    )
    is_sea, is_air = F.col("kind") == "sea", F.col("kind") == "air"
    area = F.struct("country", "region")
    return (
        sea.unionByName(air)
        .unionByName(named)
        .where(F.col("code").isNotNull())
        .groupBy("code")
        .agg(
            F.min("name").alias("name"),
            F.min(F.when(is_sea, area)).alias("sea"),
            F.min(F.when(is_air, area)).alias("air"),
            F.min(F.when(is_sea | (is_air & (F.col("code") != UNKNOWN_PLACE)), area)).alias("any"),
        )
    )


def country_names(countries: DataFrame) -> DataFrame:
    return countries.groupBy(F.col("iso_2_char_code").alias("code")).agg(F.max("country_name").alias("country_name"))


def _area(field: str, service: Column, serial: Column, land: Column) -> Column:
    mode = part(service, "_", 1)
    found = F.when(serial.isNull() & mode.isin("sea", "air"), F.col(f"__place.any.{field}"))
    found = found.when((mode == "sea") & serial.isNotNull(), F.col(f"__place.sea.{field}"))
    found = found.when((mode == "air") & serial.isNotNull(), F.col(f"__place.air.{field}"))
    return F.upper(found.when(land, F.lit(LAND_PORT)).otherwise(F.lit(UNKNOWN_PLACE)))


def _join_place(df: DataFrame, dim: DataFrame, code: str) -> DataFrame:
    side = dim.select(F.col("code").alias("__code"), F.struct("name", "sea", "air", "any").alias("__place"))
    return df.join(side, F.col(code) == F.col("__code"), "left")


def origin_place(df: DataFrame, dim: DataFrame, service: str, serial: str, planned: str, actual: str) -> DataFrame:
    """Origin port, name, country and region.

    Quirk kept: name and country know only the inbound land service, the region
    knows every land service.
    """
    service_c, serial_c = F.col(service), F.col(serial)
    mode = part(service_c, "_", 1)
    inbound, any_land = service_c == "land_inbound", mode == "land"
    df = df.withColumn("_origin_port_pol", payload_or_plan(serial, actual, planned))
    df = _join_place(df, dim, "_origin_port_pol")
    name = F.when(mode.isin("sea", "air"), F.col("__place.name")).when(inbound, F.lit(LAND_PORT)).otherwise(F.lit(UNKNOWN_PLACE))
    return df.withColumns(
        {
            "_origin_port_name": F.upper(name),
            "_origin_country": _area("country", service_c, serial_c, inbound),
            "_origin_region_org_reg": _area("region", service_c, serial_c, any_land),
        }
    ).drop("__code", "__place")


def destination_place(
    df: DataFrame, dim: DataFrame, countries: DataFrame, service: str, serial: str, planned_serial: str,
    planned: str, actual: str, planned_country: str, actual_country: str,
) -> DataFrame:
    """Destination port, name, region and country.

    Quirk kept: before the payload names a shipment, the name needs the plan's
    own shipment serial.
    """
    service_c, serial_c = F.col(service), F.col(serial)
    mode = part(service_c, "_", 1)
    land = mode == "land"
    df = df.withColumns(
        {
            "_destination_port_code_dest": payload_or_plan(serial, actual, planned),
            "_destination_country_code_dest": payload_or_plan(serial, actual_country, planned_country),
        }
    )
    df = _join_place(df, dim, "_destination_port_code_dest")
    known = mode.isin("sea", "air") & (serial_c.isNotNull() | F.col(planned_serial).isNotNull())
    name = F.when(known, F.col("__place.name")).when(land, F.lit(LAND_PORT)).otherwise(F.lit(UNKNOWN_PLACE))
    df = df.withColumns(
        {
            "_destination_port_name_dest": F.upper(name),
            "_destination_region_reg": _area("region", service_c, serial_c, land),
        }
    ).drop("__code", "__place")
    side = country_names(countries).select(F.col("code").alias("__code"), F.upper("country_name").alias("_destination_country_dest"))
    return df.join(side, F.col("_destination_country_code_dest") == F.col("__code"), "left").drop("__code")


def carrier_codes(carriers: DataFrame) -> DataFrame:
    """One row per alias code of a carrier; carriers without aliases drop out."""
    return carriers.select(F.col("name").alias("_carrier"), F.explode("all_scacs").alias("__scac"))


def carrier_lookup(df: DataFrame, carriers: DataFrame, code: str) -> DataFrame:
    return df.join(carrier_codes(carriers), F.col(code) == F.col("__scac"), "left").drop("__scac")


def labelled_documents(attachments: DataFrame, label: str, name: str = "_rows") -> DataFrame:
    """Uploaded attachments of one label, counted per parent."""
    return (
        attachments.where((F.col("label") == label) & (F.col("uploaded").cast("int") == 1))
        .groupBy(F.col("parent_id").alias("__parent"))
        .agg(F.count("*").alias(name))
    )


def inner_quantity_text(links: DataFrame, lines: DataFrame, sep: str = " | ") -> DataFrame:
    """Quantity text per freight unit: a total if it carries one link, else
    '<order> - <item> - <quantity>' for each of them."""
    items = lines.select(F.col("id").alias("__line"), "po_no", "item_code")
    entry = joined("po_no", F.lit(" - "), "item_code", F.lit(" - "), "quantity")
    rows = links.join(items, F.col("purchase_order_id") == F.col("__line"), "left").withColumn("__entry", entry)
    counted = rows.groupBy("freight_unit_id", "__entry").agg(
        F.count("*").alias("__n"), F.sum("quantity").alias("__quantity")
    )
    shown = F.when(F.col("__entry").isNotNull(), F.struct(F.col("__entry").alias("v"), times(F.col("__entry"), F.col("__n"), sep).alias("t")))
    per_unit = counted.groupBy("freight_unit_id").agg(
        F.sum("__n").alias("__links"),
        F.sum("__quantity").cast("string").alias("__single"),
        F.sort_array(F.collect_list(shown)).alias("__vs"),
    )
    several = F.nullif(F.array_join(F.col("__vs.t"), sep), F.lit(""))
    return per_unit.select(
        F.col("freight_unit_id").alias("__fu"), F.when(F.col("__links") > 1, several).otherwise(F.col("__single")).alias("_inner_qty")
    )


def inner_quantity_rows(links: DataFrame, lines: DataFrame) -> DataFrame:
    """(freight_unit_id, position, value, times): what a unit carries, '<order> - <item> - <quantity>', as child rows."""
    items = lines.select(F.col("id").alias("__line"), "po_no", "item_code")
    value = joined("po_no", F.lit(" - "), "item_code", F.lit(" - "), "quantity")
    rows = links.join(items, F.col("purchase_order_id") == F.col("__line"), "left").withColumn("value", value)
    return list_rows(rows, ["freight_unit_id"], "value")


def cargo_ready_estimates(details: DataFrame) -> DataFrame:
    """Latest 'Estimated Cargo Date' per shipment serial from tracking details."""
    updates = F.from_json("statuses", "array<struct<status:string,date:string>>")
    return (
        details.select(
            F.get_json_object("shipment_details", "$.serial_no").alias("serial_no"), F.explode(updates).alias("s")
        )
        .where(F.col("s.status") == "Estimated Cargo Date")
        .groupBy("serial_no")
        .agg(F.max("s.date").try_cast("date").alias("_est_cargo_ready_date"))
    )


def transit_master(times_: DataFrame) -> DataFrame:
    return times_.select(F.col("code").alias("__country"), F.col("average_transit_time").alias("_country_lead_time"))

