"""Shipment payloads: JSON text parsed once, then picked apart with array functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dates import date_groups, safe_day
from .text import col

_TEXT_FIELDS = """
serial_no id service shipping_terms house_no master_no master_spo_no carrier operational_status
origin_port destination_port origin_country destination_country
arrival_date loading_date delivery_date pickup_date
pta_date ptd_date eta_date etd_date eta_wakeo_date etd_wakeo_date
gross_volume gross_weight chargeable_weight package_count equipment
""".split()


def _pairs(*names: str) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in names]))


# ``equipment`` stays text: it is either a JSON array or a string holding one.
PAYLOAD = T.StructType(
    [T.StructField(n, T.StringType()) for n in _TEXT_FIELDS]
    + [
        T.StructField("equipment_details", _pairs("equipment_no")),
        T.StructField("cargo", _pairs("package_type")),
        T.StructField("custom_dates", _pairs("name", "value")),
        T.StructField("status_updates", _pairs("status", "date")),
    ]
)

# Names under which the payload lists its custom dates.
CUSTOM_DATES = {
    "_crd_actual": "Cargo Ready Date Actual",
    "_crd_estimated": "Cargo Ready Date Estimated",
    "_goods_cleared_origin": "Goods Cleared at Origin Customs",
    "_goods_cleared_destination": "Goods Cleared at Destination Customs",
    "_pod_date": "POD Date",
    "_do_date": "D/O Date",
    "_do_exp": "D/O Expiry Date",
}

# Status texts that mark an actual departure or arrival.
DEPARTED = ("Actual Time of Departure", "Vessel departure")
ARRIVED = ("Actual Time of Arrival", "Vessel arrival")


def parse_payload(c: Column | str) -> Column:
    return F.from_json(col(c), PAYLOAD)


# The same, with the text of a payload that is no valid JSON of this form.
CHECKED = T.StructType([*PAYLOAD.fields, T.StructField("_damaged", T.StringType())])


def checked_payload(c: Column | str) -> Column:
    """Like `parse_payload`, with a field `_damaged` that is NULL for a sound text."""
    return F.from_json(col(c), CHECKED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_damaged"})


def payload_state(text: Column | str, parsed: Column | str) -> Column:
    """'absent' (no text), 'damaged' (no sound JSON), 'unnamed' (names no shipment) or 'named'."""
    parsed = col(parsed)
    return (
        F.when(F.trim(F.coalesce(col(text), F.lit(""))) == "", "absent")
        .when(parsed.isNull() | parsed["_damaged"].isNotNull(), "damaged")
        .when(parsed["serial_no"].isNull(), "unnamed")
        .otherwise("named")
    )


def repeated_names(pairs: Column | str, names: list[str]) -> Column:
    """How many entries of {name, value} lists repeat one of ``names``; only the first of each is read."""
    extra = F.lit(0)
    for name in names:
        extra = extra + F.greatest(named_count(pairs, name) - 1, F.lit(0))
    return F.coalesce(extra, F.lit(0))


def payload_or_plan(serial: Column | str, from_payload: Column | str, planned: Column | str) -> Column:
    """The payload's value once the payload names a shipment, the plan's before."""
    return F.when(col(serial).isNull(), col(planned)).otherwise(col(from_payload))


def named_value(pairs: Column | str, name: str) -> Column:
    """Value of the first {name, value} entry called ``name``; NULL if absent."""
    return F.get(F.filter(col(pairs), lambda p: p["name"] == name), F.lit(0))["value"]


def named_count(pairs: Column | str, name: str) -> Column:
    """How often ``name`` occurs: more than once means the source has duplicates."""
    return F.size(F.filter(col(pairs), lambda p: p["name"] == name))


def event_text(updates: Column | str, phrases: tuple[str, ...]) -> Column:
    """Smallest date text among status updates that contain one of the phrases."""
    wanted = "|".join(phrases)
    hits = F.filter(col(updates), lambda u: u["status"].rlike(f"(?is){wanted}"))
    return F.array_min(F.transform(hits, lambda u: u["date"]))


def event_date(updates: Column | str, phrases: tuple[str, ...]) -> Column:
    return safe_day(event_text(updates, phrases))


def listed(items: Column | str, field: str, sep: str) -> Column:
    """The field's values in array order, NULL when there is none."""
    values = F.filter(F.transform(col(items), lambda x: x[field]), lambda v: v.isNotNull())
    return F.when(F.size(values) > 0, F.array_join(values, sep))


def listed_distinct(items: Column | str, field: str, sep: str) -> Column:
    values = F.array_sort(F.array_distinct(F.filter(F.transform(col(items), lambda x: x[field]), lambda v: v.isNotNull())))
    return F.when(F.size(values) > 0, F.array_join(values, sep))


def equipment_items(c: Column | str) -> Column:
    return F.from_json(col(c), "array<string>")


def equipment_text(items: Column | str, keep_quotes: bool = True) -> Column:
    """'"2 x 20 ft a" + "1 x 40 ft b"', optionally without the quotes."""
    quote = F.lit('"')
    shown = F.array_join(F.transform(col(items), lambda i: F.concat(quote, i, quote)), ", ")
    for drop in ("[", "]"):
        shown = F.replace(shown, F.lit(drop), F.lit(""))
    shown = F.replace(shown, F.lit(", "), F.lit(" + "))
    return shown if keep_quotes else F.replace(shown, quote, F.lit(""))


def _boxes(items: Column, feet: int) -> Column:
    hits = F.filter(items, lambda i: i.like(f"% x {feet} ft%"))
    counts = F.transform(hits, lambda i: F.regexp_substr(i, F.lit("^[0-9]+")).try_cast("int"))
    return F.filter(counts, lambda n: n.isNotNull())


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda acc, n: acc + n)


def container_counts(items: Column | str) -> dict[str, Column]:
    """Containers by length from texts such as '2 x 40 ft high cube'.

    Single lengths are NULL when absent, the totals 0. A 40 ft box counts as
    two twenty-foot equivalents.
    """
    items = col(items)
    twenty, forty = _boxes(items, 20), _boxes(items, 40)
    has_array = items.isNotNull()
    sum20 = F.when(has_array, _total(twenty)).otherwise(0)
    sum40 = F.when(has_array, _total(forty)).otherwise(0)
    return {
        "_20_ft": F.when(F.size(twenty) > 0, _total(twenty)),
        "_40_ft": F.when(F.size(forty) > 0, _total(forty)),
        "_count_of_cont": sum20 + sum40,
        "_teus": sum20 + sum40 * 2,
    }


def payload_dates(p: str = "_p") -> dict[str, Column]:
    """Every date of a parsed payload column, typed, with the preferred groups."""
    raw = {
        "_arrival_date": f"{p}.arrival_date",
        "_departure_date": f"{p}.loading_date",
        "_del": f"{p}.delivery_date",
        "_pickup_date": f"{p}.pickup_date",
        "_pta": f"{p}.pta_date",
        "_ptd": f"{p}.ptd_date",
        "_eta_simple": f"{p}.eta_date",
        "_etd_simple": f"{p}.etd_date",
        "_eta_wakeo": f"{p}.eta_wakeo_date",
        "_etd_wakeo": f"{p}.etd_wakeo_date",
    }
    out = {name: safe_day(path) for name, path in raw.items()}
    out |= {name: safe_day(named_value(f"{p}.custom_dates", label)) for name, label in CUSTOM_DATES.items()}
    out["_departure_date_actual"] = event_date(f"{p}.status_updates", DEPARTED)
    out["_arrival_date_actual"] = event_date(f"{p}.status_updates", ARRIVED)
    return out


def with_payload_dates(df, p: str = "_p"):
    """Add raw dates first, then the groups built on them, so each is computed once."""
    df = df.withColumns(payload_dates(p))
    return df.withColumns(
        date_groups(
            "_pta", "_eta_simple", "_eta_wakeo", "_ptd", "_etd_simple", "_etd_wakeo", "_crd_actual", "_crd_estimated"
        )
    )
