"""Every arm of the business rules, NULL arms included."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradeops.functions import rules
from tradeops.functions.dates import Age, as_of_date, month_label, whole_months
from tradeops.functions.payload import container_counts, equipment_items, equipment_text, event_text, named_value, parse_payload
from tradeops.functions.text import captured, joined, lacks, late_trim_key, name_key, part, surrogate_key
from tradeops.operators.orders import light_mask, rolled_light

D = dt.date(2024, 5, 10)


def day(n):
    return None if n is None else D + dt.timedelta(days=n)


def one(spark, columns, **values):
    """Evaluate column expressions over a single row given as name='type:value'."""
    base = spark.range(1).select(*[F.lit(v).cast(t).alias(n) for n, (t, v) in values.items()])
    return base.select(*[c.alias(n) for n, c in columns.items()]).first()


STATUS = ["_shipment_serial_iss_job", "_response_shipment_id", "_ship_focus_status", "_fo_id"]
DATES = ["_full_eta", "_full_etd", "_del", "_departure_date_actual"]


@pytest.mark.parametrize(
    "want,serial,other,focus,order,eta,etd,done,departed",
    [
        ("Pending", "S", None, None, "f", 1, None, None, None),
        ("Delivered", "S", None, "cancelled", "f", -2, -9, 0, None),
        ("Cancelled", "S", None, "ops_CANCELled", "f", 4, -1, None, None),
        ("In transit", None, "7", None, None, 4, 0, None, None),
        ("Ongoing", None, None, None, "f", -1, -2, None, None),
        ("Ongoing", "", None, None, None, None, 3, None, None),
        ("Ongoing", "S", None, None, "f", 4, 3, None, None),
        ("Arrived", "S", None, "open", "f", -1, -2, None, -2),
        ("Arrived", "S", None, "open", "f", -1, -2, 5, -2),
        (None, None, None, None, None, None, -3, None, None),
        (None, "S", None, "open", "f", None, -3, None, -3),
    ],
)
def test_shipment_status(spark, want, serial, other, focus, order, eta, etd, done, departed):
    values = dict(zip(STATUS, [("string", v) for v in (serial, other, focus, order)]))
    values |= dict(zip(DATES, [("date", day(n)) for n in (eta, etd, done, departed)]))
    assert one(spark, {"s": rules.shipment_status(as_of_date(D))}, **values).s == want


@pytest.mark.parametrize(
    "over,want", [(15, "Healthy"), (16, "Minor"), (31, "Moderate"), (46, "Major"), (60, "Major"), (61, "Severe"), (-900, "Healthy"), (None, None)]
)
def test_health_bands(spark, over, want):
    got = one(spark, {"h": rules.health_check(["x"], "over")}, over=("int", over), x=("int", 1))
    assert got.h == want
    assert one(spark, {"h": rules.health_check(["x"], "over")}, over=("int", over), x=("int", None)).h is None


def test_actual_lead_ignores_unknown_transit(spark):
    steps = {c: ("int", 200) for c in rules.LEAD_STEPS}
    lead = {"a": rules.actual_lead()}
    assert one(spark, lead, **steps, _days_transit_lt=("int", 5)).a == 0
    assert one(spark, lead, **steps, _days_transit_lt=("int", None)).a == 800


def test_committed_lead_null_policies(spark):
    args = {"s": ("int", 4), "c": ("int", None)}
    got = one(spark, {
        "p": rules.committed_lead("s", "c", F.lit(False)), "z": rules.committed_lead("s", "c", F.lit(False), "zero"),
        "v": rules.committed_lead("s", "c", F.lit(True)),
    }, **args)
    assert (got.p, got.z, got.v) == (None, 19, 0)


@pytest.mark.parametrize("days,whole,want", [(5, False, 1.0), (7, False, -0.4), (7, True, 0.0), (-3, True, 1.0), (None, False, None)])
def test_score(spark, days, whole, want):
    got = one(spark, {"s": rules.score("d", 5, whole)}, d=("int", days)).s
    assert got == (None if want is None else pytest.approx(want))


def test_reason_takes_first_low_score(spark):
    scores = {c: ("double", 1.0) for c, _ in rules.REASONS} | {"_iss_cont_booking_perf": ("double", 0.5), "_iss_custom_clear_perf": ("double", 0.0)}
    assert one(spark, {"r": rules.reason_code()}, **scores, _health_check=("string", "Minor")).r == "Booking delay"
    assert one(spark, {"r": rules.reason_code()}, **scores, _health_check=("string", "Healthy")).r is None
    assert one(spark, {"r": rules.reason_code()}, **scores, _health_check=("string", None)).r is None


LIGHT_DATES = [
    "_etd", "_eta", "_crd", "_departure_date", "_departure_date_actual", "_etd_wakeo", "_ptd", "_pta", "_eta_wakeo", "_arrival_date",
    "_arrival_date_actual", "_goods_cleared_destination", "_del", "_current_edd_fo", "_po_need_by_date",
]


@pytest.mark.parametrize(
    "stage,want,dates",
    [
        (0, "dark green", {"_etd": 1, "_eta": 2, "_crd": 0}),
        (0, "green", {"_etd": 1, "_eta": 2}),
        (1, "dark green", {"_departure_date": 0}),
        (1, "green", {"_crd": 0, "_etd": 5}),
        (1, "yellow", {"_crd": 0, "_etd": 5, "_ptd": 6}),
        (1, "red", {"_crd": 0, "_etd_wakeo": 8, "_etd": 1}),
        (1, None, {"_etd": 8}),
        (2, "dark green", {"_arrival_date": -1}),
        (2, "green", {"_departure_date": -5, "_eta": 3}),
        (2, "green", {"_departure_date": -5, "_eta": 3, "_pta": 4, "_eta_wakeo": 4}),
        (2, "yellow", {"_departure_date": -5, "_eta": 3, "_eta_wakeo": 13}),
        (2, "red", {"_departure_date": -5, "_eta": 3, "_eta_wakeo": 14}),
        (2, None, {"_departure_date": 5, "_eta": 3}),
        (3, "dark green", {"_goods_cleared_destination": 0}),
        (3, "dark green", {"_del": -1}),
        (3, "green", {"_arrival_date": -5}),
        (3, "yellow", {"_arrival_date": -6}),
        (3, "yellow", {"_arrival_date_actual": -7, "_arrival_date": -1, "_del": 2}),
        (3, "red", {"_arrival_date": -8}),
        (3, None, {"_arrival_date": 1}),
        (4, "dark green", {"_del": 0}),
        (4, "green", {"_eta": 1, "_current_edd_fo": 2, "_po_need_by_date": 2}),
        (4, "yellow", {"_eta": 1, "_current_edd_fo": 5, "_po_need_by_date": 2}),
        (4, "red", {"_eta": 1, "_current_edd_fo": 6, "_po_need_by_date": 2}),
        (4, None, {"_current_edd_fo": 6, "_po_need_by_date": 2}),
    ],
)
def test_stage_lights(spark, stage, want, dates):
    values = {c: ("date", day(dates.get(c))) for c in LIGHT_DATES}
    name = rules.STAGES[stage]
    assert one(spark, {"light": rules.stage_lights(as_of_date(D))[name]}, **values).light == want


@pytest.mark.parametrize(
    "want,lines,red,yellow,other,green,dark,balance",
    [
        ("red", None, None, None, None, None, None, 5), ("red", 2, True, True, True, True, True, 0),
        ("yellow", 2, False, True, False, False, False, 1), ("yellow", 2, False, False, True, True, False, 1),
        ("green", 2, False, True, True, True, True, 0), ("dark green", 2, False, False, True, False, True, 0),
        (None, 2, False, False, True, False, False, 0), (None, 2, False, True, True, True, True, -1),
        (None, 2, False, True, True, True, True, None),
    ],
)
def test_rolled_light(spark, want, lines, red, yellow, other, green, dark, balance):
    bits = {1: red, 2: yellow, 4: green, 8: other, 0b11111 << 4: dark}
    mask = None if lines is None else sum(bit for bit, seen in bits.items() if seen)
    assert one(spark, {"light": rolled_light("m", "b")}, m=("int", mask), b=("double", balance)).light == want


def test_light_mask(spark):
    colours = ["red", "yellow", "green", "dark green", None]
    values = {name: ("string", c) for name, c in zip(rules.STAGES, colours)}
    assert one(spark, {"m": light_mask()}, **values).m == 1 | 2 | 4 | 8 | 16 << 3
    assert one(spark, {"m": light_mask()}, **{name: ("string", "dark green") for name in rules.STAGES}).m == 8 | 0b11111 << 4
    assert one(spark, {"m": light_mask()}, **{name: ("string", None) for name in rules.STAGES}).m == 0


@pytest.mark.parametrize(
    "status,need,want",
    [("cancelled", 1, "Cancelled"), ("open", 90, "Pending"), ("open", 91, "Not Due"), ("open", 0, "Due"), ("open", None, None), (None, 1, None)],
)
def test_open_line_status(spark, status, need, want):
    got = one(spark, {"s": rules.open_line_status("st", "nd", as_of_date(D))}, st=("string", status), nd=("date", day(need)))
    assert got.s == want


def test_need_by_rules_differ_in_case(spark):
    base = {"_status": ("string", "Cancelled"), "_crd": ("date", D), "_po_need_by_date": ("date", D), "eta": ("date", day(4))}
    df = spark.range(1).select(*[F.lit(v).cast(t).alias(n) for n, (t, v) in base.items()])
    got = rules.need_by_metrics(df, "eta", "eta").first()
    assert (got["_nbd_2_crd"], got["_nbd_2_eta"]) == (None, 4)


def test_units_know_case_of_32_only_when_shipped(spark):
    got = one(spark, {
        "ordered": rules.pieces_of("q", "u"), "shipped": rules.pieces_of("q", "u", rules.SHIPPED_UNIT_PIECES), "unit": rules.unit_pieces("u"),
    }, q=("double", 2.0), u=("string", "CASE OF 32"))
    assert (got.ordered, got.shipped, got.unit) == (0, 64, 0)


def test_expected_delivery_of_overdue_unit(spark):
    due = {"e": rules.current_delivery("latest", as_of_date(D))}
    assert one(spark, due, latest=("date", day(-9)), _del=("date", None)).e == day(1)
    assert one(spark, due, latest=("date", day(-9)), _del=("date", D)).e == day(-6)


def test_volume_waterfall_defaults(spark):
    values = {c: ("double", None) for c, _, _ in rules.VOLUME_MEASURES}
    got = one(spark, rules.volume_waterfall(), **values)
    assert tuple(got) == (0, "NA", "NA")
    assert tuple(one(spark, rules.volume_waterfall(), **values | {"cbm_projects": ("double", 7.0)})) == (7.0, "CBM", "CBM (Projects)")


@pytest.mark.parametrize(
    "later,earlier,months,days,hours",
    [
        ("2024-02-29 00:00:00", "2023-06-30 00:00:00", 7, 29, 0), ("2023-03-01 10:00:00", "2023-01-30 11:00:00", 1, 1, 23),
        ("2024-03-30 00:00:00", "2023-07-30 00:00:00", 8, 0, 0), ("2023-01-30 11:00:00", "2023-03-01 10:00:00", -1, -1, -23),
    ],
)
def test_age(spark, later, earlier, months, days, hours):
    age = Age("a", "b")
    got = one(spark, {"m": age.months(), "d": age.days(), "h": age.hours()}, a=("timestamp", later), b=("timestamp", earlier))
    assert (got.m, got.d, got.h) == (months, days, hours)


def test_whole_months_and_labels(spark):
    got = one(spark, {"m": whole_months("a", "b"), "l": month_label("a")}, a=("date", dt.date(2024, 2, 29)), b=("date", dt.date(2023, 6, 29)))
    assert (got.m, got.l) == (8, "FEB-2024")


def test_text_helpers(spark):
    got = one(spark, {
        "key": name_key("n"), "late": late_trim_key("n"), "out": part("n", "-", 9), "none": joined("n", "z"), "md5": surrogate_key("z"),
        "hit": captured("n", "b"), "no": lacks("z", "x"),
    }, n=("string", " a  b c "), z=("string", None))
    assert (got.key, got.late, got.out, got.none, got.md5, got.hit, got.no) == ("AB_C", "_AB_C_", "", None, None, "b", True)


PAYLOAD = """{"serial_no":"S1","n":1,"equipment":"[\\"2 x 20 ft dry, vented\\", \\"10 x 40 ft\\", \\"x 20 ft\\", \\"a x 20 ft\\"]",
 "custom_dates":[{"name":"POD Date","value":"2024-01-02"},{"name":"POD Date","value":"2024-09-09"}],
 "status_updates":[{"status":"VESSEL DEPARTURE x","date":"2024-02-03"},{"status":"the actual time of departure","date":"2024-02-01"},{"status":null,"date":"1990-01-01"}]}"""


def test_payload_functions(spark):
    row = spark.createDataFrame([(PAYLOAD,), (None,)], "p string").select(parse_payload("p").alias("_p"))
    row = row.withColumn("i", equipment_items("_p.equipment"))
    got = row.select(
        named_value("_p.custom_dates", "POD Date").alias("pod"), named_value("_p.custom_dates", "Nope").alias("nope"),
        event_text("_p.status_updates", rules_departed()).alias("left"), equipment_text("i", keep_quotes=False).alias("text"),
        *[c.alias(n) for n, c in container_counts("i").items()],
    ).collect()
    assert tuple(got[0]) == ("2024-01-02", None, "2024-02-01", "2 x 20 ft dry + vented + 10 x 40 ft + x 20 ft + a x 20 ft", 2, 10, 12, 22)
    assert tuple(got[1]) == (None, None, None, None, None, None, 0, 0)


def rules_departed():
    from tradeops.functions.payload import DEPARTED

    return DEPARTED
