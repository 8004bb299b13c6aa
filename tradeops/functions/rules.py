"""Business rules as Column expressions: lead times, scores, states and lights.

Columns keep the names the reports publish, so a rule reads the staged columns
of the frame it is applied to. Rules keep SQL's three-valued logic: a NULL date
means "has not happened", and no rule fills it in.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dates import days_between, plus_days
from .text import choose, col, lacks, surely_matches

# ---------------------------------------------------------------- lead times

# Internal buffers in days added to a committed lead time.
COMMITTED_BUFFERS = (7, 3, 5)
# Lead-time overrun in days -> health label, checked in order.
HEALTH_BANDS = ((15, "Healthy"), (30, "Minor"), (45, "Moderate"), (60, "Major"))
HEALTH_WORST = "Severe"

LEAD_STEPS = (
    "_days_order_placement_lt",
    "_days_supplier_production_lt",
    "_days_custom_clearance_lt",
    "_days_iss_cont_booking_lt",
)


def order_placement_days(requested: Column | str, approved: Column | str) -> Column:
    return days_between(approved, requested)


def lead_times(df: DataFrame) -> DataFrame:
    """Day counts of each stage. A stage without its dates counts 0, except
    transit and end-to-end, which stay NULL; booking is NULL when the departure
    is known but the cargo-ready date is not."""
    delivered, ready = F.col("_del").isNotNull(), F.col("_crd").isNotNull()
    approved = F.col("_po_app_date").isNotNull()
    return df.withColumns(
        {
            "_days_order_placement_lt": F.coalesce(order_placement_days("_pr_appr_date", "_po_app_date"), F.lit(0)),
            "_days_supplier_production_lt": F.when(
                delivered & ready & approved, days_between("_crd", "_po_app_date")
            ).otherwise(0),
            "_days_custom_clearance_lt": F.coalesce(days_between("_del", "_full_eta"), F.lit(0)),
            "_days_iss_cont_booking_lt": F.when(
                F.col("_full_etd").isNotNull(), days_between("_full_etd", "_crd")
            ).otherwise(0),
            "_days_transit_lt": days_between("_full_eta", "_full_etd"),
            "_e2e_total_lt": days_between("_del", "_pr_appr_date"),
        }
    )


def delay_metrics(df: DataFrame) -> DataFrame:
    """Slips against plan and gaps between consecutive milestones, in days."""
    delivered = F.col("_del").isNotNull()
    return df.withColumns(
        {
            "_days_delayed_eta": F.when(delivered, days_between("_eta_wakeo", "_eta_simple")),
            "_days_delayed_etd": F.when(delivered, days_between("_etd_wakeo", "_etd_simple")),
            "_etd_2_eta": days_between("_revised_eta", "_revised_etd"),
            "_eta_2_del": days_between("_del", "_revised_eta"),
            "_nbd_2_del": days_between("_po_need_by_date", "_del"),
            "_rdd_eta": F.when(delivered, days_between("_full_eta", "_po_need_by_date")),
            "_crd_2_etd": days_between(F.coalesce(F.col("_revised_etd"), F.col("_full_etd")), "_crd"),
            "_po_2_crd": days_between("_crd", "_po_creation_date"),
        }
    )


def need_by_metrics(df: DataFrame, eta: str, only_if: str) -> DataFrame:
    """Need-by date against readiness and arrival.

    Quirk kept: the first rule leaves out title-case states, the second
    compares with upper-case ones and therefore never leaves any out.
    """
    idle = F.col("_status").isin("Cancelled", "Pending", "Not due")
    never = F.col("_status").isin("CANCELLED", "PENDING", "NOT DUE")
    return df.withColumns(
        {
            "_nbd_2_crd": F.when(idle, None).otherwise(days_between("_crd", "_po_need_by_date")),
            "_nbd_2_eta": F.when(never, None).when(
                F.col(only_if).isNotNull(), days_between(eta, "_po_need_by_date")
            ),
        }
    )


def actual_lead(cap: int = 500) -> Column:
    """Sum of the four stages, 0 if the total with transit is beyond ``cap``.

    An unknown transit makes that test unknown, so the plain sum is kept.
    """
    stages = reduce(add, [F.col(c) for c in LEAD_STEPS])
    return F.when(stages + F.col("_days_transit_lt") > cap, 0).otherwise(stages)


def committed_lead(
    supplier: Column | str,
    country: Column | str,
    void: Column,
    null_policy: str = "propagate",
    buffers: tuple[int, ...] = COMMITTED_BUFFERS,
) -> Column:
    """Promised lead time; 0 where ``void`` holds.

    ``null_policy``: 'propagate' gives NULL when a master lead time is missing,
    'zero' counts it as 0.
    """
    known = [col(supplier), col(country)]
    if null_policy == "zero":
        known = [F.coalesce(c, F.lit(0)) for c in known]
    return F.when(void, 0).otherwise(known[0] + known[1] + sum(buffers))


def health_check(
    needs: list[str],
    overrun: Column | str,
    bands: tuple[tuple[int, str], ...] = HEALTH_BANDS,
    worst: str = HEALTH_WORST,
) -> Column:
    """Label for days over the committed lead time; NULL if anything is missing."""
    overrun = col(overrun)
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in needs], overrun.isNull())
    rules = [(missing, F.lit(None).cast("string"))] + [(overrun <= top, F.lit(label)) for top, label in bands]
    return choose(rules, F.lit(worst))


# -------------------------------------------------------------- performance


def safe_divisor(c: Column | str) -> Column:
    return F.coalesce(F.nullif(col(c), F.lit(0)), F.lit(1))


def ratio(numerator: Column | str, divisor: Column | str, whole: bool) -> Column:
    """Quotient; ``whole`` truncates toward zero as integer division does."""
    num, div = col(numerator).cast("double"), col(divisor).cast("double")
    if not whole:
        return num / div
    quotient = num / div
    return F.when(quotient < 0, F.ceil(quotient)).otherwise(F.floor(quotient)).cast("double")


def score(days: Column | str, target: Column | int, whole: bool = False) -> Column:
    """1 within target, else one minus days over target; NULL if unknown."""
    days = col(days)
    target = F.lit(target) if isinstance(target, int) else target
    late = 1 - F.abs(ratio(days, safe_divisor(target), whole))
    return F.when(days <= target, F.lit(1.0)).when(days > target, late)


def placement_score(requested: Column | str, approved: Column | str, whole: bool, target: int = 5) -> Column:
    return F.coalesce(score(days_between(approved, requested), target, whole), F.lit(0.0))


def perf_scores(df: DataFrame, whole: bool, inverted_total: bool) -> DataFrame:
    """The remaining five ratios.

    ``whole`` uses integer division for the total, transit and customs ratios.
    ``inverted_total`` takes the end-to-end deviation from one; without it the
    raw deviation is published.
    """
    booking = days_between("_full_etd", "_crd")
    production = days_between("_crd", "_po_app_date")
    transit = days_between("_full_eta", "_full_etd")
    customs = days_between("_del", "_full_eta")
    committed = F.col("_days_total_comm_perf")
    deviation = F.abs(ratio(F.col("_e2e_total_lt") - committed, safe_divisor(committed), whole))
    total = 1 - deviation if inverted_total else deviation
    booked = F.col("_full_etd").isNotNull() & (F.col("_days_iss_cont_booking_lt") > 0)
    routed = reduce(
        lambda a, b: a & b, [F.col(c).isNotNull() for c in ("_del", "_full_eta", "_full_etd", "_origin_country")]
    )
    return df.withColumns(
        {
            "_e2e_total_lead_time_perf": F.when(F.col("_e2e_total_lt") > 0, total).otherwise(0.0),
            "_iss_cont_booking_perf": F.when(booked, score(booking, 7)).otherwise(0.0),
            "_supplier_committed_prod_rdy_perf": F.when(production.isNull(), 0.0).otherwise(
                score(production, F.col("_supplier_lead_time"))
            ),
            "_iss_transit_lead_time_perf": F.when(
                routed, F.coalesce(score(transit, F.col("_country_lead_time"), whole), F.lit(0.0))
            ).otherwise(0.0),
            "_iss_custom_clear_perf": F.when(customs.isNull(), 0.0).otherwise(score(customs, 3, whole)),
        }
    )


# The first score below one names the reason, in this order.
REASONS = (
    ("_ontime_order_placement_perf", "PR to PO delay"),
    ("_supplier_committed_prod_rdy_perf", "Product Readiness Delay"),
    ("_iss_cont_booking_perf", "Booking delay"),
    ("_iss_transit_lead_time_perf", "Trans Shipment delay"),
    ("_iss_custom_clear_perf", "Custom Clearance Delay"),
)


def reason_code(health: Column | str = "_health_check", order: tuple[tuple[str, str], ...] = REASONS) -> Column:
    unwell = col(health) != "Healthy"
    return F.when(unwell, choose([(F.col(c) < 1, F.lit(label)) for c, label in order]))


# -------------------------------------------------------------------- states


def shipment_status(as_of: Column, order_key: Column | str = "_fo_id") -> Column:
    """Where a shipment stands on ``as_of``; the order of the rules matters."""
    serial, eta, etd, delivered = (
        F.col("_shipment_serial_iss_job"),
        F.col("_full_eta"),
        F.col("_full_etd"),
        F.col("_del"),
    )
    named = serial.isNotNull()
    blank = F.coalesce(serial == "", F.lit(True))
    landed = (eta <= as_of) & (etd <= as_of)
    rules = [
        (etd.isNull(), "Pending"),
        (named & landed & (delivered <= as_of), "Delivered"),
        (named & surely_matches("_ship_focus_status", "cancel"), "Cancelled"),
        ((named | F.col("_response_shipment_id").isNotNull()) & (eta > as_of) & (etd <= as_of), "In transit"),
        (blank & (col(order_key).isNotNull() | (etd > as_of)), "Ongoing"),
        (~blank & lacks("_ship_focus_status", "cancel") & F.col("_departure_date_actual").isNull(), "Ongoing"),
        (named & landed & (delivered.isNull() | (delivered > as_of)), "Arrived"),
    ]
    return choose([(cond, F.lit(label)) for cond, label in rules])


def open_line_status(status: Column | str, need_by: Column | str, as_of: Column, horizon: int = 90) -> Column:
    """State of an order line that still has quantity to ship."""
    cancelled = F.upper(col(status)) == "CANCELLED"
    need_by, edge = col(need_by).cast("date"), plus_days(as_of, horizon)
    return choose(
        [
            (cancelled, F.lit("Cancelled")),
            (~cancelled & (need_by > edge), F.lit("Not Due")),
            (~cancelled & (need_by > as_of), F.lit("Pending")),
            (~cancelled & (need_by <= as_of), F.lit("Due")),
        ]
    )


def line_type(status: Column | str) -> Column:
    return choose(
        [
            (surely_matches(status, "cancel"), F.lit("Cancelled")),
            (surely_matches(status, "close"), F.lit("Closed")),
            (surely_matches(status, "comple"), F.lit("Completed")),
        ],
        F.lit("Pending"),
    )


def sla_breach(actual: Column | str, target: Column | str) -> Column:
    """An unknown duration or target is not a breach."""
    return F.when(col(actual) > col(target), F.lit("Breached SLA")).otherwise(F.lit("Within SLA"))


def activity_bucket(logins: Column | str) -> Column:
    """0, 1, or 2 for two and more."""
    return F.least(F.coalesce(col(logins), F.lit(0)), F.lit(2)).cast("int")


def present(c: Column | str, yes: str, no: str) -> Column:
    return F.when(col(c).isNull(), F.lit(no)).otherwise(F.lit(yes))


def doc_flag(shipment: Column | str, documents: Column | str) -> Column:
    """Yes/No for a known shipment with/without the document, else NULL."""
    return F.when(col(shipment).isNotNull(), present(documents, "Yes", "No"))


# ------------------------------------------------------------- traffic lights

STAGES = (
    "_01_po_aknowledgment_expt",
    "_02_po_pickup_departure_expt",
    "_03_po_transit_expt",
    "_04_po_custom_clear_expt",
    "_05_po_delivery_expt",
)
# Day limits of the lights.
LIGHT_LIMITS = {"pickup": (5, 7), "transit": 10, "customs": (5, 7), "delivery": 3}


def current_delivery(latest_eta: Column | str, as_of: Column, buffer_days: int = 3) -> Column:
    """Expected delivery of a unit: tomorrow if overdue and not delivered."""
    due = plus_days(latest_eta, buffer_days)
    return F.when((due <= as_of) & F.col("_del").isNull(), plus_days(as_of, 1)).otherwise(due)


def stage_lights(as_of: Column, limits: dict = LIGHT_LIMITS) -> dict[str, Column]:
    """One light per stage: dark green done, green on time, yellow and red late."""
    dark, green, yellow, red = (F.lit(c) for c in ("dark green", "green", "yellow", "red"))
    departed = F.coalesce(F.col("_departure_date_actual"), F.col("_departure_date"))
    arrived = F.coalesce(F.col("_arrival_date_actual"), F.col("_arrival_date"))
    etd = F.coalesce(F.col("_etd_wakeo"), F.col("_ptd"), F.col("_etd"))
    planned_eta = F.coalesce(F.col("_pta"), F.col("_eta"))
    live_eta, delivered, cleared = F.col("_eta_wakeo"), F.col("_del"), F.col("_goods_cleared_destination")
    ready, need_by, due = F.col("_crd"), F.col("_po_need_by_date"), F.col("_current_edd_fo")

    soon, late = limits["pickup"]
    pickup = [
        (departed <= as_of, dark),
        (etd <= plus_days(ready, soon), green),
        (etd <= plus_days(ready, late), yellow),
        (etd > plus_days(ready, late), red),
    ]

    sailing = (departed <= as_of) & F.col("_eta").isNotNull()
    slip = days_between(live_eta, planned_eta)
    transit = [
        (arrived <= as_of, dark),
        (sailing & ((planned_eta >= live_eta) | live_eta.isNull()), green),
        (sailing & (slip > limits["transit"]), red),
        (sailing & (slip > 0), yellow),
    ]

    soon, late = limits["customs"]
    held = (
        (arrived <= as_of)
        & (cleared.isNull() | (cleared > as_of))
        & (delivered.isNull() | (delivered > as_of))
    )
    customs = [
        ((cleared <= as_of) | (delivered <= as_of), dark),
        (held & (as_of <= plus_days(arrived, soon)), green),
        (held & (as_of > plus_days(arrived, late)), red),
        (held & (as_of > plus_days(arrived, soon)), yellow),
    ]

    waiting = (delivered.isNull() | (delivered > as_of)) & F.coalesce(live_eta, F.col("_eta")).isNotNull()
    over = days_between(due, need_by)
    delivery = [
        (delivered <= as_of, dark),
        (waiting & (due <= need_by), green),
        (waiting & (over > limits["delivery"]), red),
        (waiting & (due > need_by) & over.between(0, limits["delivery"]), yellow),
    ]

    acknowledged = F.col("_etd").isNotNull() & F.col("_eta").isNotNull() & ready.isNotNull()
    lights = [F.when(acknowledged, dark).otherwise(green)] + [choose(r) for r in (pickup, transit, customs, delivery)]
    return dict(zip(STAGES, lights))


def final_delivery(line: Column | str, ordered: Column | str, shipped: Column | str, due: Column | str) -> Column:
    """Order-level delivery date on master lines that are fully shipped."""
    closed = col(line).isin("Pending", "Closed", "Completed")
    return F.when(closed & (col(ordered) == col(shipped)), col(due))


# ------------------------------------------------------------------- volumes

# Units of measure and the pieces one of them holds.
UNIT_PIECES = {"EACH": 1, "CASE OF 6": 6, "CASE OF 12": 12, "CASE OF 24": 24}
# The shipped quantity alone also knows this one.
SHIPPED_UNIT_PIECES = UNIT_PIECES | {"CASE OF 32": 32}


def unit_pieces(unit: Column | str, pieces: dict[str, int] = UNIT_PIECES) -> Column:
    return choose([(col(unit) == name, F.lit(n)) for name, n in pieces.items()], F.lit(0))


def pieces_of(quantity: Column | str, unit: Column | str, pieces: dict[str, int] = UNIT_PIECES) -> Column:
    """Quantity in pieces; 0 for an unknown unit even if the quantity is NULL."""
    known = col(unit).isin(*pieces)
    return F.when(known, col(quantity) * unit_pieces(unit, pieces)).otherwise(0)


# Volume measures in order of preference, with unit and label.
VOLUME_MEASURES = (
    ("chargeable_weight_air", "KG", "Ch.Weight (Air)"),
    ("chargeable_weight_ltl", "LTL", "Ch.Weight (LTL)"),
    ("trucks_ftl", "FTL", "Trucks (FTL)"),
    ("teu_fcl", "TEU", "TEU"),
    ("cbm_lcl", "CBM", "CBM (LCL)"),
    ("cbm_projects", "CBM", "CBM (Projects)"),
)


def volume_waterfall(measures: tuple[tuple[str, str, str], ...] = VOLUME_MEASURES) -> dict[str, Column]:
    """Value, unit and label of the first measure that is present."""
    present_ = [(F.col(c).isNotNull(), F.col(c), F.lit(unit), F.lit(label)) for c, unit, label in measures]
    return {
        "_analytical_volume": choose([(cond, value) for cond, value, _, _ in present_], F.lit(0)),
        "_analytical_units": choose([(cond, unit) for cond, _, unit, _ in present_], F.lit("NA")),
        "_analytical_volume_type": choose([(cond, label) for cond, _, _, label in present_], F.lit("NA")),
    }
