"""Ordered windows on day grain.

Where a window is ordered by a date, rows of one key and day are interchangeable
up to a tie-break. Reducing to one row per (key, day) with a partial aggregate
first bounds every window partition by the number of calendar days, whatever
share of the rows a key holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .grouping import join_groups


def previous_day(df: DataFrame, keys: list[str], day: str, tie: str, name: str) -> DataFrame:
    """`lag(day) OVER (PARTITION BY keys ORDER BY day, tie)`, NULL days last.

    ``tie`` must be unique within a key and day. The first row of a day sees
    the preceding day of the key, the others see their own day.
    """
    per_day = df.groupBy(*keys, day).agg(F.min(tie).alias("__first"))
    w = Window.partitionBy(*keys).orderBy(F.col(day).asc_nulls_last())
    per_day = per_day.withColumn("__before", F.lag(day).over(w))
    out = join_groups(df, per_day, [*keys, day])
    first = F.col(tie) == F.col("__first")
    return out.withColumn(name, F.when(first, F.col("__before")).otherwise(F.col(day))).drop("__first", "__before")


def trailing_max(df: DataFrame, keys: list[str], day: str, value: str, months: int, name: str) -> DataFrame:
    """Largest value of the key in the ``months`` up to and including each day."""
    per_day = df.groupBy(*keys, day).agg(F.max(value).alias("__v"))
    spec = ", ".join(f"`{k}`" for k in keys)
    frame = f"range between interval {months} months preceding and current row"
    rolled = per_day.withColumn(name, F.expr(f"max(__v) over (partition by {spec} order by `{day}` {frame})"))
    return join_groups(df, rolled.drop("__v"), [*keys, day])


def validity(changes: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Change log -> (key, value, start, end): what held from start until end.

    Only the last change that takes effect by a given midnight can be seen by a
    lookup on whole days, so changes are reduced to one per key and effective
    day; ``end`` is the first change after it, NULL while it still holds.
    """
    at_ts = F.col(at).cast("timestamp")
    midnight = F.date_trunc("day", at_ts).cast("date")
    effective = F.when(at_ts == midnight.cast("timestamp"), midnight).otherwise(F.date_add(midnight, 1))
    per_day = (
        changes.where(F.col(key).isNotNull() & F.col(at).isNotNull())
        .groupBy(F.col(key).alias("__key"), effective.alias("__day"))
        .agg(
            F.max_by(F.col(value), F.struct(at_ts, F.col(value))).alias(value),
            F.max(at_ts).alias("__start"),
            F.min(at_ts).alias("__first"),
        )
    )
    w = Window.partitionBy("__key").orderBy("__day")
    return per_day.select(
        F.col("__key"), F.col(value), F.col("__start"), F.lead("__first").over(w).alias("__end")
    )


def as_of_join(df: DataFrame, changes: DataFrame, key: str, at: str, log_key: str, log_at: str, value: str) -> DataFrame:
    """Add the value valid at each row's time, NULL before the first change.

    A value counts from the first midnight at or after its change until the
    exact moment of the next one. At most one interval matches a row, and a key
    has at most one interval per calendar day.
    """
    spans = validity(changes, log_key, log_at, value)
    moment = F.col(at).cast("timestamp")
    cond = (
        (F.col(key) == F.col("__key"))
        & (F.date_trunc("day", moment) >= F.col("__start"))
        & (F.col("__end").isNull() | (moment < F.col("__end")))
    )
    return df.join(spans, cond, "left").drop("__key", "__start", "__end")


def dormancy(df: DataFrame, previous: str, day: str, gap_months: int = 8) -> dict[str, Column]:
    """Gap to the previous shipment in days and months, and whether it breaks a dormancy."""
    from ..functions.dates import days_between, whole_months

    months = whole_months(day, previous)
    return {
        "_prev_ship_diff_days": days_between(day, previous),
        "_prev_ship_diff_mon": months,
        "_dormacy_break_trigger": F.when(months >= gap_months, 1).otherwise(0),
    }
