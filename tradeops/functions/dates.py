"""Day counts, symbolic ages and shipment date groups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

AsOf = dt.date | str | None


def as_of_date(as_of: AsOf) -> Column:
    """The report's reference day; today only if the caller gives none."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def day(c: Column | str) -> Column:
    return col(c).cast("date")


def safe_day(c: Column | str) -> Column:
    """Text to date; unparsable text gives NULL."""
    return col(c).try_cast("date")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(col(later), col(earlier))


def plus_days(c: Column | str, n: int) -> Column:
    return F.date_add(col(c), n)


def elapsed_hours(later: Column | str, earlier: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", col(earlier), col(later)) / F.lit(3.6e9)


def month_label(c: Column | str) -> Column:
    """e.g. MAR-2024"""
    return F.upper(F.date_format(col(c), "MMM-yyyy"))


def minute_label(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd HH:mm")


def clock_label(c: Column | str) -> Column:
    """Time of day as text: Spark has no enabled time-of-day type."""
    return F.date_format(col(c), "HH:mm:ss")


class Age:
    """Calendar age between two timestamps, field by field.

    Months first, then days, then time of day, each borrowing from the next
    larger field; a borrowed month has the length of the earlier date's month.
    All fields carry the sign of the difference.
    """

    DAY_US = 86_400_000_000

    def __init__(self, later: Column | str, earlier: Column | str):
        a, b = col(later).cast("timestamp"), col(earlier).cast("timestamp")
        known = a.isNotNull() & b.isNotNull()
        low, high = F.when(known, F.least(a, b)), F.when(known, F.greatest(a, b))
        clock = self._clock(high) - self._clock(low)
        short_day = (clock < 0).cast("int")
        days = F.dayofmonth(high) - F.dayofmonth(low) - short_day
        short_month = (days < 0).cast("int")
        self._sign = F.when(a < b, F.lit(-1)).otherwise(F.lit(1))
        self._months = (F.year(high) - F.year(low)) * 12 + F.month(high) - F.month(low) - short_month
        self._days = days + short_month * F.dayofmonth(F.last_day(low))
        self._micros = clock + short_day * F.lit(self.DAY_US)

    @staticmethod
    def _clock(ts: Column) -> Column:
        return F.timestamp_diff("MICROSECOND", F.date_trunc("day", ts), ts)

    def months(self) -> Column:
        return self._sign * self._months

    def days(self) -> Column:
        return self._sign * self._days

    def hours(self) -> Column:
        return self._sign * F.floor(self._micros / F.lit(3_600_000_000)).cast("int")

    def label(self) -> Column:
        """Days and hours left over after whole months are dropped."""
        return F.concat(self.days().cast("string"), F.lit(" day "), self.hours().cast("string"), F.lit(" hour "))

    def nominal_hours(self) -> Column:
        """Hours with a year of 365.25 days and a left-over month of 30 days."""
        years = F.floor(self._months / 12)
        days = years * F.lit(365.25) + (self._months % 12) * 30 + self._days
        return self._sign * (days * 24 + self._micros / F.lit(3.6e9))


def whole_months(later: Column | str, earlier: Column | str) -> Column:
    """Completed calendar months between two dates."""
    return Age(later, earlier).months()


def date_groups(pta, eta, eta_live, ptd, etd, etd_live, ready_actual, ready_estimated) -> dict[str, Column]:
    """The preferred arrival, departure and cargo-ready dates.

    ``*_live`` is the tracking provider's estimate, ``pta``/``ptd`` the planned
    date, ``eta``/``etd`` the carrier's estimate.
    """
    pta, eta, eta_live = col(pta), col(eta), col(eta_live)
    ptd, etd, etd_live = col(ptd), col(etd), col(etd_live)
    return {
        "_eta": F.coalesce(pta, eta),
        "_revised_eta": F.coalesce(eta_live, eta),
        "_full_eta": F.coalesce(eta_live, pta, eta),
        "_etd": F.coalesce(ptd, etd),
        "_revised_etd": F.coalesce(etd_live, etd),
        "_full_etd": F.coalesce(etd_live, ptd, etd),
        "_crd": F.coalesce(col(ready_actual), col(ready_estimated)),
    }
