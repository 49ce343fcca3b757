"""Business-date context and date predicates (CMP-2, CMP-4, FN-6..FN-12, FLT-5/6/11/12/13).

The reference derives "today" and "yesterday" inside SQL from the server clock. Here the run
date is a parameter and every derived date is a Python value, so Catalyst sees literals: filters
fold to constants and reach the parquet scan as ``PushedFilters``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# "Never" stand-in used when two nullable status dates are compared (fixed value).
NEVER = dt.date(1900, 1, 1)


@dataclass(frozen=True)
class BusinessDate:
    """Dates derived from one run date (the day the job runs).

    ``as_of`` is the business date (yesterday), ``month_start`` the first day of its month and
    ``month_key`` its ``YYYY_MM`` snapshot key.
    """

    run_date: dt.date

    @classmethod
    def today(cls) -> "BusinessDate":
        return cls(dt.date.today())

    @classmethod
    def for_as_of(cls, as_of: dt.date) -> "BusinessDate":
        return cls(as_of + dt.timedelta(days=1))

    @property
    def as_of(self) -> dt.date:
        return self.run_date - dt.timedelta(days=1)

    @property
    def month_start(self) -> dt.date:
        return self.as_of.replace(day=1)

    @property
    def month_key(self) -> str:
        return self.as_of.strftime("%Y_%m")

    def stamp(self, grain: str = "day") -> str:
        """File-name stamp: ``%Y%m%d`` for daily reports, ``%Y%m`` for monthly ones.

        Monthly stamps use the business date's month, so a run on the 1st names the month it
        reports (the reference named it after the run month).
        """
        if grain == "day":
            return self.run_date.strftime("%Y%m%d")
        if grain == "month":
            return self.as_of.strftime("%Y%m")
        raise ValueError(f"unknown grain {grain!r}")


def day(c: Column | str) -> Column:
    """Day of a timestamp as a ``DateType`` value (``DATE_TRUNC('day', x)``)."""
    return F.to_date(c)


def month_start(c: Column | str) -> Column:
    """First day of the month as a date (``DATE_TRUNC('month', x)``)."""
    return F.trunc(F.col(c) if isinstance(c, str) else c, "month")


def month_key(c: Column | str) -> Column:
    """``YYYY_MM`` text key of a date or timestamp (``TO_CHAR(d, 'YYYY_MM')``)."""
    return F.date_format(c, "yyyy_MM")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_range(c: Column | str, lo: dt.date, hi: dt.date) -> Column:
    """Half-open range ``lo <= c < hi``; works for date and timestamp columns."""
    c = _col(c)
    return (c >= F.lit(lo)) & (c < F.lit(hi))


def between(c: Column | str, lo: dt.date, hi: dt.date) -> Column:
    """Both ends included. On a timestamp column ``hi`` means midnight of that day."""
    return _col(c).between(F.lit(lo), F.lit(hi))


def in_month(c: Column | str, bd: BusinessDate) -> Column:
    """Snapshot-key equality with the business date's month; prunes a ``YYYY_MM`` partition."""
    return _col(c) == F.lit(bd.month_key)


def before_day(c: Column | str, d: dt.date) -> Column:
    """``day(c) < d``, written as ``c < d`` so the comparison stays pushable to the scan.

    For a timestamp, ``to_date(c) < d`` holds exactly when ``c`` is before midnight of ``d``.
    """
    return _col(c) < F.lit(d)


def month_to_date(c: Column | str, bd: BusinessDate, closed: bool = False) -> Column:
    """Month-to-date predicate for the business date.

    ``closed=False``: ``month_start <= c < run_date`` (half-open, whole of yesterday).
    ``closed=True``: ``month_start <= c <= as_of 00:00`` (a time of day on ``as_of`` falls out).
    The two differ only when ``c`` carries a time of day.
    """
    if closed:
        return between(c, bd.month_start, bd.as_of)
    return in_range(c, bd.month_start, bd.run_date)


def on_or_after(c: Column | str, d: dt.date) -> Column:
    return _col(c) >= F.lit(d)


def before(c: Column | str, d: dt.date) -> Column:
    return _col(c) < F.lit(d)
