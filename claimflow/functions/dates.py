"""Clock helpers. Every operator receives ``as_of``; nothing reads the wall clock.

``month_diff`` / ``year_diff`` count calendar boundaries crossed (the warehouse
``DATEDIFF(month|year, a, b)`` rule), unlike Spark's ``months_between``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value) -> Column:
    """Literal date column from ``date``/``datetime``/ISO string."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, _dt.datetime):
        value = value.date()
    return F.lit(str(value)).cast("date")


def as_ts(value) -> Column:
    """Literal TIMESTAMP_NTZ column (midnight for a plain date)."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return F.lit(f"{value} 00:00:00").cast("timestamp_ntz")


def month_diff(start: Column, end: Column) -> Column:
    """Calendar month boundaries between two dates: (y2-y1)*12 + (m2-m1)."""
    return ((F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))).cast("long")


def year_diff(start: Column, end: Column) -> Column:
    return (F.year(end) - F.year(start)).cast("long")


def day_diff(start: Column, end: Column) -> Column:
    """Day boundaries between two date/timestamp values (dates compared)."""
    return F.datediff(end.cast("date"), start.cast("date")).cast("long")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole-second boundaries (``DATEDIFF(second, ...)``) on wall-clock values;
    no session time zone is involved (NTZ arithmetic)."""
    s = F.date_trunc("second", start.cast("timestamp_ntz")).cast("timestamp_ntz")
    e = F.date_trunc("second", end.cast("timestamp_ntz")).cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", s, e).cast("long")


def minus_days(ts: Column, n: int) -> Column:
    return ts - F.expr(f"INTERVAL {int(n)} DAYS")


def minus_months(d: Column, n: int) -> Column:
    return F.add_months(d, -int(n))
