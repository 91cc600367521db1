"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def week_start(day) -> Column:
    """The Monday of the week, as a date."""
    return F.trunc(day, "week")


def within_days(stamp: Column, as_of: Column, days: int) -> Column:
    """Not older than ``days`` days before ``as_of``."""
    return stamp >= as_of - F.make_dt_interval(F.lit(days))


def iso_date(day) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def iso_timestamp(stamp) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")
