"""Calendar expressions. Weeks start on Sunday and January 1 is always in week 1."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def moment(at: datetime) -> Column:
    """A date-time without zone, in whole seconds, whatever the zone of the session."""
    return F.lit(at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def date_key(d: Column) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def us_week(d: Column) -> Column:
    """Week of the year with Sunday as first day (not the ISO week)."""
    offset = F.dayofweek(F.trunc(d, "year")) - 1
    return (F.floor((F.dayofyear(d) - 1 + offset) / 7) + 1).cast("smallint")


def week_of_month(d: Column) -> Column:
    return (F.floor((F.dayofmonth(d) - 1) / 7) + 1).cast("smallint")


def fiscal_year(d: Column) -> Column:
    """The fiscal year starts in July and is named after the year it ends in."""
    return (F.year(d) + F.when(F.month(d) >= 7, 1).otherwise(0)).cast("smallint")


def fiscal_quarter(d: Column) -> Column:
    return (F.floor(F.pmod(F.month(d) - 7, F.lit(12)) / 3) + 1).cast("smallint")


def semester(d: Column) -> Column:
    return F.when(F.month(d) <= 6, 1).otherwise(2).cast("smallint")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end.cast("date"), start.cast("date"))


def seconds_between(start: Column, end: Column) -> Column:
    """Count of second boundaries crossed."""
    return F.timestamp_diff("SECOND", F.date_trunc("second", start), F.date_trunc("second", end))


def days_before(moment: Column, days: int) -> Column:
    return moment - F.make_dt_interval(days=F.lit(days))
