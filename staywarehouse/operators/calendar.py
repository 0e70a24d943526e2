"""The calendar dimension and lookups against it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import dates
from ..schemas import enforce

# First and last calendar day.
FIRST_DAY = "2020-01-01"
LAST_DAY = "2099-12-31"


def calendar(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    """One row per day with its 23 attributes."""
    day = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")))
    days = spark.range(1).select(day.alias("full_date"))
    return describe_days(days)


def describe_days(days: DataFrame) -> DataFrame:
    """Calendar attributes of every ``full_date`` in ``days``."""
    d = F.col("full_date")
    month, dom, dow = F.month(d), F.dayofmonth(d), F.dayofweek(d)
    ends_month = dom == F.dayofmonth(F.last_day(d))
    month_name, day_name = F.date_format(d, "MMMM"), F.date_format(d, "EEEE")
    return enforce(days, "dim_dates", {
        "date_sk": dates.date_key(d),
        "year_number": F.year(d),
        "quarter_number": F.quarter(d),
        "semester_number": dates.semester(d),
        "month_number": month,
        "month_name": month_name,
        "month_abbreviation": F.left(month_name, F.lit(3)),
        "week_number": dates.us_week(d),
        "week_of_month": dates.week_of_month(d),
        "day_of_month": dom,
        "day_of_week": dow,
        "day_name": day_name,
        "day_abbreviation": F.left(day_name, F.lit(3)),
        "is_weekend": dow.isin(1, 7),
        "is_month_start": dom == 1,
        "is_month_end": ends_month,
        "is_quarter_start": month.isin(1, 4, 7, 10) & (dom == 1),
        "is_quarter_end": month.isin(3, 6, 9, 12) & ends_month,
        "is_year_start": (month == 1) & (dom == 1),
        "is_year_end": (month == 12) & (dom == 31),
        "fiscal_year": dates.fiscal_year(d),
        "fiscal_quarter": dates.fiscal_quarter(d),
    })


def calendar_stats(calendar_df: DataFrame) -> DataFrame:
    return calendar_df.agg(F.count("*").alias("total_dates"),
                           F.min("full_date").alias("min_date"),
                           F.max("full_date").alias("max_date"))


def with_date_key(df: DataFrame, day: str, key: str, calendar_df: DataFrame) -> DataFrame:
    """Left lookup of the calendar key of column ``day`` into column ``key``.

    The broadcast side is two narrow columns with one row per calendar day, so its size is
    bounded by the calendar (29,220 rows by default) and does not grow with the facts.
    """
    side = calendar_df.select(F.col("full_date").alias(f"_{key}_day"),
                              F.col("date_sk").alias(key))
    found = df.join(F.broadcast(side), F.col(day).cast("date") == F.col(f"_{key}_day"), "left")
    return found.drop(f"_{key}_day")
