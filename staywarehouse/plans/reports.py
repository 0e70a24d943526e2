"""Analytical questions over the loaded warehouse.

Each report first shrinks the fact to one row per foreign key, with map-side combine, and
only then joins the dimension, so neither a hot key nor a large fact reaches the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.money import percent
from ..operators.lookup import lookup

_MONEY = "decimal(38,2)"


def daily_revenue(bookings: DataFrame, calendar: DataFrame,
                  reset: str | None = None) -> DataFrame:
    """Completed revenue per check-in day with its running total.

    The total runs over all days; ``reset='year'`` starts it anew every calendar year. The
    window holds at most one row per calendar day.
    """
    per_key = (bookings.where(F.col("booking_status") == "completed")
               .groupBy("checkin_date_sk").agg(F.sum("total_price").alias("daily_revenue")))
    days = calendar.select("date_sk", "full_date", "year_number")
    per_day = (per_key.join(days, per_key.checkin_date_sk == days.date_sk)
               .groupBy("full_date", "year_number")
               .agg(F.sum("daily_revenue").cast(_MONEY).alias("daily_revenue")))
    line = Window.partitionBy("year_number") if reset == "year" else Window.partitionBy()
    line = (line.orderBy("full_date")
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return (per_day.select("full_date", "daily_revenue",
                           F.sum("daily_revenue").over(line).cast(_MONEY).alias("revenue_ytd"))
            .orderBy("full_date"))


def _on_version(per_key: DataFrame, properties: DataFrame, columns: list[str],
                repoint: bool) -> DataFrame:
    """Join per-key figures with the current property versions.

    Figures of a superseded version drop out, or with ``repoint`` count for the current
    version of the same property.
    """
    current = properties.where("is_current")
    if not repoint:
        return lookup(per_key, current.select("property_sk", *columns), "property_sk", "inner")
    owner = properties.select("property_sk", "property_id")
    return lookup(lookup(per_key, owner, "property_sk", "inner"),
                  current.select("property_id", *columns), "property_id", "inner")


def revenue_by_place(bookings: DataFrame, properties: DataFrame, repoint: bool = False,
                     unique_bookings: bool = True) -> DataFrame:
    """Completed bookings and revenue per (title, city).

    ``booking_id`` is unique in the loaded fact and a booking has one property, so counting
    rows per property counts distinct bookings. Give ``unique_bookings=False`` for input
    without that guarantee.
    """
    done = bookings.where(F.col("booking_status") == "completed")
    if unique_bookings:
        figures = done.groupBy("property_sk").agg(F.count("booking_id").alias("_bookings"),
                                                  F.sum("total_price").alias("_revenue"))
        total = F.sum("_bookings")
    else:
        figures = done.groupBy("property_sk", "booking_id").agg(
            F.sum("total_price").alias("_revenue"))
        total = F.count_distinct("booking_id")
    joined = _on_version(figures, properties, ["title", "city"], repoint)
    return joined.groupBy("title", "city").agg(
        total.alias("total_bookings"), F.sum("_revenue").cast(_MONEY).alias("total_revenue"))


def top_properties(bookings: DataFrame, properties: DataFrame, n: int = 10,
                   **options: bool) -> DataFrame:
    """The ``n`` places with the highest revenue, ties in order of title and city."""
    ranked = revenue_by_place(bookings, properties, **options)
    return ranked.orderBy(F.col("total_revenue").desc(), "title", "city").limit(n)


def cancellation_rate(bookings: DataFrame, properties: DataFrame,
                      repoint: bool = False) -> DataFrame:
    """Bookings, cancellations and their percentage per property type."""
    cancelled = F.when(F.col("booking_status") == "cancelled", 1).otherwise(0)
    figures = bookings.groupBy("property_sk").agg(F.count("*").alias("_total"),
                                                  F.sum(cancelled).alias("_cancelled"))
    joined = _on_version(figures, properties, ["property_type"], repoint)
    per_type = joined.groupBy("property_type").agg(
        F.sum("_total").alias("total_bookings"),
        F.sum("_cancelled").alias("cancelled_bookings"))
    rate = percent(F.col("cancelled_bookings"), F.col("total_bookings"))
    return (per_type.withColumn("cancellation_rate", rate)
            .orderBy(F.col("cancellation_rate").desc(), "property_type"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, current rows only where a table has versions."""
    parts = []
    for name, df in tables.items():
        rows = df.where("is_current") if "is_current" in df.columns else df
        parts.append(rows.agg(F.count("*").alias("row_count"))
                     .select(F.lit(name).alias("table_name"), "row_count"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
