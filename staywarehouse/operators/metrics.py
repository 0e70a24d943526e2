"""Metrics of users and hosts.

Facts are aggregated per key first, with map-side combine, so a hot key costs one row per
task; the joins then see one row per key on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_SPENT = "decimal(18,2)"


def bookings_per(bookings: DataFrame, key: str) -> DataFrame:
    return bookings.groupBy(key).agg(F.count("*").cast("int").alias("total_bookings"))


def paid_per(payments: DataFrame, key: str) -> DataFrame:
    paid = payments.where(F.col("payment_status") == "paid")
    return paid.groupBy(key).agg(F.sum("amount").cast(_SPENT).alias("total_spent"))


def with_metrics(users: DataFrame, bookings: DataFrame, payments: DataFrame,
                 key: str = "user_id") -> DataFrame:
    """Users with their number of bookings and the sum of their paid payments, 0 if none."""
    rows = users.drop("total_bookings", "total_spent")
    rows = rows.join(bookings_per(bookings, key), key, "left")
    rows = rows.join(paid_per(payments, key), key, "left")
    return (rows.withColumn("total_bookings", F.coalesce("total_bookings", F.lit(0)))
            .withColumn("total_spent", F.coalesce("total_spent", F.lit(0)).cast(_SPENT)))


def user_metrics(versions: DataFrame, fact_bookings: DataFrame,
                 fact_payments: DataFrame) -> DataFrame:
    """Metrics per business key from loaded facts, whose keys may name any version."""
    owner = versions.select("user_sk", "user_id")
    booked = (bookings_per(fact_bookings, "user_sk").join(owner, "user_sk")
              .groupBy("user_id").agg(F.sum("total_bookings").cast("int")
                                      .alias("total_bookings")))
    paid = (paid_per(fact_payments, "user_sk").join(owner, "user_sk")
            .groupBy("user_id").agg(F.sum("total_spent").cast(_SPENT).alias("total_spent")))
    keys = versions.where("is_current").select("user_id")
    return (keys.join(booked, "user_id", "left").join(paid, "user_id", "left")
            .withColumn("total_bookings", F.coalesce("total_bookings", F.lit(0)))
            .withColumn("total_spent", F.coalesce("total_spent", F.lit(0)).cast(_SPENT)))


def outdated(current: DataFrame, metrics: DataFrame) -> DataFrame:
    """The metrics that differ from those of the current user rows."""
    old = current.select("user_id", F.col("total_bookings").alias("_bookings"),
                         F.col("total_spent").alias("_spent"))
    return metrics.join(old, "user_id").where(
        "NOT (total_bookings <=> _bookings AND total_spent <=> _spent)"
    ).drop("_bookings", "_spent")


def apply_metrics(current: DataFrame, changed: DataFrame, at: Column, by: str,
                  how: str = "left") -> DataFrame:
    """Current user rows with the ``changed`` metrics, marked as updated where they have any.

    All current rows, or with an inner join only those that change.
    """
    new = changed.select("user_id", F.col("total_bookings").alias("_bookings"),
                         F.col("total_spent").alias("_spent"))
    hit = F.col("_bookings").isNotNull()
    return (current.join(new, "user_id", how)
            .withColumns({"total_bookings": F.coalesce("_bookings", "total_bookings"),
                          "total_spent": F.coalesce("_spent", "total_spent"),
                          "updated_at": F.when(hit, at).otherwise(F.col("updated_at")),
                          "updated_by": F.when(hit, F.lit(by)).otherwise(F.col("updated_by"))})
            .select(*current.columns))


def host_listings(hosts: DataFrame, properties: DataFrame) -> DataFrame:
    """Hosts with their number of properties, 0 if none."""
    counts = properties.groupBy("host_id").agg(F.count("*").cast("int").alias("total_listings"))
    return (hosts.drop("total_listings").join(counts, "host_id", "left")
            .withColumn("total_listings", F.coalesce("total_listings", F.lit(0))))


def amount_totals(payments: DataFrame) -> DataFrame:
    """Closing totals of a run: number, sum and mean of all payment amounts."""
    return payments.agg(F.count("*").alias("payments"),
                        F.sum("amount").cast(_SPENT).alias("total_amount"),
                        F.avg("amount").cast(_SPENT).alias("mean_amount"))
