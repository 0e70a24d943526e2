"""The warehouse that the registered queries read, built table by table on first use.

Two batches of users, hosts and properties are merged, then bookings, payments and reviews
are loaded, all from the given tables. Finished tables are written once to the shared
folder, so a report scans columns of a Parquet table as it would in operation.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import facts, scd2
from ..operators.calendar import calendar
from ..operators.keys import profile
from ..schemas import empty, nullable, schema
from ..session import CODEC, scratch_path
from ..sources.fixtures import TestTables

BATCH_1 = datetime(2024, 1, 1)
BATCH_2 = datetime(2024, 2, 1)
LOADED = datetime(2024, 3, 1)
CREATED_BY = "loader"


def keep(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write a finished table to the shared folder and read it back."""
    path = scratch_path(df.sparkSession, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(nullable(df.schema)).parquet(path)


class Loaded:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.source = TestTables(spark, folder)

    def _merge(self, dim: scd2.Dimension, current: DataFrame, batch: int, start: int,
               hosts: DataFrame | None = None) -> scd2.Merge:
        enrich = None if hosts is None else lambda rows: scd2.with_current_host(rows, hosts)
        return scd2.merge(current, self.source.staged(dim.staging, batch), dim,
                          BATCH_1 if batch == 1 else BATCH_2, CREATED_BY, start_key=start,
                          enrich=enrich)

    def first(self, dim: scd2.Dimension, hosts: DataFrame | None = None) -> scd2.Merge:
        return self._merge(dim, empty(self.spark, schema(dim.table)), 1, 0, hosts)

    def second(self, dim: scd2.Dimension, before: scd2.Merge,
               hosts: DataFrame | None = None) -> scd2.Merge:
        return self._merge(dim, before.snapshot, 2, before.last_key, hosts)

    @cached_property
    def users_1(self) -> scd2.Merge:
        return self.first(scd2.USERS)

    @cached_property
    def users_2(self) -> scd2.Merge:
        return self.second(scd2.USERS, self.users_1)

    @cached_property
    def hosts_1(self) -> scd2.Merge:
        return self.first(scd2.HOSTS)

    @cached_property
    def hosts_2(self) -> scd2.Merge:
        return self.second(scd2.HOSTS, self.hosts_1)

    @cached_property
    def properties_1(self) -> scd2.Merge:
        return self.first(scd2.PROPERTIES, self.hosts_1.snapshot)

    @cached_property
    def properties_2(self) -> scd2.Merge:
        return self.second(scd2.PROPERTIES, self.properties_1, self.hosts)

    @cached_property
    def users(self) -> DataFrame:
        return keep(self.users_2.snapshot, "dim_users", "is_current")

    @cached_property
    def hosts(self) -> DataFrame:
        return keep(self.hosts_2.snapshot, "dim_hosts", "is_current")

    @cached_property
    def properties(self) -> DataFrame:
        return keep(self.properties_2.snapshot, "dim_properties", "is_current")

    @cached_property
    def dates(self) -> DataFrame:
        return keep(calendar(self.spark).coalesce(1), "dim_dates")

    @cached_property
    def staged_bookings(self) -> DataFrame:
        return keep(self.source.staged("tb_booking"), "tb_booking")

    @cached_property
    def staged_payments(self) -> DataFrame:
        return keep(self.source.staged("tb_payment"), "tb_payment")

    @cached_property
    def staged_reviews(self) -> DataFrame:
        return keep(self.source.staged("tb_review"), "tb_review")

    def load_bookings(self, version_at: str | None = None) -> facts.Load:
        staged = self.staged_bookings
        resolved = facts.resolve_bookings(staged, None, self.users, self.properties, self.dates,
                                          version_at)
        return facts.load(resolved, facts.BOOKINGS, staged.columns, LOADED,
                          ranges=profile(staged, facts.BOOKINGS.order))

    def load_payments(self) -> facts.Load:
        staged = self.staged_payments
        resolved = facts.resolve_payments(staged, None, self.bookings, self.users, self.dates)
        return facts.load(resolved, facts.PAYMENTS, staged.columns, LOADED,
                          ranges=profile(staged, facts.PAYMENTS.order))

    def load_reviews(self) -> facts.Load:
        staged = self.staged_reviews
        resolved = facts.resolve_reviews(staged, None, self.users, self.properties, self.dates)
        return facts.load(resolved, facts.REVIEWS, staged.columns, LOADED,
                          ranges=profile(staged, facts.REVIEWS.order))

    @cached_property
    def bookings(self) -> DataFrame:
        return keep(self.load_bookings().accepted, "fact_bookings")

    @cached_property
    def payments(self) -> DataFrame:
        return keep(self.load_payments().accepted, "fact_payments")

    @cached_property
    def reviews(self) -> DataFrame:
        return keep(self.load_reviews().accepted, "dim_reviews")

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        return {"dim_users": self.users, "dim_hosts": self.hosts,
                "dim_properties": self.properties, "dim_dates": self.dates,
                "fact_bookings": self.bookings, "fact_payments": self.payments,
                "dim_reviews": self.reviews}


_BUILT: dict[tuple[str, str], Loaded] = {}


def loaded(spark: SparkSession, folder: str) -> Loaded:
    """The warehouse over ``folder``, shared by the queries of one application."""
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _BUILT:
        _BUILT[key] = Loaded(spark, folder)
    return _BUILT[key]
