"""Staging frames derived from the TPC-H-like test tables.

Order dates lie before the calendar starts, so they are shifted by a whole number of days.
Users, hosts and properties come in two successive batches.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.draw import draw
from ..functions.text import guid_from, short_id
from . import staging

SHIFT_DAYS = 9497
LOADED_AT = datetime(2024, 1, 1)


def _email(name: str) -> str:
    return f"lower(concat(replace({name}, '#', '.'), '@example.com')) AS email"


class TestTables:
    """Raw frames (``users(1)`` ...) and typed staging frames (``staged("tb_user", 1)`` ...)."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def _placed(self, table: str, nation: str) -> DataFrame:
        places = self.raw("nation").join(self.raw("region"), F.expr("n_regionkey = r_regionkey"))
        return self.raw(table).join(places, F.expr(f"{nation} = n_nationkey"))

    def users(self, batch: int, whole: bool = False) -> DataFrame:
        """Users of a batch; each batch lacks some customers unless the ``whole`` is asked for."""
        number = "concat('+55', c_custkey + 10000000)"
        kind = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'vip' WHEN 'BUILDING' THEN 'premium' "
                "ELSE 'standard' END")
        if batch == 1:
            keep = "c_custkey % 10 <> 9"
            phone = f"CASE c_custkey % 7 WHEN 0 THEN null WHEN 1 THEN '' ELSE {number} END"
            city, verified = "n_name", "c_custkey % 2 = 0"
        else:
            keep = "c_custkey % 13 <> 12"
            phone = f"if(c_custkey % 7 IN (0, 1), '', {number})"
            city = "if(c_custkey % 11 = 0, concat(n_name, ' NEW'), n_name)"
            moved = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'premium' WHEN 'BUILDING' "
                     "THEN 'vip' ELSE 'premium' END")
            kind = f"if(c_custkey % 5 = 0, {moved}, {kind})"
            verified = "(c_custkey % 2 = 0) <> (c_custkey % 17 = 0)"
        rows = self._placed("customer", "c_nationkey")
        return (rows if whole else rows.where(keep)).selectExpr(
            "cast(c_custkey + 1 as int) AS user_id",
            "md5(concat('user:', c_custkey)) AS user_uuid", "c_name AS full_name",
            _email("c_name"), f"{phone} AS phone", "r_name AS country", f"{city} AS city",
            f"{kind} AS user_type", f"{verified} AS is_verified")

    def hosts(self, batch: int) -> DataFrame:
        rate = "s_suppkey % 31 + 70"
        if batch == 1:
            rate = f"CASE s_suppkey % 5 WHEN 0 THEN null WHEN 1 THEN 0 ELSE {rate} END"
            superhost = "s_suppkey % 3 = 0"
        else:
            rate = f"if(s_suppkey % 5 IN (0, 1), 0, {rate})"
            superhost = "(s_suppkey % 3 = 0) <> (s_suppkey % 4 = 1)"
        return self._placed("supplier", "s_nationkey").selectExpr(
            "cast(s_suppkey + 1 as int) AS host_id",
            "md5(concat('host:', s_suppkey)) AS host_uuid",
            "cast(s_suppkey + 1 as int) AS user_id", "s_name AS full_name", _email("s_name"),
            "date_add(DATE '2020-01-01', cast(s_suppkey % 1826 as int)) AS host_since",
            "concat_ws(', ', n_name, r_name) AS host_location",
            f"cast({rate} as smallint) AS response_rate", f"{superhost} AS is_superhost")

    def properties(self, batch: int) -> DataFrame:
        hosts = self.raw("supplier").agg(F.count("*").alias("n")).scalar()
        first = self.raw("part").withColumn("_hosts", hosts).selectExpr(
            "cast(p_partkey + 1 as int) AS property_id",
            "md5(concat('prop:', p_partkey)) AS property_uuid",
            "cast(p_partkey % (_hosts + 1) + 1 as int) AS host_id", "p_name AS title",
            "CASE p_type WHEN 'MEDIUM' THEN 'apartment' WHEN 'STANDARD' THEN 'house' "
            "WHEN 'LARGE' THEN 'cabin' WHEN 'PROMO' THEN 'loft' WHEN 'SMALL' THEN 'studio' "
            "ELSE 'villa' END AS property_type",
            "CASE p_size % 3 WHEN 0 THEN 'entire_place' WHEN 1 THEN 'private_room' "
            "ELSE 'shared_room' END AS room_type",
            "cast(p_size % 10 + 1 as smallint) AS accommodates",
            "concat('CITY_', p_partkey % 25) AS city", "'Brazil' AS country",
            "cast(p_retailprice as decimal(10,2)) AS price_per_night",
            "cast(p_partkey % 81 + 20 as decimal(10,2)) AS cleaning_fee")
        if batch == 1:
            return first
        return first.selectExpr(
            "property_id", "property_uuid",
            "if(property_id % 23 = 0, 1, host_id) AS host_id", "title",
            "if(property_id % 19 = 0, 'villa', property_type) AS property_type", "room_type",
            "cast(accommodates + if(property_id % 29 = 0, 1, 0) as smallint) AS accommodates",
            "if(property_id % 31 = 0, concat(city, '_X'), city) AS city", "country",
            "cast(if(property_id % 10 = 0, price_per_night * 1.1, price_per_night) "
            "as decimal(10,2)) AS price_per_night",
            "cast(cleaning_fee + if(property_id % 3 = 0, 5, 0) as decimal(10,2)) "
            "AS cleaning_fee")

    def bookings(self) -> DataFrame:
        lowest = self.raw("lineitem").groupBy("l_orderkey").agg(
            F.min("l_partkey").alias("min_part"))
        rows = self.raw("orders").join(lowest, F.expr("o_orderkey = l_orderkey"), "left")
        return rows.selectExpr(
            "o_orderkey + 1 AS booking_id", "cast(o_custkey + 1 as int) AS user_id",
            "cast(coalesce(min_part + 1, 0) as int) AS property_id",
            f"date_add(cast(o_orderdate as date), {SHIFT_DAYS}) AS checkin_date",
            "cast(o_orderkey % 14 + 1 as smallint) AS number_of_nights",
            "cast(o_totalprice as decimal(12,2)) AS subtotal",
            "cast(o_orderkey % 81 + 20 as decimal(12,2)) AS cleaning_fee",
            "cast(round(cast(o_totalprice as decimal(12,2)) * 0.10, 2) as decimal(12,2)) "
            "AS service_fee",
            "CASE WHEN o_orderkey % 20 < 2 THEN 'pending' WHEN o_orderkey % 20 < 12 "
            "THEN 'confirmed' WHEN o_orderkey % 20 < 15 THEN 'cancelled' "
            "WHEN o_orderkey % 20 < 19 THEN 'completed' ELSE 'no_show' END AS booking_status"
        ).selectExpr(
            "*", "md5(concat('bok:', booking_id)) AS booking_uuid",
            "date_add(checkin_date, number_of_nights) AS checkout_date",
            "cast(booking_id % 4 + 1 as smallint) AS number_of_guests",
            "cast(subtotal + cleaning_fee + service_fee as decimal(12,2)) AS total_price",
            "CASE WHEN booking_status = 'cancelled' THEN "
            "date_sub(checkin_date, cast(booking_id % 30 + 1 as int)) END AS cancellation_date",
            "date_sub(checkin_date, cast(booking_id % 90 + 1 as int)) AS created_date")

    def payments(self) -> DataFrame:
        paid_for = self.bookings().where("booking_status IN ('confirmed', 'completed')")
        return paid_for.selectExpr(
            "cast(booking_id as int) AS payment_id",
            f"{short_id('txn', 'booking_id')} AS transaction_id", "booking_id", "user_id",
            "total_price AS amount",
            "CASE booking_id % 5 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' "
            "WHEN 2 THEN 'pix' WHEN 3 THEN 'bank_transfer' ELSE 'paypal' END AS payment_method",
            "cast(if(booking_id % 10 < 4, booking_id % 12 + 1, 1) as smallint) AS installments",
            "CASE booking_id div 20 % 20 WHEN 0 THEN 'pending' WHEN 1 THEN 'refunded' "
            "WHEN 2 THEN 'failed' ELSE 'paid' END AS payment_status",
            "date_sub(checkin_date, cast(booking_id % 31 as int)) AS payment_date")

    def reviews(self) -> DataFrame:
        done = self.bookings().where("booking_status = 'completed'")
        return done.selectExpr("*", "booking_id div 20 % 20 AS _k").selectExpr(
            "booking_id AS review_id", "booking_id", "user_id", "property_id",
            "cast(CASE WHEN _k = 0 THEN 1 WHEN _k = 1 THEN 2 WHEN _k < 4 THEN 3 "
            "WHEN _k < 10 THEN 4 ELSE 5 END as smallint) AS overall_rating",
            "date_add(checkout_date, cast(booking_id % 14 + 1 as int)) AS review_date")

    def clicks(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "event_id", "cast(user_id + 1 as int) AS user_id", "event_type",
            "CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END "
            "AS device_type", "ts AS event_timestamp")

    def staged(self, table: str, batch: int = 1, whole: bool = False) -> DataFrame:
        """The cleaned and typed staging frame of a table."""
        source = {
            "tb_user": lambda: self.users(batch, whole), "tb_host": lambda: self.hosts(batch),
            "tb_property": lambda: self.properties(batch), "tb_booking": self.bookings,
            "tb_payment": self.payments, "tb_review": self.reviews, "tb_click": self.clicks,
        }[table]()
        return staging.prepare(source, table, LOADED_AT)

    def dirty_clicks(self) -> DataFrame:
        """Events with unclean identifiers, texts and numbers, as an export might hold them."""
        valid = guid_from("concat('evt:', event_id)")
        tokens = "array('None', 'NAN', 'null', ' null', 'Paris', 'nullable', '')"
        return self.raw("events").selectExpr(
            "event_id",
            f"CASE event_id % 4 WHEN 0 THEN {valid} WHEN 1 THEN upper({valid}) "
            "WHEN 2 THEN concat('txn_', event_id) END AS transaction_id",
            f"element_at({tokens}, cast({draw('event_id', 1, 7)} + 1 as int)) AS search_query",
            "event_type", "if(event_id % 5 = 0, double('nan'), value) AS value")
