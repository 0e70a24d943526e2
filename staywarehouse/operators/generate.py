"""Synthetic tables computed from ids by repeatable integer arithmetic.

Every function takes the ids to generate (a frame with one column, such as ``spark.range``)
and, for references, how many rows the parent has, as a number or a scalar subquery. Names
and texts are coded values. Columns with a leading underscore are helpers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import schemas as S
from ..functions.draw import MODULUS, between, chance, draw, pick, weighted
from ..functions.money import SERVICE_SHARE
from ..functions.text import SEED, short_id
from .keys import materialise, number
from .metrics import host_listings, with_metrics

# Default volumes.
VOLUME = {"users": 10_000, "hosts": 2_000, "properties": 5_000, "bookings": 50_000,
          "payments": 48_000, "reviews": 30_000, "clickstream": 200_000}

# Weights in percent, domains and first days of the generated tables.
USER_TYPE_WEIGHTS = {"standard": 70, "premium": 20, "vip": 10}
BOOKING_STATUS_WEIGHTS = {"pending": 10, "confirmed": 50, "cancelled": 15, "completed": 20,
                          "no_show": 5}
PAYMENT_STATUS_WEIGHTS = {"pending": 5, "paid": 85, "refunded": 5, "failed": 5}
RATING_WEIGHTS = {1: 5, 2: 5, 3: 10, 4: 30, 5: 50}
HOST_RESPONSE_TIMES = ("within_an_hour", "within_a_few_hours", "within_a_day")
AMENITIES = ("wifi", "pool", "ac", "parking", "kitchen", "tv", "washer", "pet_friendly")
EVENT_TYPES = ("view_property", "search", "click_host", "apply_filter", "add_to_wishlist",
               "share")
DEVICES = ("mobile", "desktop", "tablet")
CARD_BRANDS = ("visa", "mastercard", "amex")
MEMBER_SINCE, MEMBER_DAYS = "2020-01-01", 1826
CHECKIN_FROM, CHECKIN_DAYS = "2023-01-01", 730
CLICK_FROM, CLICK_DAYS = "2024-01-01", 365

SAMPLE_BUCKETS = 1 << 18

Count = int | Column


def _count(n: Count) -> Column:
    return n if isinstance(n, Column) else F.lit(n)


def _code(prefix: str, identity: str, salt: int, bound: int) -> str:
    return f"concat('{prefix}', {draw(identity, salt, bound)})"


def _day(first: str, offset: str) -> str:
    return f"date_add(DATE '{first}', cast({offset} as int))"


def ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1)


def sample(rows: DataFrame, n: Count, key: str, salt: int) -> DataFrame:
    """Exactly ``n`` rows (or all) without replacement, the same ones every time.

    The rows with the lowest draws are taken. A histogram of the draws finds the bucket the
    n-th row falls in, ranking that one bucket finds the row, and a filter takes all rows up
    to it. The input is read three times: write it first if it is costly.
    """
    drawn = rows.selectExpr("*", f"{draw(key, salt, MODULUS)} AS _lot").selectExpr(
        "*", f"cast(_lot * {SAMPLE_BUCKETS} div {MODULUS} as int) AS _bucket")
    # one row per bucket reaches this window, however many rows there are
    so_far = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("_n").over(so_far) - F.col("_n")
    reached = (drawn.groupBy("_bucket").agg(F.count("*").alias("_n"))
               .select("_bucket", before.alias("_before")).where(F.col("_before") < n))
    edge = reached.agg(F.max(F.struct("_bucket", "_before")).alias("edge")).scalar()
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_lot", key))
    last = (drawn.where(F.col("_bucket") == edge.getField("_bucket"))
            .select(F.struct("_lot", key).alias("_place"), rank.alias("_rank"))
            .where(F.col("_rank") + edge.getField("_before") <= n)
            .agg(F.max("_place").alias("last")).scalar())
    return drawn.where(F.struct("_lot", key) <= last).select(rows.columns)


def users(identities: DataFrame) -> DataFrame:
    i = identities.columns[0]
    joined = draw(i, 5, MEMBER_DAYS)
    return identities.selectExpr(
        f"cast({i} as int) AS user_id", f"{short_id('usr', i)} AS user_uuid",
        f"concat('User ', {i}) AS full_name", f"concat('user', {i}, '@example.com') AS email",
        f"concat('+55', {between(i, 1, 10_000_000, 99_999_999)}) AS phone",
        f"{_code('COUNTRY_', i, 2, 200)} AS country", f"{_code('CITY_', i, 3, 1000)} AS city",
        f"{weighted(i, 4, USER_TYPE_WEIGHTS)} AS user_type",
        f"{chance(i, 6, 50)} AS is_verified", "cast(0 as decimal(18,2)) AS total_spent",
        "0 AS total_bookings",
        f"cast({_day(MEMBER_SINCE, f'{joined} + {between(i, 7, 1, 365)}')} as timestamp_ntz) "
        "AS last_login")


def hosts(user_rows: DataFrame, n: Count) -> DataFrame:
    """``n`` of the users become hosts 1..n."""
    chosen = sample(user_rows.select("user_id", "full_name", "email", "phone", "city",
                                     "country"), n, "user_id", SEED)
    i = "host_id"
    return number(materialise(chosen, ["user_id"], "hosts"), i).selectExpr(
        f"cast({i} as int) AS host_id", f"{short_id('host', i)} AS host_uuid", "user_id",
        "full_name", "email", "phone",
        f"{_day(MEMBER_SINCE, draw(i, 11, MEMBER_DAYS))} AS host_since",
        "concat_ws(', ', city, country) AS host_location",
        f"cast({between(i, 12, 70, 100)} as smallint) AS response_rate",
        f"{pick(i, 13, HOST_RESPONSE_TIMES)} AS response_time",
        f"{chance(i, 14, 50)} AS is_superhost", "0 AS total_listings",
        "0 AS total_reviews_received", "cast(null as decimal(3,2)) AS average_rating")


def properties(identities: DataFrame, host_count: Count) -> DataFrame:
    i = identities.columns[0]
    tags = ", ".join(f"'{a}'" for a in AMENITIES * 2)
    first, many = draw(i, 37, len(AMENITIES)), between(i, 38, 3, 8)
    return identities.withColumn("_hosts", _count(host_count)).selectExpr(
        f"cast({i} as int) AS property_id", f"{short_id('prop', i)} AS property_uuid",
        f"cast({draw(i, 21, '_hosts')} + 1 as int) AS host_id", f"concat('Stay ', {i}) AS title",
        f"concat('Description of stay ', {i}) AS description",
        f"{pick(i, 22, S.PROPERTY_TYPES)} AS property_type",
        f"{pick(i, 23, S.ROOM_TYPES)} AS room_type",
        f"cast({between(i, 24, 1, 10)} as smallint) AS accommodates",
        f"cast({between(i, 25, 1, 5)} as smallint) AS bedrooms",
        f"cast({between(i, 26, 1, 4)} as smallint) AS bathrooms",
        f"{_code('CITY_', i, 27, 1000)} AS city",
        f"concat(chr({between(i, 28, 65, 90)}), chr({between(i, 29, 65, 90)})) AS state",
        "'Brazil' AS country",
        f"cast(({draw(i, 30, 180_000_001)} - 90000000) / 1e6 as decimal(10,8)) AS latitude",
        f"cast(({draw(i, 31, 360_000_001)} - 180000000) / 1e6 as decimal(11,8)) AS longitude",
        f"cast({between(i, 32, 50, 800)} as decimal(10,2)) AS price_per_night",
        f"cast({between(i, 33, 20, 100)} as decimal(10,2)) AS cleaning_fee",
        f"array_join(slice(array({tags}), cast({first} + 1 as int), cast({many} as int)), ',') "
        "AS _amenities",
        f"cast({between(i, 35, 1, 7)} as int) AS _min_nights",
        f"cast({between(i, 36, 7, 90)} as int) AS _max_nights")


def bookings(identities: DataFrame, user_count: Count, property_rows: DataFrame,
             property_count: Count) -> DataFrame:
    """Bookings of random users and properties; guests never exceed what a property takes."""
    i = identities.columns[0]
    place = property_rows.select("property_id", "price_per_night", "cleaning_fee",
                                 "accommodates", "_min_nights", "_max_nights")
    drawn = (identities.withColumn("_users", _count(user_count))
             .withColumn("_properties", _count(property_count)).selectExpr(
        i, f"cast({draw(i, 41, '_users')} + 1 as int) AS user_id",
        f"cast({draw(i, 42, '_properties')} + 1 as int) AS property_id",
        f"{_day(CHECKIN_FROM, draw(i, 43, CHECKIN_DAYS))} AS checkin_date",
        f"{weighted(i, 44, BOOKING_STATUS_WEIGHTS)} AS booking_status"))
    span = "least(_max_nights, 30) - _min_nights + 1"
    rows = (drawn.join(place, "property_id")
            .selectExpr("*", f"cast(_min_nights + {draw(i, 45, span)} as int) AS _nights")
            .selectExpr("*", "cast(price_per_night * _nights as decimal(12,2)) AS _subtotal")
            .selectExpr("*", f"cast(round(_subtotal * {SERVICE_SHARE}, 2) as decimal(12,2)) "
                             "AS service_fee"))
    return rows.selectExpr(
        f"cast({i} as bigint) AS booking_id", f"{short_id('bok', i)} AS booking_uuid", "user_id",
        "property_id", "checkin_date", "date_add(checkin_date, _nights) AS checkout_date",
        "cast(_nights as smallint) AS number_of_nights",
        f"cast({draw(i, 46, 'accommodates')} + 1 as smallint) AS number_of_guests",
        "_subtotal AS subtotal", "cast(cleaning_fee as decimal(12,2)) AS cleaning_fee",
        "service_fee",
        "cast(_subtotal + cleaning_fee + service_fee as decimal(12,2)) AS total_price",
        "booking_status",
        f"CASE WHEN booking_status = 'cancelled' THEN "
        f"date_sub(checkin_date, cast({between(i, 47, 1, 30)} as int)) END AS cancellation_date",
        f"date_sub(checkin_date, cast({between(i, 48, 1, 90)} as int)) AS created_date")


def payments(booking_rows: DataFrame, n: Count | None = None) -> DataFrame:
    """Payments 1..m of confirmed and completed bookings, at most ``n`` of them."""
    eligible = booking_rows.where("booking_status IN ('confirmed', 'completed')").select(
        "booking_id", "user_id", "total_price", "checkin_date")
    if n is not None:
        written = materialise(eligible, ["booking_id"], "eligible")
        eligible = sample(written, n, "booking_id", SEED)
    i = "payment_id"
    return number(materialise(eligible, ["booking_id"], "payments"), i).selectExpr(
        f"cast({i} as int) AS payment_id", f"{short_id('txn', i)} AS transaction_id",
        "booking_id", "user_id", "total_price AS amount",
        f"{pick(i, 51, S.PAYMENT_METHODS)} AS payment_method",
        f"cast(if({chance(i, 52, 40)}, {between(i, 53, 1, 12)}, 1) as smallint) "
        "AS installments",
        f"{weighted(i, 54, PAYMENT_STATUS_WEIGHTS)} AS payment_status",
        f"date_sub(checkin_date, cast({between(i, 55, 0, 30)} as int)) AS payment_date")


def reviews(booking_rows: DataFrame, n: Count | None = None) -> DataFrame:
    """Reviews 1..m of completed bookings, at most ``n`` of them."""
    done = booking_rows.where("booking_status = 'completed'").select(
        "booking_id", "user_id", "property_id", "checkout_date")
    if n is not None:
        done = sample(materialise(done, ["booking_id"], "done"), n, "booking_id", SEED)
    i = "review_id"
    rated = number(materialise(done, ["booking_id"], "reviews"), i).selectExpr(
        "*", f"cast({weighted(i, 61, RATING_WEIGHTS)} as smallint) AS overall_rating")
    return rated.selectExpr(
        i, "booking_id", "user_id", "property_id", "overall_rating",
        f"if(overall_rating >= 3 OR {chance(i, 62, 70)}, concat('Comment ', {i}), null) "
        "AS comment_text",
        f"date_add(checkout_date, cast({between(i, 63, 1, 14)} as int)) AS review_date",
        f"if({chance(i, 64, 40)}, concat('Response ', {i}), null) AS host_response")


def clickstream(identities: DataFrame, user_count: Count, property_count: Count) -> DataFrame:
    i = identities.columns[0]
    return (identities.withColumn("_users", _count(user_count))
            .withColumn("_properties", _count(property_count)).selectExpr(
        f"cast({i} as bigint) AS event_id",
        f"cast({draw(i, 71, '_users')} + 1 as int) AS user_id",
        f"{short_id('sess', between(i, 72, 1, 10_000))} AS session_id",
        f"{pick(i, 73, EVENT_TYPES)} AS event_type",
        f"if({chance(i, 74, 50)}, cast({draw(i, 75, '_properties')} + 1 as int), null) "
        "AS property_id",
        f"if({chance(i, 76, 30)}, {_code('CITY_', i, 77, 1000)}, null) AS search_query",
        f"{pick(i, 78, DEVICES)} AS device_type",
        f"cast({_day(CLICK_FROM, draw(i, 79, CLICK_DAYS))} as timestamp_ntz) "
        "AS event_timestamp"))


def _check_digit(digits: str, weight: int) -> str:
    """Weighted digit sum modulo 11; remainders 0 and 1 give 0."""
    terms = " + ".join(f"cast(substring({digits}, {p}, 1) as int) * {weight + 1 - p}"
                       for p in range(1, weight))
    return f"cast(if(({terms}) % 11 < 2, 0, 11 - ({terms}) % 11) as string)"


def sensitive(identities: DataFrame) -> DataFrame:
    """Card ends, card brands and formally valid taxpayer numbers, kept apart from users."""
    i = identities.columns[0]
    return (identities.selectExpr(
        f"cast({i} as int) AS user_id",
        f"cast({between(i, 81, 1000, 9999)} as string) AS credit_card_last4",
        f"{pick(i, 82, CARD_BRANDS)} AS credit_card_brand",
        f"lpad(cast({draw(i, 83, 1_000_000_000)} as string), 9, '0') AS _nine")
        .selectExpr("*", f"concat(_nine, {_check_digit('_nine', 10)}) AS _ten")
        .selectExpr("*", f"concat(_ten, {_check_digit('_ten', 11)}) AS _all")
        .select("user_id", "credit_card_last4", "credit_card_brand", F.regexp_replace(
            "_all", r"^(\d{3})(\d{3})(\d{3})(\d{2})$", "$1.$2.$3-$4").alias("cpf")))


def normal_status(status: Column) -> Column:
    """Older status names for cancellations become the declared one."""
    return F.when(status.isin("cancelled_by_user", "cancelled_by_host"), "cancelled").otherwise(
        status)


def everything(spark: SparkSession, volume: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """All tables with references resolved and user and host metrics filled in."""
    size = {**VOLUME, **(volume or {})}
    user_rows = users(ids(spark, size["users"]))
    host_rows = hosts(user_rows, size["hosts"])
    property_rows = properties(ids(spark, size["properties"]), size["hosts"])
    booking_rows = bookings(ids(spark, size["bookings"]), size["users"], property_rows,
                            size["properties"])
    payment_rows = payments(booking_rows, size["payments"])
    return {
        "users": with_metrics(user_rows, booking_rows, payment_rows),
        "hosts": host_listings(host_rows, property_rows),
        "properties": property_rows,
        "bookings": booking_rows,
        "payments": payment_rows,
        "reviews": reviews(booking_rows, size["reviews"]),
        "clickstream": clickstream(ids(spark, size["clickstream"]), size["users"],
                                   size["properties"]),
    }
