"""Explicit schemas, declared defaults, value domains and column lengths.

Schemas are never inferred. SQL ``TINYINT`` is 0..255, so it maps to ``smallint``;
date-times carry no zone and whole seconds.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

OPEN_END = "9999-12-31 23:59:59"

_VERSION_COLUMNS = """
    valid_from timestamp_ntz not null, valid_to timestamp_ntz not null,
    is_current boolean not null, version_number int not null,
    created_at timestamp_ntz not null, created_by string not null,
    updated_at timestamp_ntz, updated_by string"""

# Columns, types and not-null marks of all tables.
_DDL = {
    # staging
    "tb_user": """
        user_id int not null, user_uuid string not null, full_name string not null,
        email string not null, phone string, country string, city string,
        user_type string not null, is_verified boolean not null,
        total_spent decimal(18,2) not null, total_bookings int not null,
        last_login timestamp_ntz, loaded_at timestamp_ntz not null""",
    "tb_host": """
        host_id int not null, host_uuid string not null, user_id int not null,
        full_name string not null, email string not null, phone string,
        host_since date not null, host_location string, response_rate smallint,
        response_time string, is_superhost boolean not null,
        total_listings int not null, total_reviews_received int not null,
        average_rating decimal(3,2)""",
    "tb_property": """
        property_id int not null, property_uuid string not null, host_id int not null,
        title string not null, description string, property_type string not null,
        room_type string not null, accommodates smallint not null, bedrooms smallint,
        bathrooms smallint, city string not null, state string, country string not null,
        latitude decimal(10,8), longitude decimal(11,8),
        price_per_night decimal(10,2) not null, cleaning_fee decimal(10,2) not null,
        loaded_at timestamp_ntz not null""",
    "tb_booking": """
        booking_id bigint not null, booking_uuid string not null, user_id int not null,
        property_id int not null, checkin_date date not null, checkout_date date not null,
        number_of_nights smallint not null, number_of_guests smallint not null,
        subtotal decimal(12,2) not null, cleaning_fee decimal(12,2) not null,
        service_fee decimal(12,2) not null, total_price decimal(12,2) not null,
        booking_status string not null, cancellation_date date,
        created_date date not null, loaded_at timestamp_ntz not null""",
    "tb_payment": """
        payment_id int not null, transaction_id string not null, booking_id bigint not null,
        user_id int not null, amount decimal(12,2) not null, payment_method string not null,
        installments smallint not null, payment_status string not null,
        payment_date date not null, loaded_at timestamp_ntz not null""",
    "tb_review": """
        review_id bigint not null, booking_id bigint not null, user_id int not null,
        property_id int not null, overall_rating smallint not null, comment_text string,
        review_date date not null, host_response string, loaded_at timestamp_ntz not null""",
    "tb_click": """
        event_id bigint not null, user_id int not null, session_id string,
        event_type string not null, property_id int, search_query string,
        device_type string not null, event_timestamp timestamp_ntz not null""",
    # dimensions
    "dim_dates": """
        date_sk int not null, full_date date not null, year_number smallint not null,
        quarter_number smallint not null, semester_number smallint not null,
        month_number smallint not null, month_name string not null,
        month_abbreviation string not null, week_number smallint not null,
        week_of_month smallint not null, day_of_month smallint not null,
        day_of_week smallint not null, day_name string not null,
        day_abbreviation string not null, is_weekend boolean not null,
        is_month_start boolean not null, is_month_end boolean not null,
        is_quarter_start boolean not null, is_quarter_end boolean not null,
        is_year_start boolean not null, is_year_end boolean not null,
        fiscal_year smallint, fiscal_quarter smallint""",
    "dim_users": """
        user_sk bigint not null, user_id int not null, user_uuid string not null,
        full_name string not null, email string not null, phone string, country string,
        city string, user_type string not null, is_verified boolean not null,
        total_spent decimal(18,2) not null, total_bookings int not null,
        last_login timestamp_ntz, attribute_hash string,""" + _VERSION_COLUMNS,
    "dim_hosts": """
        host_sk bigint not null, host_id int not null, host_uuid string not null,
        full_name string not null, email string not null, phone string,
        host_since date not null, host_location string, response_rate smallint,
        response_time string, is_superhost boolean not null, total_listings int not null,
        total_reviews_received int not null, average_rating decimal(3,2),"""
        + _VERSION_COLUMNS,
    "dim_properties": """
        property_sk bigint not null, property_id int not null, property_uuid string not null,
        host_sk bigint, title string not null, description string,
        property_type string not null, room_type string not null,
        accommodates smallint not null, bedrooms smallint, bathrooms smallint,
        city string not null, state string, country string not null,
        latitude decimal(10,8), longitude decimal(11,8),
        price_per_night decimal(10,2) not null, cleaning_fee decimal(10,2) not null,"""
        + _VERSION_COLUMNS,
    # facts
    "fact_bookings": """
        booking_sk bigint not null, booking_id bigint not null, booking_uuid string not null,
        user_sk bigint not null, property_sk bigint not null, checkin_date_sk int not null,
        checkout_date_sk int not null, created_date_sk int not null,
        number_of_nights smallint not null, number_of_guests smallint not null,
        subtotal decimal(12,2) not null, cleaning_fee decimal(12,2) not null,
        service_fee decimal(12,2) not null, total_price decimal(12,2) not null,
        booking_status string not null, cancellation_date date, cancellation_reason string,
        created_at timestamp_ntz not null, updated_at timestamp_ntz""",
    "fact_payments": """
        payment_sk bigint not null, payment_id int not null, transaction_id string not null,
        booking_sk bigint not null, user_sk bigint not null, payment_date_sk int not null,
        amount decimal(12,2) not null, payment_method string not null,
        installments smallint not null, fee_amount decimal(10,2) not null,
        net_amount decimal(12,2) not null, payment_status string not null,
        refund_date date, refund_amount decimal(12,2), created_at timestamp_ntz not null""",
    "dim_reviews": """
        review_sk bigint not null, review_id bigint not null, booking_id bigint not null,
        user_sk bigint not null, property_sk bigint not null, review_date_sk int not null,
        rating_accuracy smallint, rating_cleanliness smallint, rating_checkin smallint,
        rating_communication smallint, rating_location smallint, rating_value smallint,
        overall_rating smallint not null, comment_title string, comment_text string,
        host_response string, host_response_date date, created_at timestamp_ntz not null""",
    # operation logs
    "etl_batch_log": """
        batch_id bigint not null, table_name string not null, operation_type string not null,
        rows_affected bigint, start_time timestamp_ntz not null, end_time timestamp_ntz,
        created_by string not null, created_at timestamp_ntz not null""",
    "etl_error_log": """
        error_id string not null, batch_id bigint, error_number int not null,
        error_severity int, error_state int, error_line int, error_procedure string,
        error_message string not null, error_timestamp timestamp_ntz not null,
        created_by string not null""",
    # what audits found in batches (operators.audit_states)
    "audit_states": """
        table_name string not null, basis string not null, rule string not null,
        check_name string not null, key_text string, n bigint not null""",
}

# Declared column defaults (load times and users are run parameters).
DEFAULTS = {
    "tb_user": {"is_verified": "false", "total_spent": "0", "total_bookings": "0"},
    "tb_host": {"is_superhost": "false", "total_listings": "0", "total_reviews_received": "0"},
    "tb_property": {"cleaning_fee": "0"},
    "tb_booking": {"service_fee": "0"},
    "tb_payment": {"installments": "1"},
}

# Business key of every staging table, then further unique columns.
STAGING_KEYS = {
    "tb_user": "user_id",
    "tb_host": "host_id",
    "tb_property": "property_id",
    "tb_booking": "booking_id",
    "tb_payment": "payment_id",
    "tb_review": "review_id",
    "tb_click": "event_id",
}
STAGING_UNIQUE = {"tb_payment": ("transaction_id",)}

# The order in which generated tables are routed to staging tables.
STAGING_ROUTES = {
    "users": "tb_user",
    "hosts": "tb_host",
    "properties": "tb_property",
    "bookings": "tb_booking",
    "payments": "tb_payment",
    "reviews": "tb_review",
}

# Columns that hold GUIDs.
GUID_COLUMNS = ("user_uuid", "host_uuid", "property_uuid", "booking_uuid", "transaction_id")

# Columns the warehouse adds, pruned before a staging load.
WAREHOUSE_ONLY = (
    "attribute_hash", "valid_from", "valid_to", "is_current", "version_number",
    "created_at", "created_by", "updated_at", "updated_by",
    "checkin_date_sk", "checkout_date_sk", "created_date_sk", "payment_date_sk",
)

# Allowed values.
USER_TYPES = ("standard", "premium", "vip")
BOOKING_STATUSES = ("pending", "confirmed", "cancelled", "completed", "no_show")
PAYMENT_STATUSES = ("pending", "paid", "refunded", "failed")
PAYMENT_METHODS = ("credit_card", "debit_card", "pix", "bank_transfer", "paypal")
PROPERTY_TYPES = ("apartment", "house", "cabin", "loft", "studio", "villa")
ROOM_TYPES = ("entire_place", "private_room", "shared_room")
RESPONSE_TIMES = ("within_an_hour", "within_a_few_hours", "within_a_day", "within_a_week")

# Declared text lengths.
MAX_LENGTH = {
    "tb_user": {"full_name": 150, "email": 320, "phone": 20, "country": 100, "city": 100,
                "user_type": 20},
    "tb_host": {"host_uuid": 36, "full_name": 150, "email": 320, "phone": 20,
                "host_location": 200, "response_time": 30},
    "tb_property": {"title": 200, "property_type": 50, "room_type": 30, "city": 100,
                    "state": 2, "country": 100},
    "tb_booking": {"booking_status": 20},
    "tb_payment": {"transaction_id": 100, "payment_method": 30, "payment_status": 20},
    "dim_users": {"full_name": 150, "email": 320, "phone": 20, "country": 100, "city": 100,
                  "user_type": 20, "attribute_hash": 64, "created_by": 100, "updated_by": 100},
    "dim_hosts": {"full_name": 150, "email": 320, "phone": 20, "host_location": 200,
                  "response_time": 30, "created_by": 100, "updated_by": 100},
    "dim_properties": {"title": 200, "property_type": 50, "room_type": 30, "city": 100,
                       "state": 2, "country": 100, "created_by": 100, "updated_by": 100},
    "fact_bookings": {"booking_status": 20, "cancellation_reason": 200},
    "fact_payments": {"transaction_id": 100, "payment_method": 30, "payment_status": 20},
    "dim_reviews": {"comment_title": 200},
}


_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "smallint": T.ShortType(),
          "string": T.StringType(), "boolean": T.BooleanType(), "date": T.DateType(),
          "timestamp_ntz": T.TimestampNTZType()}


def _type(kind: str) -> T.DataType:
    digits = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
    return T.DecimalType(*map(int, digits.groups())) if digits else _TYPES[kind]


@lru_cache(maxsize=None)
def schema(table: str) -> T.StructType:
    """The declared schema of a staging, dimension, fact or log table."""
    fields = []
    for column in re.split(r",\s+", _DDL[table].strip()):
        name, kind, *required = column.split()
        fields.append(T.StructField(name, _type(kind), not required))
    return T.StructType(fields)


def tables() -> tuple[str, ...]:
    return tuple(_DDL)


def nullable(struct: T.StructType) -> T.StructType:
    """The same fields without the not-null marks, for reading files."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in struct])


def one_row(spark: SparkSession, struct: T.StructType, values: Sequence[object]) -> DataFrame:
    """One row of literals, such as a log entry."""
    cells = [F.lit(f"{v:%Y-%m-%d %H:%M:%S}" if isinstance(v, datetime) else v)
             .cast(f.dataType).alias(f.name) for f, v in zip(struct, values, strict=True)]
    return spark.range(0, 1, 1, 1).select(*cells)


def empty(spark: SparkSession, struct: T.StructType) -> DataFrame:
    """No rows; the optimiser sees this and drops joins with it."""
    columns = [f"cast(null as {f.dataType.simpleString()}) AS {f.name}" for f in struct]
    return spark.range(0, 1, 1, 1).where("false").selectExpr(*columns)


def enforce(df: DataFrame, table: str, computed: Mapping[str, Column] | None = None,
            safe: bool = False) -> DataFrame:
    """Project ``df`` on the declared columns, filling defaults and casting."""
    return df.select(*typed(df, table, computed, safe))


def typed(df: DataFrame, table: str, computed: Mapping[str, Column] | None = None,
          safe: bool = False) -> list[Column | str]:
    """The declared columns of ``table`` as expressions over ``df``.

    A column missing from ``df`` takes its value from ``computed``, then from the declared
    default, then NULL. A column that is present keeps its value, NULLs taking the default.
    ``safe`` turns a bad cast into NULL, to be rejected by the caller, instead of an error.
    """
    computed = computed or {}
    defaults = DEFAULTS.get(table, {})
    given = {f.name: f.dataType for f in df.schema}
    cast = "try_cast" if safe else "cast"
    out: list[Column | str] = []
    for field in schema(table):
        name, kind = field.name, field.dataType
        if name in computed:
            value = computed[name]
            if name in given:
                value = F.coalesce(F.col(name), value)
            out.append(value.cast(kind).alias(name))
        elif given.get(name) == kind and name not in defaults:
            out.append(name)
        else:
            value = name if name in given else "null"
            if name in defaults:
                value = f"coalesce({value}, {defaults[name]})"
            out.append(F.expr(f"{cast}({value} as {kind.simpleString()}) as {name}"))
    return out
