"""The SQL each registered query must equal, written for DuckDB over the given tables.

Named subqueries are shared text; a statement carries those it refers to.
"""

from __future__ import annotations

import re

from ..operators import generate as G
from .. import schemas as S

M = 2147483647
B1, B2, LOADED = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
END = "9999-12-31 23:59:59"
STAGED_AT = "2024-01-01 00:00:00"


# ---- expression helpers -------------------------------------------------------------


def cols(spec: str) -> str:
    """``a b:t c:d`` -> a plain, b as text, c as double."""
    out = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        cast = {"t": "VARCHAR", "d": "DOUBLE"}.get(kind)
        out.append(f"CAST({name} AS {cast}) AS {name}" if cast else name)
    return ", ".join(out)


def guid(value: str, column: str, key: str) -> str:
    shaped = (f"regexp_replace(md5(concat_ws(':', '{column}', CAST({key} AS VARCHAR), "
              f"coalesce({value}, ''))), "
              "'^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5')")
    return f"CASE WHEN {is_guid(value)} THEN {value} ELSE {shaped} END"


def is_guid(value: str) -> str:
    return (f"coalesce(length({value}) = 36 AND "
            f"regexp_full_match(replace({value}, '-', ''), '[0-9a-fA-F]{{32}}'), false)")


def draw(i: str, salt: int, bound: int | str) -> str:
    first = f"(((CAST({i} AS BIGINT) % {M}) * 48271 + {salt * 69621}) % {M})"
    second = f"(({first} * {first}) % {M})"
    return f"((({second} * 16807 + {first} * 40692 + {salt}) % {M}) % ({bound}))"


def pick(i: str, salt: int, values) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{draw(i, salt, len(values))} + 1]"


def weighted(i: str, salt: int, weights: dict) -> str:
    ticket, reached, arms = draw(i, salt, 100), 0, []
    for value, weight in weights.items():
        reached += weight
        shown = f"'{value}'" if isinstance(value, str) else str(value)
        arms.append(f"WHEN {ticket} < {reached} THEN {shown}")
    return f"CASE {' '.join(arms)} END"


def chance(i: str, salt: int, percent: int) -> str:
    return f"({draw(i, salt, 100)} < {percent})"


def short_id(prefix: str, i: str) -> str:
    return (f"concat('{prefix}_', substr(md5(concat('{prefix}_', CAST({i} AS VARCHAR), "
            "'_42')), 1, 8))")


def day(first: str, offset: str) -> str:
    return f"(DATE '{first}' + CAST({offset} AS INTEGER))"


def rounded(amount: str, part: str, kind: str = "DECIMAL(12,2)") -> str:
    return f"CAST(round({amount} * {part}, 2) AS {kind})"


def us_week(d: str) -> str:
    return f"(dayofyear({d}) - 1 + dayofweek(date_trunc('year', {d}))) // 7 + 1"


def ranked_sample(source: str, key: str, n: str, salt: int = 42) -> str:
    return (f"SELECT * EXCLUDE (_r) FROM (SELECT *, row_number() OVER (ORDER BY "
            f"{draw(key, salt, M)}, {key}) AS _r FROM {source}) q WHERE _r <= {n}")


CTE: dict[str, str] = {}

# ---- staging ------------------------------------------------------------------------

for _batch in (1, 2):
    if _batch == 1:
        _phone = """CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN ''
            ELSE concat('+55', CAST(10000000 + c_custkey AS VARCHAR)) END"""
        _city, _verified, _where = "n_name", "c_custkey % 2 = 0", "c_custkey % 10 <> 9"
        _type = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'vip' WHEN 'BUILDING' THEN 'premium'
            ELSE 'standard' END"""
    else:
        _phone = """CASE WHEN c_custkey % 7 IN (0, 1) THEN ''
            ELSE concat('+55', CAST(10000000 + c_custkey AS VARCHAR)) END"""
        _city = "CASE WHEN c_custkey % 11 = 0 THEN concat(n_name, ' NEW') ELSE n_name END"
        _verified, _where = "(c_custkey % 2 = 0) <> (c_custkey % 17 = 0)", "c_custkey % 13 <> 12"
        _type = """CASE WHEN c_custkey % 5 = 0 THEN CASE c_mktsegment
              WHEN 'AUTOMOBILE' THEN 'premium' WHEN 'BUILDING' THEN 'vip' ELSE 'premium' END
            ELSE CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'vip' WHEN 'BUILDING' THEN 'premium'
              ELSE 'standard' END END"""
    CTE[f"raw_user_{_batch}_all"] = f"""
        SELECT CAST(c_custkey + 1 AS INTEGER) AS user_id,
          md5(concat('user:', CAST(c_custkey AS VARCHAR))) AS user_uuid, c_name AS full_name,
          lower(concat(replace(c_name, '#', '.'), '@example.com')) AS email, {_phone} AS phone,
          r_name AS country, {_city} AS city, {_type} AS user_type, {_verified} AS is_verified
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey"""
    CTE[f"stg_user_{_batch}_all"] = f"""
        SELECT user_id, {guid('user_uuid', 'user_uuid', 'user_id')} AS user_uuid, full_name,
          email, phone, country, city, user_type, is_verified,
          CAST(0 AS DECIMAL(18,2)) AS total_spent, 0 AS total_bookings,
          CAST(NULL AS TIMESTAMP) AS last_login, TIMESTAMP '{STAGED_AT}' AS loaded_at
        FROM raw_user_{_batch}_all"""
    CTE[f"stg_user_{_batch}"] = f"""
        SELECT s.* FROM stg_user_{_batch}_all s JOIN customer ON s.user_id = c_custkey + 1
        WHERE {_where}"""
    _rate = ("CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 5 = 1 THEN 0 "
             "ELSE 70 + s_suppkey % 31 END" if _batch == 1 else
             "CASE WHEN s_suppkey % 5 IN (0, 1) THEN 0 ELSE 70 + s_suppkey % 31 END")
    _super = ("s_suppkey % 3 = 0" if _batch == 1 else
              "(s_suppkey % 3 = 0) <> (s_suppkey % 4 = 1)")
    CTE[f"raw_host_{_batch}"] = f"""
        SELECT CAST(s_suppkey + 1 AS INTEGER) AS host_id,
          md5(concat('host:', CAST(s_suppkey AS VARCHAR))) AS host_uuid,
          CAST(s_suppkey + 1 AS INTEGER) AS user_id, s_name AS full_name,
          lower(concat(replace(s_name, '#', '.'), '@example.com')) AS email,
          DATE '2020-01-01' + CAST(s_suppkey % 1826 AS INTEGER) AS host_since,
          concat_ws(', ', n_name, r_name) AS host_location,
          CAST({_rate} AS SMALLINT) AS response_rate, {_super} AS is_superhost
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey"""
    CTE[f"stg_host_{_batch}"] = f"""
        SELECT host_id, {guid('host_uuid', 'host_uuid', 'host_id')} AS host_uuid, user_id,
          full_name, email, CAST(NULL AS VARCHAR) AS phone, host_since, host_location,
          response_rate, CAST(NULL AS VARCHAR) AS response_time, is_superhost,
          0 AS total_listings, 0 AS total_reviews_received,
          CAST(NULL AS DECIMAL(3,2)) AS average_rating
        FROM raw_host_{_batch}"""

CTE["raw_property_1"] = """
    SELECT CAST(p_partkey + 1 AS INTEGER) AS property_id,
      md5(concat('prop:', CAST(p_partkey AS VARCHAR))) AS property_uuid,
      CAST(p_partkey % (SELECT count(*) + 1 FROM supplier) + 1 AS INTEGER) AS host_id,
      p_name AS title,
      CASE p_type WHEN 'MEDIUM' THEN 'apartment' WHEN 'STANDARD' THEN 'house'
        WHEN 'LARGE' THEN 'cabin' WHEN 'PROMO' THEN 'loft' WHEN 'SMALL' THEN 'studio'
        ELSE 'villa' END AS property_type,
      CASE p_size % 3 WHEN 0 THEN 'entire_place' WHEN 1 THEN 'private_room'
        ELSE 'shared_room' END AS room_type,
      CAST(p_size % 10 + 1 AS SMALLINT) AS accommodates,
      concat('CITY_', CAST(p_partkey % 25 AS VARCHAR)) AS city, 'Brazil' AS country,
      CAST(p_retailprice AS DECIMAL(10,2)) AS price_per_night,
      CAST(20 + p_partkey % 81 AS DECIMAL(10,2)) AS cleaning_fee
    FROM part"""
CTE["raw_property_2"] = """
    SELECT property_id, property_uuid,
      CAST(CASE WHEN property_id % 23 = 0 THEN 1 ELSE host_id END AS INTEGER) AS host_id, title,
      CASE WHEN property_id % 19 = 0 THEN 'villa' ELSE property_type END AS property_type,
      room_type,
      CAST(CASE WHEN property_id % 29 = 0 THEN accommodates + 1 ELSE accommodates END
        AS SMALLINT) AS accommodates,
      CASE WHEN property_id % 31 = 0 THEN concat(city, '_X') ELSE city END AS city, country,
      CAST(CASE WHEN property_id % 10 = 0 THEN price_per_night * 1.1 ELSE price_per_night END
        AS DECIMAL(10,2)) AS price_per_night,
      CAST(CASE WHEN property_id % 3 = 0 THEN cleaning_fee + 5 ELSE cleaning_fee END
        AS DECIMAL(10,2)) AS cleaning_fee
    FROM raw_property_1"""
for _batch in (1, 2):
    CTE[f"stg_property_{_batch}"] = f"""
        SELECT property_id, {guid('property_uuid', 'property_uuid', 'property_id')}
            AS property_uuid, host_id, title, CAST(NULL AS VARCHAR) AS description,
          property_type, room_type, accommodates, CAST(NULL AS SMALLINT) AS bedrooms,
          CAST(NULL AS SMALLINT) AS bathrooms, city, CAST(NULL AS VARCHAR) AS state, country,
          CAST(NULL AS DECIMAL(10,8)) AS latitude, CAST(NULL AS DECIMAL(11,8)) AS longitude,
          price_per_night, cleaning_fee, TIMESTAMP '{STAGED_AT}' AS loaded_at
        FROM raw_property_{_batch}"""

CTE["lowest_part"] = "SELECT l_orderkey, min(l_partkey) AS min_part FROM lineitem GROUP BY 1"
CTE["raw_booking_base"] = """
    SELECT o_orderkey + 1 AS booking_id, CAST(o_custkey + 1 AS INTEGER) AS user_id,
      CAST(coalesce(min_part + 1, 0) AS INTEGER) AS property_id,
      CAST(o_orderdate AS DATE) + 9497 AS checkin_date,
      CAST(o_orderkey % 14 + 1 AS INTEGER) AS nights,
      CAST(o_totalprice AS DECIMAL(12,2)) AS subtotal,
      CAST(20 + o_orderkey % 81 AS DECIMAL(12,2)) AS cleaning_fee,
      CAST(round(CAST(o_totalprice AS DECIMAL(12,2)) * 0.10, 2) AS DECIMAL(12,2)) AS service_fee,
      CASE WHEN o_orderkey % 20 < 2 THEN 'pending' WHEN o_orderkey % 20 < 12 THEN 'confirmed'
        WHEN o_orderkey % 20 < 15 THEN 'cancelled' WHEN o_orderkey % 20 < 19 THEN 'completed'
        ELSE 'no_show' END AS booking_status
    FROM orders LEFT JOIN lowest_part ON o_orderkey = l_orderkey"""
CTE["stg_booking"] = f"""
    SELECT booking_id,
      {guid("md5(concat('bok:', CAST(booking_id AS VARCHAR)))", 'booking_uuid', 'booking_id')}
        AS booking_uuid, user_id, property_id, checkin_date,
      checkin_date + nights AS checkout_date, CAST(nights AS SMALLINT) AS number_of_nights,
      CAST(booking_id % 4 + 1 AS SMALLINT) AS number_of_guests, subtotal, cleaning_fee,
      service_fee, CAST(subtotal + cleaning_fee + service_fee AS DECIMAL(12,2)) AS total_price,
      booking_status,
      CASE WHEN booking_status = 'cancelled'
        THEN checkin_date - CAST(booking_id % 30 + 1 AS INTEGER) END AS cancellation_date,
      checkin_date - CAST(booking_id % 90 + 1 AS INTEGER) AS created_date,
      TIMESTAMP '{STAGED_AT}' AS loaded_at
    FROM raw_booking_base"""
_raw_txn = "concat('txn_', substr(md5(concat('txn_', CAST(booking_id AS VARCHAR), '_42')), 1, 8))"
CTE["stg_payment"] = f"""
    SELECT CAST(booking_id AS INTEGER) AS payment_id,
      {guid(_raw_txn, 'transaction_id', 'booking_id')} AS transaction_id, booking_id, user_id,
      total_price AS amount,
      CASE booking_id % 5 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' WHEN 2 THEN 'pix'
        WHEN 3 THEN 'bank_transfer' ELSE 'paypal' END AS payment_method,
      CAST(CASE WHEN booking_id % 10 < 4 THEN booking_id % 12 + 1 ELSE 1 END AS SMALLINT)
        AS installments,
      CASE (booking_id // 20) % 20 WHEN 0 THEN 'pending' WHEN 1 THEN 'refunded'
        WHEN 2 THEN 'failed' ELSE 'paid' END AS payment_status,
      checkin_date - CAST(booking_id % 31 AS INTEGER) AS payment_date, loaded_at
    FROM stg_booking WHERE booking_status IN ('confirmed', 'completed')"""
CTE["stg_review"] = """
    SELECT booking_id AS review_id, booking_id, user_id, property_id,
      CAST(CASE WHEN k = 0 THEN 1 WHEN k = 1 THEN 2 WHEN k < 4 THEN 3 WHEN k < 10 THEN 4 ELSE 5
        END AS SMALLINT) AS overall_rating,
      checkout_date + CAST(booking_id % 14 + 1 AS INTEGER) AS review_date, loaded_at
    FROM (SELECT *, (booking_id // 20) % 20 AS k FROM stg_booking
          WHERE booking_status = 'completed') c"""

# ---- calendar -----------------------------------------------------------------------

_DAY_COLUMNS = f"""
    CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_sk, d AS full_date,
    year(d) AS year_number, quarter(d) AS quarter_number,
    CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS semester_number, month(d) AS month_number,
    monthname(d) AS month_name, left(monthname(d), 3) AS month_abbreviation,
    {us_week('d')} AS week_number, (day(d) - 1) // 7 + 1 AS week_of_month,
    day(d) AS day_of_month, dayofweek(d) + 1 AS day_of_week, dayname(d) AS day_name,
    left(dayname(d), 3) AS day_abbreviation, dayofweek(d) IN (0, 6) AS is_weekend,
    day(d) = 1 AS is_month_start, d = last_day(d) AS is_month_end,
    month(d) IN (1, 4, 7, 10) AND day(d) = 1 AS is_quarter_start,
    month(d) IN (3, 6, 9, 12) AND d = last_day(d) AS is_quarter_end,
    month(d) = 1 AND day(d) = 1 AS is_year_start,
    month(d) = 12 AND day(d) = 31 AS is_year_end,
    CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS fiscal_year,
    CASE WHEN month(d) IN (7, 8, 9) THEN 1 WHEN month(d) IN (10, 11, 12) THEN 2
      WHEN month(d) IN (1, 2, 3) THEN 3 ELSE 4 END AS fiscal_quarter"""
CTE["dim_dates"] = f"""
    SELECT {_DAY_COLUMNS} FROM (SELECT CAST(g AS DATE) AS d FROM generate_series(
      TIMESTAMP '2020-01-01', TIMESTAMP '2099-12-31', INTERVAL 1 DAY) s(g)) days"""

# ---- dimensions ---------------------------------------------------------------------

_USER = "user_id, user_uuid, full_name, email, phone, country, city, user_type, is_verified, " \
        "total_spent, total_bookings, last_login"
_HASH = "sha256(concat(coalesce(user_type, ''), coalesce(country, ''), coalesce(city, ''), " \
        "coalesce(phone, '')))"
_HOST = "host_id, host_uuid, full_name, email, phone, host_since, host_location, " \
        "response_rate, response_time, is_superhost, total_listings, total_reviews_received, " \
        "average_rating"
_PROPERTY = "property_id, property_uuid, host_sk, title, description, property_type, " \
            "room_type, accommodates, bedrooms, bathrooms, city, state, country, latitude, " \
            "longitude, price_per_night, cleaning_fee"

CHANGED = {
    "user": "(s.user_type <> c.user_type OR coalesce(s.country, '') <> coalesce(c.country, '') "
            "OR coalesce(s.city, '') <> coalesce(c.city, '') "
            "OR coalesce(s.phone, '') <> coalesce(c.phone, ''))",
    "host": "(s.is_superhost <> c.is_superhost "
            "OR coalesce(s.response_rate, 0) <> coalesce(c.response_rate, 0) "
            "OR coalesce(s.host_location, '') <> coalesce(c.host_location, ''))",
    "property": "(s.price_per_night <> c.price_per_night OR s.property_type <> c.property_type "
                "OR coalesce(s.city, '') <> coalesce(c.city, '') "
                "OR s.accommodates <> c.accommodates)",
}


def _dimension(name: str, plural: str, columns: str, extra: str) -> None:
    """CTEs of a dimension after batch 1 and after batch 2."""
    key, sk = f"{name}_id", f"{name}_sk"
    tail = (f"TIMESTAMP '{{since}}' AS valid_from, TIMESTAMP '{END}' AS valid_to, "
            "true AS is_current, {version} AS version_number, "
            "TIMESTAMP '{since}' AS created_at, 'loader' AS created_by, "
            "CAST(NULL AS TIMESTAMP) AS updated_at, CAST(NULL AS VARCHAR) AS updated_by")
    CTE[f"dim_{plural}_1"] = (
        f"SELECT row_number() OVER (ORDER BY {key}) AS {sk}, {columns}{extra}, "
        f"{tail.format(since=B1, version=1)} FROM src_{name}_1")
    CTE[f"{name}_due"] = (
        f"SELECT s.*, c.{key} IS NOT NULL AS replaces, "
        f"coalesce(c.version_number, 0) + 1 AS new_version FROM src_{name}_2 s "
        f"LEFT JOIN dim_{plural}_1 c ON s.{key} = c.{key} "
        f"WHERE c.{key} IS NULL OR {CHANGED[name]}")
    CTE[f"dim_{plural}"] = f"""
        SELECT c.* REPLACE (
            CASE WHEN u.{key} IS NULL THEN c.valid_to ELSE TIMESTAMP '{B2}' END AS valid_to,
            u.{key} IS NULL AS is_current,
            CASE WHEN u.{key} IS NOT NULL THEN TIMESTAMP '{B2}' END AS updated_at,
            CASE WHEN u.{key} IS NOT NULL THEN 'loader' END AS updated_by)
        FROM dim_{plural}_1 c
        LEFT JOIN (SELECT {key} FROM {name}_due WHERE replaces) u ON c.{key} = u.{key}
        UNION ALL BY NAME
        SELECT (SELECT count(*) FROM dim_{plural}_1) + row_number() OVER (ORDER BY {key}) AS {sk},
          {columns}{extra}, {tail.format(since=B2, version='new_version')} FROM {name}_due"""


for _batch in (1, 2):
    CTE[f"src_user_{_batch}"] = f"SELECT * FROM stg_user_{_batch}"
    CTE[f"src_host_{_batch}"] = f"SELECT * FROM stg_host_{_batch}"
    _hosts = "dim_hosts_1" if _batch == 1 else "dim_hosts"
    CTE[f"src_property_{_batch}"] = (
        f"SELECT p.*, coalesce(h.host_sk, -1) AS host_sk FROM stg_property_{_batch} p "
        f"LEFT JOIN {_hosts} h ON p.host_id = h.host_id AND h.is_current")
_dimension("user", "users", _USER, f", {_HASH} AS attribute_hash")
_dimension("host", "hosts", _HOST, "")
_dimension("property", "properties", _PROPERTY, "")

# ---- facts --------------------------------------------------------------------------


def _reason(tests: dict[str, str]) -> str:
    arms = ", ".join(f"CASE WHEN {t} THEN '{n}' END" for n, t in tests.items())
    return f"nullif(concat_ws(',', {arms}), '') AS reject_reason"


_BOOKING_REASON = _reason({
    "unknown_user": "u.user_sk IS NULL", "unknown_property": "p.property_sk IS NULL",
    "checkin_date_out_of_calendar": "d1.date_sk IS NULL",
    "checkout_date_out_of_calendar": "d2.date_sk IS NULL",
    "created_date_out_of_calendar": "d3.date_sk IS NULL"})
_DATES = """LEFT JOIN dim_dates d1 ON s.checkin_date = d1.full_date
    LEFT JOIN dim_dates d2 ON s.checkout_date = d2.full_date
    LEFT JOIN dim_dates d3 ON s.created_date = d3.full_date"""


def _resolved_bookings(users: str, properties: str) -> str:
    return f"""
    SELECT s.*, u.user_sk, p.property_sk, d1.date_sk AS checkin_date_sk,
      d2.date_sk AS checkout_date_sk, d3.date_sk AS created_date_sk, {_BOOKING_REASON}
    FROM stg_booking s LEFT JOIN {users} LEFT JOIN {properties} {_DATES}"""


CTE["resolved_bookings"] = _resolved_bookings(
    "dim_users u ON s.user_id = u.user_id AND u.is_current",
    "dim_properties p ON s.property_id = p.property_id AND p.is_current")
CTE["resolved_bookings_as_of"] = _resolved_bookings(
    "dim_users u ON s.user_id = u.user_id AND u.valid_from <= s.created_date "
    "AND s.created_date < u.valid_to",
    "dim_properties p ON s.property_id = p.property_id AND p.valid_from <= s.created_date "
    "AND s.created_date < p.valid_to")
CTE["resolved_bookings_first"] = _resolved_bookings(
    "dim_users u ON s.user_id = u.user_id AND u.is_current",
    "dim_properties_1 p ON s.property_id = p.property_id AND p.is_current")
_FACT_BOOKING = f"""
    SELECT row_number() OVER (ORDER BY booking_id) AS booking_sk, booking_id, booking_uuid,
      user_sk, property_sk, checkin_date_sk, checkout_date_sk, created_date_sk,
      number_of_nights, number_of_guests, subtotal, cleaning_fee, service_fee, total_price,
      booking_status, cancellation_date, CAST(NULL AS VARCHAR) AS cancellation_reason,
      TIMESTAMP '{LOADED}' AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
    FROM %s WHERE reject_reason IS NULL"""
CTE["known_bookings"] = """
    SELECT s.booking_id FROM stg_booking s JOIN stg_user_2_all u ON s.user_id = u.user_id
    JOIN stg_property_2 p ON s.property_id = p.property_id
    JOIN dim_dates d1 ON s.checkin_date = d1.full_date
    JOIN dim_dates d2 ON s.checkout_date = d2.full_date
    JOIN dim_dates d3 ON s.created_date = d3.full_date"""
CTE["fact_bookings"] = _FACT_BOOKING % "resolved_bookings"
CTE["fact_bookings_as_of"] = _FACT_BOOKING % "resolved_bookings_as_of"
CTE["resolved_payments"] = f"""
    SELECT s.*, b.booking_sk, u.user_sk, d.date_sk AS payment_date_sk,
      {_reason({'unknown_booking': 'b.booking_sk IS NULL', 'unknown_user': 'u.user_sk IS NULL',
                'payment_date_out_of_calendar': 'd.date_sk IS NULL'})}
    FROM stg_payment s LEFT JOIN fact_bookings b ON s.booking_id = b.booking_id
    LEFT JOIN dim_users u ON s.user_id = u.user_id AND u.is_current
    LEFT JOIN dim_dates d ON s.payment_date = d.full_date"""
CTE["fact_payments"] = f"""
    SELECT row_number() OVER (ORDER BY payment_id) AS payment_sk, payment_id, transaction_id,
      booking_sk, user_sk, payment_date_sk, amount, payment_method, installments,
      {rounded('amount', '0.03', 'DECIMAL(10,2)')} AS fee_amount,
      {rounded('amount', '0.97')} AS net_amount, payment_status,
      CAST(NULL AS DATE) AS refund_date, CAST(NULL AS DECIMAL(12,2)) AS refund_amount,
      TIMESTAMP '{LOADED}' AS created_at
    FROM resolved_payments WHERE reject_reason IS NULL"""
CTE["dim_reviews"] = f"""
    SELECT row_number() OVER (ORDER BY review_id) AS review_sk, review_id, s.booking_id,
      u.user_sk, p.property_sk, d.date_sk AS review_date_sk,
      {', '.join(f'CAST(NULL AS SMALLINT) AS rating_{n}' for n in
                 ('accuracy', 'cleanliness', 'checkin', 'communication', 'location', 'value'))},
      overall_rating, CAST(NULL AS VARCHAR) AS comment_title,
      CAST(NULL AS VARCHAR) AS comment_text, CAST(NULL AS VARCHAR) AS host_response,
      CAST(NULL AS DATE) AS host_response_date, TIMESTAMP '{LOADED}' AS created_at
    FROM stg_review s JOIN dim_users u ON s.user_id = u.user_id AND u.is_current
    JOIN dim_properties p ON s.property_id = p.property_id AND p.is_current
    JOIN dim_dates d ON s.review_date = d.full_date"""

# ---- generated tables ---------------------------------------------------------------

_USERS_N = "(SELECT count(*) FROM customer)"
_HOSTS_N = "(SELECT count(*) FROM supplier)"
_PROPERTIES_N = "(SELECT count(*) FROM part)"
_tags = "[" + ", ".join(f"'{a}'" for a in G.AMENITIES) + "]"

CTE["gen_users"] = f"""
    SELECT CAST(i AS INTEGER) AS user_id, {short_id('usr', 'i')} AS user_uuid,
      concat('User ', CAST(i AS VARCHAR)) AS full_name,
      concat('user', CAST(i AS VARCHAR), '@example.com') AS email,
      concat('+55', CAST({draw('i', 1, 90000000)} + 10000000 AS VARCHAR)) AS phone,
      concat('COUNTRY_', CAST({draw('i', 2, 200)} AS VARCHAR)) AS country,
      concat('CITY_', CAST({draw('i', 3, 1000)} AS VARCHAR)) AS city,
      {weighted('i', 4, G.USER_TYPE_WEIGHTS)} AS user_type, {chance('i', 6, 50)} AS is_verified,
      CAST(0 AS DECIMAL(18,2)) AS total_spent, 0 AS total_bookings,
      CAST({day('2020-01-01', f"{draw('i', 5, 1826)} + {draw('i', 7, 365)} + 1")} AS TIMESTAMP)
        AS last_login
    FROM (SELECT c_custkey + 1 AS i FROM customer) q"""
CTE["gen_hosts"] = f"""
    SELECT CAST(i AS INTEGER) AS host_id, {short_id('host', 'i')} AS host_uuid, user_id,
      full_name, email, phone, {day('2020-01-01', draw('i', 11, 1826))} AS host_since,
      concat_ws(', ', city, country) AS host_location,
      CAST({draw('i', 12, 31)} + 70 AS SMALLINT) AS response_rate,
      {pick('i', 13, G.HOST_RESPONSE_TIMES)} AS response_time,
      {chance('i', 14, 50)} AS is_superhost, 0 AS total_listings, 0 AS total_reviews_received,
      CAST(NULL AS DECIMAL(3,2)) AS average_rating
    FROM (SELECT *, row_number() OVER (ORDER BY user_id) AS i
          FROM ({ranked_sample('gen_users', 'user_id', _HOSTS_N)}) s) q"""
CTE["gen_properties"] = f"""
    SELECT CAST(i AS INTEGER) AS property_id, {short_id('prop', 'i')} AS property_uuid,
      CAST({draw('i', 21, _HOSTS_N)} + 1 AS INTEGER) AS host_id,
      concat('Stay ', CAST(i AS VARCHAR)) AS title,
      concat('Description of stay ', CAST(i AS VARCHAR)) AS description,
      {pick('i', 22, S.PROPERTY_TYPES)} AS property_type,
      {pick('i', 23, S.ROOM_TYPES)} AS room_type,
      CAST({draw('i', 24, 10)} + 1 AS SMALLINT) AS accommodates,
      CAST({draw('i', 25, 5)} + 1 AS SMALLINT) AS bedrooms,
      CAST({draw('i', 26, 4)} + 1 AS SMALLINT) AS bathrooms,
      concat('CITY_', CAST({draw('i', 27, 1000)} AS VARCHAR)) AS city,
      concat(chr(CAST({draw('i', 28, 26)} + 65 AS INTEGER)),
             chr(CAST({draw('i', 29, 26)} + 65 AS INTEGER))) AS state, 'Brazil' AS country,
      CAST(({draw('i', 30, 180000001)} - 90000000) / 1000000.0 AS DECIMAL(10,8)) AS latitude,
      CAST(({draw('i', 31, 360000001)} - 180000000) / 1000000.0 AS DECIMAL(11,8)) AS longitude,
      CAST({draw('i', 32, 751)} + 50 AS DECIMAL(10,2)) AS price_per_night,
      CAST({draw('i', 33, 81)} + 20 AS DECIMAL(10,2)) AS cleaning_fee,
      array_to_string(list_slice(list_concat({_tags}, {_tags}), {draw('i', 37, 8)} + 1,
        {draw('i', 37, 8)} + {draw('i', 38, 6)} + 3), ',') AS _amenities,
      CAST({draw('i', 35, 7)} + 1 AS INTEGER) AS _min_nights,
      CAST({draw('i', 36, 84)} + 7 AS INTEGER) AS _max_nights
    FROM (SELECT p_partkey + 1 AS i FROM part) q"""
CTE["gen_booking_base"] = f"""
    SELECT i, user_id, b.property_id, checkin_date, booking_status, accommodates, cleaning_fee,
      price_per_night,
      CAST(_min_nights + {draw('i', 45, 'least(_max_nights, 30) - _min_nights + 1')}
        AS INTEGER) AS nights
    FROM (SELECT i, CAST({draw('i', 41, _USERS_N)} + 1 AS INTEGER) AS user_id,
            CAST({draw('i', 42, _PROPERTIES_N)} + 1 AS INTEGER) AS property_id,
            {day('2023-01-01', draw('i', 43, 730))} AS checkin_date,
            {weighted('i', 44, G.BOOKING_STATUS_WEIGHTS)} AS booking_status
          FROM (SELECT o_orderkey + 1 AS i FROM orders) o) b
    JOIN gen_properties p ON b.property_id = p.property_id"""
CTE["gen_bookings"] = f"""
    SELECT CAST(i AS BIGINT) AS booking_id, {short_id('bok', 'i')} AS booking_uuid, user_id,
      property_id, checkin_date, checkin_date + nights AS checkout_date,
      CAST(nights AS SMALLINT) AS number_of_nights,
      CAST({draw('i', 46, 'accommodates')} + 1 AS SMALLINT) AS number_of_guests,
      subtotal, cleaning_fee, service_fee,
      CAST(subtotal + cleaning_fee + service_fee AS DECIMAL(12,2)) AS total_price,
      booking_status,
      CASE WHEN booking_status = 'cancelled'
        THEN checkin_date - CAST({draw('i', 47, 30)} + 1 AS INTEGER) END AS cancellation_date,
      checkin_date - CAST({draw('i', 48, 90)} + 1 AS INTEGER) AS created_date
    FROM (SELECT *, {rounded('subtotal', '0.10')} AS service_fee FROM
           (SELECT *, CAST(price_per_night * nights AS DECIMAL(12,2)) AS subtotal
            FROM gen_booking_base) x) y"""
CTE["gen_eligible"] = """SELECT booking_id, user_id, total_price, checkin_date
    FROM gen_bookings WHERE booking_status IN ('confirmed', 'completed')"""

# ---- statements ---------------------------------------------------------------------

_VERSION = "valid_from:t valid_to:t is_current version_number created_at:t created_by " \
           "updated_at:t updated_by"
_USER_COLS = "user_id user_uuid full_name email phone country city user_type is_verified " \
             "total_spent:d total_bookings last_login:t "
_HOST_COLS = "host_id host_uuid full_name email phone host_since:t host_location " \
             "response_rate response_time is_superhost total_listings " \
             "total_reviews_received average_rating:d "
_STG_HOST_COLS = _HOST_COLS + "user_id"
_PLACE_COLS = "property_id property_uuid title description property_type room_type " \
              "accommodates bedrooms bathrooms city state country latitude:d longitude:d " \
              "price_per_night:d cleaning_fee:d "
_BOOKING_COLS = "booking_id booking_uuid user_id property_id checkin_date:t checkout_date:t " \
                "number_of_nights number_of_guests subtotal:d cleaning_fee:d service_fee:d " \
                "total_price:d booking_status cancellation_date:t created_date:t "
_FACT_COLS = "booking_id booking_uuid user_sk property_sk checkin_date_sk checkout_date_sk " \
             "created_date_sk number_of_nights number_of_guests subtotal:d cleaning_fee:d " \
             "service_fee:d total_price:d booking_status cancellation_date:t " \
             "cancellation_reason created_at:t updated_at:t "
_DIRTY = f"""
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN valid WHEN 1 THEN upper(valid)
        WHEN 2 THEN concat('txn_', CAST(event_id AS VARCHAR)) END AS transaction_id,
      (['None', 'NAN', 'null', ' null', 'Paris', 'nullable', ''])[{draw('event_id', 1, 7)} + 1]
        AS search_query, event_type,
      CASE WHEN event_id % 5 = 0 THEN 'nan'::DOUBLE ELSE value END AS value
    FROM (SELECT *, regexp_replace(md5(concat('evt:', CAST(event_id AS VARCHAR))),
            '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5') AS valid
          FROM events) e"""
CTE["dirty_clicks"] = _DIRTY


def _percent(part: str, whole: str) -> str:
    """Half-up percentage with two decimals, in whole-number arithmetic."""
    return f"CAST(({part} * 20000 + {whole}) // (2 * {whole}) AS DOUBLE) / 100"


def _rate(facts: str) -> str:
    return f"""SELECT property_type, total_bookings, cancelled_bookings,
        {_percent('cancelled_bookings', 'total_bookings')} AS cancellation_rate
      FROM (SELECT p.property_type, count(*) AS total_bookings,
              CAST(sum(CASE WHEN f.booking_status = 'cancelled' THEN 1 ELSE 0 END) AS BIGINT)
                AS cancelled_bookings
            FROM {facts} GROUP BY p.property_type) r"""


_ON_VERSION = "{} f JOIN dim_properties p ON f.property_sk = p.property_sk AND p.is_current"
_ACCEPTED_FIRST = "(SELECT * FROM resolved_bookings_first WHERE reject_reason IS NULL)"


def _daily(partition: str) -> str:
    return f"""SELECT CAST(full_date AS VARCHAR) AS full_date,
        CAST(revenue AS DOUBLE) AS daily_revenue,
        CAST(sum(revenue) OVER ({partition} ORDER BY full_date) AS DOUBLE) AS revenue_ytd
      FROM (SELECT d.full_date, d.year_number, sum(f.total_price) AS revenue
            FROM fact_bookings f JOIN dim_dates d ON f.checkin_date_sk = d.date_sk
            WHERE f.booking_status = 'completed' GROUP BY 1, 2) x"""


_PLACES = """SELECT p.title, p.city, count(DISTINCT f.booking_id) AS total_bookings,
        CAST(sum(f.total_price) AS DOUBLE) AS total_revenue
      FROM fact_bookings f JOIN dim_properties p ON f.property_sk = p.property_sk
      WHERE p.is_current AND f.booking_status = 'completed' GROUP BY p.title, p.city"""


def _rows_affected(batch: int, name: str, plural: str) -> str:
    if batch == 1:
        return (f"SELECT 1 AS batch, 'dim_{plural}' AS table_name, CAST(0 AS BIGINT) AS "
                "rows_updated, count(*) AS rows_inserted, count(*) AS rows_affected "
                f"FROM dim_{plural}_1")
    return (f"SELECT 2, 'dim_{plural}', count(*) FILTER (replaces), count(*), "
            f"count(*) FILTER (replaces) + count(*) FROM {name}_due")


def _cpf_digit(digits: str, weight: int) -> str:
    count = weight - 1
    total = " + ".join(f"CAST(substr({digits}, {p}, 1) AS INTEGER) * {weight + 1 - p}"
                       for p in range(1, count + 1))
    return f"CASE WHEN ({total}) % 11 < 2 THEN '0' ELSE CAST(11 - ({total}) % 11 AS VARCHAR) END"


# The audit, written out from the declared constraints of the tables.


def _line(rule: str, table: str, check: str, count: str) -> str:
    check = check.replace("'", "''")
    return (f"SELECT '{rule}' AS rule, '{table}' AS table_name, '{check}' AS check_name, "
            f"CAST(coalesce(({count}), 0) AS BIGINT) AS violations")


def _bad(rule: str, table: str, check: str, condition: str) -> str:
    return _line(rule, table, check, f"SELECT count(*) FROM {table} WHERE {condition}")


def _twice(rule: str, table: str, keys: str, where: str = "", source: str = "") -> str:
    listed = ", ".join(keys.split(","))
    return _line(rule, table, f"unique {keys}" + (f" where {where}" if where else ""),
                 f"SELECT count(*) FROM (SELECT {listed} FROM {source or table}"
                 + (f" WHERE {where}" if where else "")
                 + f" GROUP BY {listed} HAVING count(*) > 1) k")


def _lost(rule: str, table: str, column: str, parent: str, key: str, source: str = "",
          parent_source: str = "") -> str:
    return _line(rule, table, f"{column} in {parent}.{key}",
                 f"SELECT count(*) FROM {source or table} t WHERE t.{column} IS NOT NULL AND NOT "
                 f"EXISTS (SELECT 1 FROM {parent_source or parent} p WHERE p.{key} = t.{column})")


def _version_lines(table: str, key: str, uuid: str) -> list[str]:
    return [_twice("DQ-03", table, f"{key},valid_from"),
            _twice("DQ-04", table, key, "is_current"), _twice("DQ-03", table, uuid, "is_current"),
            _line("DQ-15", table, f"versions of {key} are contiguous", f"""
              SELECT count(*) FROM {table} a JOIN {table} b ON a.{key} = b.{key}
                AND b.version_number = (SELECT min(x.version_number) FROM {table} x
                  WHERE x.{key} = a.{key} AND x.version_number > a.version_number)
              WHERE b.valid_from <> a.valid_to OR b.version_number <> a.version_number + 1""")]


_AUDIT = " UNION ALL ".join([
    _bad("DQ-01", "dim_users", "user_type in domain",
         "user_type NOT IN ('standard', 'premium', 'vip')"),
    _bad("DQ-02", "dim_users", "valid_from before valid_to", "NOT valid_from < valid_to"),
    *_version_lines("dim_users", "user_id", "user_uuid"),
    _bad("DQ-06", "dim_hosts", "response_rate 0..100", "response_rate < 0 OR response_rate > 100"),
    _bad("DQ-06", "dim_hosts", "response_time in domain",
         "response_time NOT IN ('within_an_hour', 'within_a_few_hours', 'within_a_day', "
         "'within_a_week')"),
    *_version_lines("dim_hosts", "host_id", "host_uuid"),
    _bad("DQ-05", "dim_properties", "price_per_night positive", "NOT price_per_night > 0"),
    *_version_lines("dim_properties", "property_id", "property_uuid"),
    _twice("DQ-10", "dim_dates", "date_sk"), _twice("DQ-10", "dim_dates", "full_date"),
    _bad("DQ-07", "fact_bookings", "at least one night", "NOT number_of_nights >= 1"),
    _bad("DQ-07", "fact_bookings", "total_price not negative", "NOT total_price >= 0"),
    _bad("DQ-07", "fact_bookings", "booking_status in domain",
         "booking_status NOT IN ('pending', 'confirmed', 'cancelled', 'completed', 'no_show')"),
    _twice("DQ-10", "fact_bookings", "booking_id"),
    _lost("DQ-11", "fact_bookings", "user_sk", "dim_users", "user_sk"),
    _lost("DQ-11", "fact_bookings", "property_sk", "dim_properties", "property_sk"),
    _lost("DQ-11", "fact_bookings", "checkin_date_sk", "dim_dates", "date_sk"),
    _lost("DQ-11", "fact_bookings", "checkout_date_sk", "dim_dates", "date_sk"),
    _lost("DQ-11", "fact_bookings", "created_date_sk", "dim_dates", "date_sk"),
    _bad("DQ-08", "fact_payments", "amount not negative", "NOT amount >= 0"),
    _bad("DQ-08", "fact_payments", "payment_status in domain",
         "payment_status NOT IN ('pending', 'paid', 'refunded', 'failed')"),
    _bad("Q-13", "fact_payments", "fee and net add up to amount",
         "amount - fee_amount - net_amount <> 0"),
    _twice("DQ-10", "fact_payments", "payment_id"),
    _twice("DQ-10", "fact_payments", "transaction_id"),
    _lost("DQ-12", "fact_payments", "booking_sk", "fact_bookings", "booking_sk"),
    _lost("DQ-12", "fact_payments", "user_sk", "dim_users", "user_sk"),
    _lost("DQ-12", "fact_payments", "payment_date_sk", "dim_dates", "date_sk"),
    _bad("DQ-09", "dim_reviews", "overall_rating 1..5", "overall_rating < 1 OR overall_rating > 5"),
    _twice("DQ-10", "dim_reviews", "review_id"),
    _lost("DQ-12", "dim_reviews", "user_sk", "dim_users", "user_sk"),
    _lost("DQ-12", "dim_reviews", "property_sk", "dim_properties", "property_sk"),
    _lost("DQ-12", "dim_reviews", "review_date_sk", "dim_dates", "date_sk"),
])

_STAGING = {"tb_user": "stg_user_2_all", "tb_host": "stg_host_2", "tb_property": "stg_property_2",
            "tb_booking": "stg_booking", "tb_payment": "stg_payment", "tb_review": "stg_review"}


def _staged_lost(rule: str, table: str, column: str, parent: str) -> str:
    return _lost(rule, table, column, parent, column, _STAGING[table], _STAGING[parent])


_STAGING_AUDIT = " UNION ALL ".join([
    *[_twice("DQ-13", table, key, source=_STAGING[table]) for table, key in (
        ("tb_user", "user_id"), ("tb_host", "host_id"), ("tb_property", "property_id"),
        ("tb_booking", "booking_id"), ("tb_payment", "payment_id"),
        ("tb_payment", "transaction_id"), ("tb_review", "review_id"))],
    _staged_lost("DQ-11", "tb_property", "host_id", "tb_host"),
    _staged_lost("DQ-11", "tb_booking", "user_id", "tb_user"),
    _staged_lost("DQ-11", "tb_booking", "property_id", "tb_property"),
    _staged_lost("DQ-12", "tb_payment", "booking_id", "tb_booking"),
    _staged_lost("DQ-12", "tb_payment", "user_id", "tb_user"),
    _staged_lost("DQ-12", "tb_review", "user_id", "tb_user"),
    _staged_lost("DQ-12", "tb_review", "property_id", "tb_property"),
])


def _declared(required: dict[str, str], lengths: dict[str, dict[str, int]],
              sources: dict[str, str] | None = None) -> str:
    """DQ-14: required columns (``a b c``) and text lengths of tables."""
    parts, sources = [], sources or {}
    for table in required:
        source = sources.get(table, table)
        parts += [_line("DQ-14", table, f"{c} not null",
                        f"SELECT count(*) - count({c}) FROM {source}")
                  for c in required[table].split()]
        parts += [_line("DQ-14", table, f"{c} at most {size} characters",
                        f"SELECT count(*) FROM {source} WHERE length({c}) > {size}")
                  for c, size in lengths.get(table, {}).items()]
    return " UNION ALL ".join(parts)


_REQUIRED = {
    "dim_users": "user_sk user_id user_uuid full_name email user_type is_verified total_spent "
                 "total_bookings valid_from valid_to is_current version_number created_at "
                 "created_by",
    "dim_hosts": "host_sk host_id host_uuid full_name email host_since is_superhost "
                 "total_listings total_reviews_received valid_from valid_to is_current "
                 "version_number created_at created_by",
    "dim_properties": "property_sk property_id property_uuid title property_type room_type "
                      "accommodates city country price_per_night cleaning_fee valid_from "
                      "valid_to is_current version_number created_at created_by",
    "dim_dates": "date_sk full_date year_number quarter_number semester_number month_number "
                 "month_name month_abbreviation week_number week_of_month day_of_month "
                 "day_of_week day_name day_abbreviation is_weekend is_month_start is_month_end "
                 "is_quarter_start is_quarter_end is_year_start is_year_end",
    "fact_bookings": "booking_sk booking_id booking_uuid user_sk property_sk checkin_date_sk "
                     "checkout_date_sk created_date_sk number_of_nights number_of_guests "
                     "subtotal cleaning_fee service_fee total_price booking_status created_at",
    "fact_payments": "payment_sk payment_id transaction_id booking_sk user_sk payment_date_sk "
                     "amount payment_method installments fee_amount net_amount payment_status "
                     "created_at",
    "dim_reviews": "review_sk review_id booking_id user_sk property_sk review_date_sk "
                   "overall_rating created_at",
}
_STAGING_REQUIRED = {
    "tb_user": "user_id user_uuid full_name email user_type is_verified total_spent "
               "total_bookings loaded_at",
    "tb_host": "host_id host_uuid user_id full_name email host_since is_superhost "
               "total_listings total_reviews_received",
    "tb_property": "property_id property_uuid host_id title property_type room_type "
                   "accommodates city country price_per_night cleaning_fee loaded_at",
    "tb_booking": "booking_id booking_uuid user_id property_id checkin_date checkout_date "
                  "number_of_nights number_of_guests subtotal cleaning_fee service_fee "
                  "total_price booking_status created_date loaded_at",
    "tb_payment": "payment_id transaction_id booking_id user_id amount payment_method "
                  "installments payment_status payment_date loaded_at",
    "tb_review": "review_id booking_id user_id property_id overall_rating review_date loaded_at",
}
_PERSON = {"full_name": 150, "email": 320, "phone": 20}
_BY = {"created_by": 100, "updated_by": 100}
_PLACE_LENGTHS = {"title": 200, "property_type": 50, "room_type": 30, "city": 100, "state": 2,
                  "country": 100}
_PAID = {"transaction_id": 100, "payment_method": 30, "payment_status": 20}
_USER_LENGTHS = {**_PERSON, "country": 100, "city": 100, "user_type": 20}
_HOST_LENGTHS = {**_PERSON, "host_location": 200, "response_time": 30}
_LENGTHS = {
    "dim_users": {**_USER_LENGTHS, "attribute_hash": 64, **_BY},
    "dim_hosts": {**_HOST_LENGTHS, **_BY},
    "dim_properties": {**_PLACE_LENGTHS, **_BY},
    "fact_bookings": {"booking_status": 20, "cancellation_reason": 200},
    "fact_payments": _PAID,
    "dim_reviews": {"comment_title": 200},
}
_STAGING_LENGTHS = {
    "tb_user": _USER_LENGTHS,
    "tb_host": {"host_uuid": 36, **_HOST_LENGTHS},
    "tb_property": _PLACE_LENGTHS,
    "tb_booking": {"booking_status": 20},
    "tb_payment": _PAID,
}
_MANIFEST = {
    "users": ("raw_user_2_all", "user_id:int user_uuid:string full_name:string email:string "
              "phone:string country:string city:string user_type:string is_verified:boolean"),
    "hosts": ("raw_host_2", "host_id:int host_uuid:string user_id:int full_name:string "
              "email:string host_since:date host_location:string response_rate:smallint "
              "is_superhost:boolean"),
    "properties": ("raw_property_2", "property_id:int property_uuid:string host_id:int "
                   "title:string property_type:string room_type:string accommodates:smallint "
                   "city:string country:string price_per_night:decimal(10,2) "
                   "cleaning_fee:decimal(10,2)"),
    "bookings": ("stg_booking", "booking_id:bigint user_id:int property_id:int "
                 "checkin_date:date number_of_nights:smallint subtotal:decimal(12,2) "
                 "cleaning_fee:decimal(12,2) service_fee:decimal(12,2) booking_status:string "
                 "booking_uuid:string checkout_date:date number_of_guests:smallint "
                 "total_price:decimal(12,2) cancellation_date:date created_date:date"),
    "payments": ("stg_payment", "payment_id:int transaction_id:string booking_id:bigint "
                 "user_id:int amount:decimal(12,2) payment_method:string "
                 "installments:smallint payment_status:string payment_date:date"),
}


def _manifest() -> str:
    parts = []
    for name, (source, spec) in _MANIFEST.items():
        names = ",".join(i.split(":")[0] for i in spec.split())
        types = ",".join(i.split(":")[1] for i in spec.split())
        parts.append(f"SELECT '{name}' AS table_name, count(*) AS row_count, "
                     f"'{names}' AS columns, '{types}' AS types FROM {source}")
    return " UNION ALL ".join(parts)


def _preview(name: str, plural: str, title: str, pairs: dict[str, str]) -> str:
    listed = ", ".join(f"CAST(s.{c} AS {k}) AS new_{n}, CAST(c.{c} AS {k}) AS old_{n}"
                       for n, (c, k) in pairs.items())
    reason = ", 'Attributes changed' AS reason" if name == "user" else ""
    return (f"SELECT 'would_update' AS action, s.{name}_id, s.{title}, {listed}{reason} "
            f"FROM stg_{name}_2 s JOIN dim_{plural}_1 c "
            f"ON s.{name}_id = c.{name}_id AND c.is_current WHERE {CHANGED[name]}")


def _insert(name: str, plural: str, columns: str) -> str:
    return (f"SELECT 'would_insert' AS action, {cols(columns)} FROM stg_{name}_2 s "
            f"WHERE NOT EXISTS (SELECT 1 FROM dim_{plural}_1 c WHERE c.{name}_id = s.{name}_id "
            "AND c.is_current)")


_GEN_NAMES = _PLACE_COLS + "host_id"
_HISTORY = """
    SELECT user_sk, user_id, full_name, email, user_type, country, city,
      CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
      is_current, version_number,
      CASE WHEN version_number = 1 THEN 'INSERT' WHEN is_current THEN 'CURRENT' ELSE 'UPDATE'
        END AS change_type,
      lag(user_type) OVER (PARTITION BY user_id ORDER BY valid_from) AS previous_user_type,
      lag(country) OVER (PARTITION BY user_id ORDER BY valid_from) AS previous_country,
      datediff('day', valid_from, valid_to) AS days_valid
    FROM dim_users"""
CTE["user_history"] = _HISTORY
CTE["mail_batch"] = """
    SELECT user_id, user_type, country, phone,
      CASE WHEN user_id % 2 = 0 THEN upper(email) || '  ' ELSE email END AS email,
      CASE WHEN user_id % 3 = 0 THEN lower(city) || ' ' ELSE city END AS city
    FROM stg_user_2"""
CTE["mail_due"] = """
    SELECT s.*, c.email AS known, c.version_number
    FROM mail_batch s LEFT JOIN dim_users_1 c
      ON lower(rtrim(s.email)) = lower(rtrim(c.email)) AND c.is_current
    WHERE c.email IS NULL OR lower(rtrim(s.user_type)) <> lower(rtrim(c.user_type))
      OR lower(rtrim(coalesce(s.country, ''))) <> lower(rtrim(coalesce(c.country, '')))
      OR lower(rtrim(coalesce(s.city, ''))) <> lower(rtrim(coalesce(c.city, '')))
      OR lower(rtrim(coalesce(s.phone, ''))) <> lower(rtrim(coalesce(c.phone, '')))"""

STATEMENTS: dict[str, str] = {
    "io01_snapshot_properties": f"SELECT {cols(_GEN_NAMES)} FROM gen_properties",
    "io02_manifest": _manifest(),
    "io03_staging_append": f"SELECT {cols(_BOOKING_COLS + 'loaded_at:t')} FROM stg_booking",
    "io04_staging_truncate_load":
        f"SELECT {cols(_USER_COLS + 'loaded_at:t')} FROM stg_user_2_all",
    "io10_dry_run_previews": f"""
        SELECT 'merge_dim_users' AS operation, 'would_update' AS action, least(count(*), 5) AS shown
        FROM stg_user_2 s JOIN dim_users_1 c ON s.user_id = c.user_id WHERE {CHANGED['user']}
        UNION ALL SELECT 'merge_dim_users', 'would_insert', least(count(*), 5) FROM stg_user_2 s
        WHERE s.user_id NOT IN (SELECT user_id FROM dim_users_1)
        UNION ALL SELECT 'load_fact_bookings', 'would_insert', least(count(*), 5)
        FROM stg_booking""",
    "io11_created_once": """
        SELECT 'tb_booking' AS table_name, false AS created, false AS created_again,
          count(*) AS row_count FROM stg_booking
        UNION ALL SELECT 'tb_payment', true, false, 0""",
    "io06_pruned_columns": "SELECT " + cols(
        "host_id host_uuid user_id full_name email host_since:t host_location response_rate "
        "is_superhost") + " FROM raw_host_2",
    "io12_staged_hosts_with_defaults": f"SELECT {cols(_STG_HOST_COLS)} FROM stg_host_2",
    "cl01_clean_events": f"""
        SELECT event_id, {guid('transaction_id', 'transaction_id', 'event_id')}
            AS transaction_id,
          CASE WHEN lower(search_query) IN ('none', 'nan', 'null') THEN NULL
            ELSE search_query END AS search_query,
          CASE WHEN lower(event_type) IN ('none', 'nan', 'null') THEN NULL
            ELSE event_type END AS event_type,
          CASE WHEN isnan(value) THEN NULL ELSE value END AS value
        FROM dirty_clicks""",
    "cl03_guid_check":
        f"SELECT event_id, {is_guid('transaction_id')} AS is_guid FROM dirty_clicks",
    "cl05_typed_with_rejects": """
        SELECT event_id, user_id, event_type, CAST(stamp AS VARCHAR) AS event_timestamp,
          nullif(concat_ws(',', CASE WHEN user_id IS NULL THEN 'bad_user_id' END,
            CASE WHEN event_type IS NULL THEN 'missing_event_type' END,
            CASE WHEN stamp IS NULL THEN 'bad_event_timestamp' END), '') AS reject_reason
        FROM (SELECT event_id,
                CASE WHEN event_id % 9 <> 0 THEN CAST(user_id + 1 AS INTEGER) END AS user_id,
                CASE WHEN event_id % 13 <> 0 THEN event_type END AS event_type,
                CASE WHEN event_id % 11 <> 0 THEN date_trunc('second', ts) END AS stamp
              FROM events) e""",
    "cl06_staged_clicks": """
        SELECT event_id, CAST(user_id + 1 AS INTEGER) AS user_id,
          CAST(NULL AS VARCHAR) AS session_id, event_type, CAST(NULL AS INTEGER) AS property_id,
          CAST(NULL AS VARCHAR) AS search_query,
          CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END
            AS device_type, CAST(ts AS VARCHAR) AS event_timestamp
        FROM events""",
    "dd01_calendar": """
        SELECT d.* REPLACE (CAST(full_date AS VARCHAR) AS full_date),
          coalesce(checkins, 0) AS checkins
        FROM dim_dates d LEFT JOIN (SELECT checkin_date, count(*) AS checkins FROM stg_booking
          GROUP BY 1) b ON d.full_date = b.checkin_date""",
    "dd02_calendar_stats": """
        SELECT count(*) AS total_dates, CAST(min(full_date) AS VARCHAR) AS min_date,
          CAST(max(full_date) AS VARCHAR) AS max_date,
          (SELECT count(DISTINCT checkin_date_sk) FROM fact_bookings) AS checkin_days
        FROM dim_dates""",
    "pf01_current_users": """SELECT user_sk, user_id, user_type, country, city, version_number
        FROM dim_users WHERE is_current""",
    "pf02_null_default_inequality": """
        SELECT s.user_id, coalesce(s.phone, '') <> coalesce(c.phone, '')
            AS differs_null_as_empty, s.phone IS DISTINCT FROM c.phone AS differs_null_safe
        FROM stg_user_2 s JOIN dim_users_1 c ON s.user_id = c.user_id""",
    "pf03_plain_inequality": """
        SELECT s.user_id, s.user_type <> c.user_type AS type_differs,
          s.phone <> c.phone AS phone_differs
        FROM stg_user_2 s JOIN dim_users_1 c ON s.user_id = c.user_id""",
    "pf04_change_predicate": f"""
        SELECT s.user_id, coalesce({CHANGED['user']}, false) AS changed
        FROM stg_user_2 s JOIN dim_users_1 c ON s.user_id = c.user_id""",
    "pf05_eligible_bookings": """
        SELECT booking_id, booking_status, CAST(total_price AS DOUBLE) AS total_price
        FROM stg_booking WHERE booking_status IN ('confirmed', 'completed')""",
    "pf11_change_types": """SELECT change_type, count(*) AS versions,
        CAST(sum(days_valid) AS BIGINT) AS days_valid FROM user_history GROUP BY 1""",
    "jn05_host_of_property": """
        SELECT p.property_id, p.host_id, coalesce(h.host_sk, -1) AS host_sk
        FROM stg_property_2 p LEFT JOIN dim_hosts h ON p.host_id = h.host_id AND h.is_current""",
    "jn06_latest_closed_version": """SELECT property_id, max(version_number) AS version_number
        FROM dim_properties WHERE NOT is_current GROUP BY 1""",
    "jn07_users_without_row": """SELECT user_id, full_name FROM stg_user_2 s WHERE NOT EXISTS
        (SELECT 1 FROM dim_users_1 c WHERE c.user_id = s.user_id)""",
    "jn08_users_with_row": """SELECT user_id, full_name FROM stg_user_2 s WHERE EXISTS
        (SELECT 1 FROM dim_users_1 c WHERE c.user_id = s.user_id)""",
    "ag02_distinct_bookings_by_place": _PLACES,
    "ag06_booking_span": """SELECT count(*) AS bookings, min(checkin_date_sk) AS first_checkin,
        max(checkout_date_sk) AS last_checkout FROM fact_bookings""",
    "ag08_bookings_per_user": """SELECT user_id, CAST(count(*) AS INTEGER) AS total_bookings
        FROM stg_booking GROUP BY 1""",
    "ag09_paid_per_user": """SELECT user_id, CAST(sum(amount) AS DOUBLE) AS total_spent
        FROM stg_payment WHERE payment_status = 'paid' GROUP BY 1""",
    "ag10_amount_totals": """
        SELECT n AS payments, CAST(total AS DOUBLE) AS total_amount,
          CAST((CAST(total * 100 AS HUGEINT) * 2 + n) // (2 * n) AS DOUBLE) / 100 AS mean_amount
        FROM (SELECT count(*) AS n, sum(amount) AS total FROM stg_payment) t""",
    "ag11_rows_affected": " UNION ALL ".join(
        _rows_affected(b, n, p) for n, p in (("user", "users"), ("host", "hosts"),
                                             ("property", "properties")) for b in (1, 2)),
    "sl04_exact_sample": ranked_sample(
        "(SELECT o_orderkey + 1 AS booking_id FROM orders)", "booking_id",
        "(SELECT count(*) // 5 FROM orders)"),
    "sf09_date_parts": f"""
        SELECT booking_id,
          CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key,
          quarter(d) AS quarter, {us_week('d')} AS us_week, dayofweek(d) + 1 AS weekday,
          monthname(d) AS month_name, left(dayname(d), 3) AS day_abbreviation,
          CAST(last_day(d) AS VARCHAR) AS month_end, (day(d) - 1) // 7 + 1 AS week_of_month,
          CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS fiscal_year,
          (month(d) + 5) % 12 // 3 + 1 AS fiscal_quarter,
          datediff('day', created_date, d) AS lead_days, CAST(d + 7 AS VARCHAR) AS a_week_later
        FROM (SELECT *, checkin_date AS d FROM stg_booking) b""",
    "sf04_fee_rounding": f"""
        SELECT payment_id, CAST({rounded('amount', '0.03')} AS DOUBLE) AS fee_amount,
          CAST({rounded('amount', '0.97')} AS DOUBLE) AS net_amount FROM stg_payment""",
    "sf03_attribute_hash": f"""
        SELECT user_id, {_HASH} AS attribute_hash,
          sha256(concat(coalesce(user_type, ''), '|', coalesce(country, ''), '|',
            coalesce(city, ''), '|', coalesce(phone, ''))) AS delimited_hash,
          {short_id('usr', 'user_id')} AS short_id, concat_ws(', ', city, country) AS place
        FROM stg_user_2_all""",
    "sf20_tags": """SELECT amenity, count(*) AS properties FROM
        (SELECT unnest(string_split(_amenities, ',')) AS amenity FROM gen_properties) t
        GROUP BY 1""",
    "sc01_merge_users": f"SELECT {cols('user_sk ' + _USER_COLS + 'attribute_hash ' + _VERSION)} "
                        "FROM dim_users",
    "sc02_merge_hosts": f"SELECT {cols('host_sk ' + _HOST_COLS + _VERSION)} FROM dim_hosts",
    "sc03_merge_properties":
        f"SELECT {cols('property_sk host_sk ' + _PLACE_COLS + _VERSION)} FROM dim_properties",
    "sc01_reopened_key": f"""
        SELECT (SELECT max(user_sk) FROM dim_users) + row_number() OVER (ORDER BY user_id)
            AS user_sk, {cols(_USER_COLS)}, {_HASH} AS attribute_hash, '{LOADED}' AS valid_from,
          '{END}' AS valid_to, true AS is_current, known + 1 AS version_number,
          '{LOADED}' AS created_at, 'loader' AS created_by,
          CAST(NULL AS VARCHAR) AS updated_at, CAST(NULL AS VARCHAR) AS updated_by
        FROM (SELECT s.*, k.known FROM stg_user_2 s JOIN
               (SELECT user_id, max(version_number) AS known,
                  bool_or(is_current AND user_type <> 'vip') AS open
                FROM dim_users GROUP BY 1) k ON s.user_id = k.user_id WHERE NOT k.open) r""",
    "pf02_merge_by_mail_of_any_case": """
        SELECT coalesce(known, email) AS email, user_id, user_type, country, city,
          coalesce(version_number, 0) + 1 AS version_number, true AS is_current FROM mail_due
        UNION ALL
        SELECT email, user_id, user_type, country, city, version_number,
          is_current AND email NOT IN (SELECT known FROM mail_due WHERE known IS NOT NULL)
        FROM dim_users_1""",
    "sc04_users_would_update": _preview("user", "users", "full_name", {
        "user_type": ("user_type", "VARCHAR"), "city": ("city", "VARCHAR")}),
    "sc04_hosts_would_update": _preview("host", "hosts", "full_name", {
        "superhost": ("is_superhost", "BOOLEAN"), "rate": ("response_rate", "SMALLINT")}),
    "sc04_properties_would_update": _preview("property", "properties", "title", {
        "price": ("price_per_night", "DOUBLE"), "type": ("property_type", "VARCHAR")}),
    "sc04_users_would_insert": _insert("user", "users", _USER_COLS + "loaded_at:t"),
    "sc04_hosts_would_insert": _insert("host", "hosts", _STG_HOST_COLS),
    "sc04_properties_would_insert": _insert(
        "property", "properties", _PLACE_COLS + "host_id loaded_at:t"),
    "hi01_user_history": "SELECT * FROM user_history",
    "pf06_history_of_one_user": """SELECT * FROM user_history WHERE user_id =
        (SELECT user_id FROM stg_booking GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 1)""",
    "hi02_point_in_time": """
        SELECT s.booking_id, s.user_id, CAST(s.created_date AS VARCHAR) AS created_date,
          u.user_sk, u.user_type, u.version_number
        FROM stg_booking s LEFT JOIN dim_users u ON s.user_id = u.user_id
          AND u.valid_from <= s.created_date AND s.created_date < u.valid_to""",
    "fl01_load_bookings": f"SELECT {cols('booking_sk ' + _FACT_COLS)} FROM fact_bookings",
    "fl02_load_payments": "SELECT " + cols(
        "payment_sk payment_id transaction_id booking_sk user_sk payment_date_sk amount:d "
        "payment_method installments fee_amount:d net_amount:d payment_status refund_date:t "
        "refund_amount:d created_at:t") + " FROM fact_payments",
    "rv01_load_reviews": """SELECT * REPLACE (CAST(created_at AS VARCHAR) AS created_at,
        CAST(host_response_date AS VARCHAR) AS host_response_date) FROM dim_reviews""",
    "fl01_bookings_as_of_creation":
        f"SELECT {cols('booking_sk ' + _FACT_COLS)} FROM fact_bookings_as_of",
    "fl03_booking_rejects": "SELECT " + cols(
        "booking_id user_id property_id checkin_date:t reject_reason")
        + " FROM resolved_bookings WHERE reject_reason IS NOT NULL",
    "fl03_payment_rejects": "SELECT " + cols(
        "payment_id booking_id user_id amount:d reject_reason")
        + " FROM resolved_payments WHERE reject_reason IS NOT NULL",
    "fl04_bookings_would_insert": "SELECT 'would_insert' AS action, " + cols(
        "booking_id booking_uuid user_id property_id checkin_date:t checkout_date:t "
        "total_price:d booking_status") + """ FROM stg_booking s WHERE NOT EXISTS
        (SELECT 1 FROM fact_bookings f WHERE f.booking_id = s.booking_id)""",
    "fl04_payments_would_insert": "SELECT 'would_insert' AS action, " + cols(
        "payment_id transaction_id booking_id user_id amount:d payment_status payment_date:t")
        + """ FROM stg_payment s WHERE NOT EXISTS
        (SELECT 1 FROM fact_payments f WHERE f.transaction_id = s.transaction_id)""",
    "st01_streamed_bookings": f"SELECT {cols(_FACT_COLS)} FROM fact_bookings",
    "st02_two_micro_batches": f"""SELECT {cols(_FACT_COLS)} FROM (SELECT * REPLACE (
        number_of_guests + CASE WHEN booking_status = 'completed' THEN 0 ELSE 1 END
          AS number_of_guests) FROM fact_bookings) f""",
    "fl01_reload_with_duplicates": f"""
        SELECT row_number() OVER (ORDER BY booking_status = 'completed' DESC, booking_id)
          AS booking_sk, {cols(_FACT_COLS)} FROM fact_bookings""",
    "fl02_reload": "SELECT row_number() OVER (ORDER BY payment_status = 'paid' DESC, payment_id) "
                   "AS payment_sk, " + cols(
        "payment_id transaction_id booking_sk user_sk payment_date_sk amount:d "
        "payment_method installments fee_amount:d net_amount:d payment_status refund_date:t "
        "refund_amount:d created_at:t") + " FROM fact_payments",
    "fl05_reload_tally": """
        SELECT 1 AS load, good AS rows_loaded, bad AS rows_rejected,
          3 * (good + bad) - good - bad AS rows_skipped, good AS rows_affected,
          bad AS rejects_kept
        FROM (SELECT count(*) FILTER (reject_reason IS NULL) AS good,
                count(*) FILTER (reject_reason IS NOT NULL) AS bad
              FROM resolved_bookings WHERE booking_status = 'completed') a
        UNION ALL
        SELECT 2, fresh, bad, 3 * n - fresh - bad, fresh, bad
        FROM (SELECT count(*) AS n, count(*) FILTER (reject_reason IS NOT NULL) AS bad,
                count(*) FILTER (reject_reason IS NULL AND booking_status <> 'completed')
                  AS fresh
              FROM resolved_bookings) b""",
    "um01_user_metrics": """
        SELECT u.user_sk, u.user_id, CAST(coalesce(b.n, 0) AS INTEGER) AS total_bookings,
          CAST(coalesce(p.spent, 0) AS DOUBLE) AS total_spent, u.version_number
        FROM dim_users u
        LEFT JOIN (SELECT v.user_id, count(*) AS n FROM fact_bookings f
          JOIN dim_users v ON f.user_sk = v.user_sk GROUP BY 1) b ON u.user_id = b.user_id
        LEFT JOIN (SELECT v.user_id, sum(f.amount) AS spent FROM fact_payments f
          JOIN dim_users v ON f.user_sk = v.user_sk WHERE f.payment_status = 'paid'
          GROUP BY 1) p ON u.user_id = p.user_id
        WHERE u.is_current""",
    "um01_staged_user_metrics": """
        SELECT s.user_id, CAST(coalesce(b.n, 0) AS INTEGER) AS total_bookings,
          CAST(coalesce(p.spent, 0) AS DOUBLE) AS total_spent
        FROM stg_user_2_all s
        LEFT JOIN (SELECT user_id, count(*) AS n FROM stg_booking GROUP BY 1) b
          ON s.user_id = b.user_id
        LEFT JOIN (SELECT user_id, sum(amount) AS spent FROM stg_payment
          WHERE payment_status = 'paid' GROUP BY 1) p ON s.user_id = p.user_id""",
    "hm01_host_metrics": """
        SELECT h.host_id, CAST(coalesce(n, 0) AS INTEGER) AS total_listings FROM stg_host_2 h
        LEFT JOIN (SELECT host_id, count(*) AS n FROM stg_property_2 GROUP BY 1) p
          ON h.host_id = p.host_id""",
    "dq_warehouse_audit": _AUDIT,
    "dq10_audit_by_batches": _AUDIT,
    "dq14_declared_audit": _declared(_REQUIRED, _LENGTHS),
    "dq14_staging_audit": _declared(_STAGING_REQUIRED, _STAGING_LENGTHS, _STAGING),
    "dq13_staging_audit": _STAGING_AUDIT,
    "dq19_over_capacity": """
        SELECT s.property_id, count(*) AS bookings, max(s.number_of_guests) AS most_guests,
          max(p.accommodates) AS accommodates
        FROM stg_booking s JOIN stg_property_2 p ON s.property_id = p.property_id
        WHERE s.number_of_guests > p.accommodates GROUP BY 1""",
    "lg01_batch_log_of_full_load": f"""
        SELECT batch_id, table_name, operation_type, rows_affected, '{LOADED}' AS start_time,
          CAST(0 AS BIGINT) AS duration_seconds, 'loader' AS created_by
        FROM (SELECT 3 AS batch_id, 'dim_users' AS table_name, 'MERGE_SCD2' AS operation_type,
                count(*) AS rows_affected FROM stg_user_2_all
          UNION ALL SELECT 4, 'dim_hosts', 'MERGE_SCD2', count(*) FROM stg_host_2
          UNION ALL SELECT 5, 'dim_properties', 'MERGE_SCD2', count(*) FROM stg_property_2
          UNION ALL SELECT 6, 'fact_bookings', 'LOAD', count(*) FROM known_bookings
          UNION ALL SELECT 7, 'fact_payments', 'LOAD', count(*) FROM stg_payment s
            JOIN known_bookings b ON s.booking_id = b.booking_id
            JOIN dim_dates d ON s.payment_date = d.full_date
          UNION ALL SELECT 8, 'dim_reviews', 'LOAD', count(*) FROM stg_review s
            JOIN stg_user_2_all u ON s.user_id = u.user_id
            JOIN stg_property_2 p ON s.property_id = p.property_id
            JOIN dim_dates d ON s.review_date = d.full_date
          UNION ALL SELECT 9, 'dim_users', 'UPDATE_METRICS', count(*) FROM stg_user_2_all) x""",
    "lg02_failures": f"""
        SELECT error_procedure, 0 AS error_number, error_message,
          '{LOADED}' AS error_timestamp, CAST(0 AS BIGINT) AS staged_rows
        FROM (VALUES
          ('stage_tb_user', 'ValueError: tb_user: user_id is not unique in the batch'),
          ('merge_dim_users',
           'ValueError: dim_users: batch time {LOADED} is not after the last merge'))
          e(error_procedure, error_message) WHERE EXISTS (SELECT 1 FROM customer)""",
    "pl02_steps_alone": """
        SELECT batch_id, table_name, operation_type, rows_affected,
          false AS calendar_written_again
        FROM (SELECT 3 AS batch_id, 'dim_users' AS table_name, 'MERGE_SCD2' AS operation_type,
                count(*) AS rows_affected FROM stg_user_2_all
          UNION ALL SELECT 4, 'dim_hosts', 'MERGE_SCD2', count(*) FROM stg_host_2
          UNION ALL SELECT 5, 'dim_properties', 'MERGE_SCD2', 0
          UNION ALL SELECT 6, 'dim_users', 'UPDATE_METRICS', count(*) FROM stg_user_2_all) x""",
    "lg03_etl_summary": """
        SELECT event_id AS batch_id, event_type AS table_name,
          CASE WHEN event_id % 2 = 0 THEN 'MERGE_SCD2' ELSE 'LOAD' END AS operation_type,
          user_id AS rows_affected, CAST(date_trunc('second', ts) AS VARCHAR) AS start_time,
          CAST(date_trunc('second', ts) + to_seconds(event_id % 600) AS VARCHAR) AS end_time,
          event_id % 600 AS duration_seconds, 'loader' AS created_by
        FROM events WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-20' - INTERVAL 7 DAY""",
    "lg04_error_summary": """
        SELECT CAST(event_id AS VARCHAR) AS error_id, user_id AS batch_id, 0 AS error_number,
          'load' AS error_procedure, props AS error_message,
          CAST(date_trunc('second', ts) AS VARCHAR) AS error_timestamp, 'loader' AS created_by
        FROM events WHERE event_type = 'error'
          AND date_trunc('second', ts) >= TIMESTAMP '2024-01-20' - INTERVAL 7 DAY""",
    "rp01_daily_revenue": _daily(""),
    "rp01_daily_revenue_per_year": _daily("PARTITION BY year_number"),
    "rp02_top10_properties": f"{_PLACES} ORDER BY total_revenue DESC, title, city LIMIT 10",
    "rp03_cancellation_rate": _rate(_ON_VERSION.format("fact_bookings")),
    "rp03_superseded_versions_dropped": _rate(_ON_VERSION.format(_ACCEPTED_FIRST)),
    "rp03_superseded_versions_repointed": _rate(
        f"{_ACCEPTED_FIRST} f JOIN dim_properties v ON f.property_sk = v.property_sk "
        "JOIN dim_properties p ON v.property_id = p.property_id AND p.is_current"),
    "rp04_current_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        + (" WHERE is_current" if t in ("dim_users", "dim_hosts", "dim_properties") else "")
        for t in ("dim_users", "dim_hosts", "dim_properties", "fact_bookings", "fact_payments",
                  "dim_reviews")),
    "gn01_users": f"SELECT {cols(_USER_COLS)} FROM gen_users",
    "gn02_hosts": f"SELECT {cols(_STG_HOST_COLS)} FROM gen_hosts",
    "gn03_properties": "SELECT " + cols(_GEN_NAMES + " _amenities _min_nights _max_nights")
        + " FROM gen_properties",
    "gn04_bookings": f"SELECT {cols(_BOOKING_COLS)} FROM gen_bookings",
    "gn05_payments": f"""
        SELECT CAST(i AS INTEGER) AS payment_id, {short_id('txn', 'i')} AS transaction_id,
          booking_id, user_id, CAST(total_price AS DOUBLE) AS amount,
          {pick('i', 51, S.PAYMENT_METHODS)} AS payment_method,
          CAST(CASE WHEN {chance('i', 52, 40)} THEN {draw('i', 53, 12)} + 1 ELSE 1 END
            AS SMALLINT) AS installments,
          {weighted('i', 54, G.PAYMENT_STATUS_WEIGHTS)} AS payment_status,
          CAST(checkin_date - CAST({draw('i', 55, 31)} AS INTEGER) AS VARCHAR) AS payment_date
        FROM (SELECT *, row_number() OVER (ORDER BY booking_id) AS i FROM
          ({ranked_sample('gen_eligible', 'booking_id',
                          '(SELECT count(*) * 3 // 5 FROM orders)')}) s) q""",
    "gn06_reviews": f"""
        SELECT i AS review_id, booking_id, user_id, property_id,
          CAST(rating AS SMALLINT) AS overall_rating,
          CASE WHEN rating >= 3 OR {chance('i', 62, 70)}
            THEN concat('Comment ', CAST(i AS VARCHAR)) END AS comment_text,
          CAST(checkout_date + CAST({draw('i', 63, 14)} + 1 AS INTEGER) AS VARCHAR)
            AS review_date,
          CASE WHEN {chance('i', 64, 40)} THEN concat('Response ', CAST(i AS VARCHAR)) END
            AS host_response
        FROM (SELECT *, {weighted('i', 61, G.RATING_WEIGHTS)} AS rating FROM
          (SELECT *, row_number() OVER (ORDER BY booking_id) AS i FROM gen_bookings
           WHERE booking_status = 'completed') s) q""",
    "gn07_clickstream": f"""
        SELECT i AS event_id, CAST({draw('i', 71, _USERS_N)} + 1 AS INTEGER) AS user_id,
          {short_id('sess', f"({draw('i', 72, 10000)} + 1)")} AS session_id,
          {pick('i', 73, G.EVENT_TYPES)} AS event_type,
          CASE WHEN {chance('i', 74, 50)}
            THEN CAST({draw('i', 75, _PROPERTIES_N)} + 1 AS INTEGER) END AS property_id,
          CASE WHEN {chance('i', 76, 30)}
            THEN concat('CITY_', CAST({draw('i', 77, 1000)} AS VARCHAR)) END AS search_query,
          {pick('i', 78, G.DEVICES)} AS device_type,
          CAST(CAST({day('2024-01-01', draw('i', 79, 365))} AS TIMESTAMP) AS VARCHAR)
            AS event_timestamp
        FROM (SELECT event_id + 1 AS i FROM events) e""",
    "gn08_sensitive": f"""
        SELECT user_id, credit_card_last4, credit_card_brand,
          concat(substr(eleven, 1, 3), '.', substr(eleven, 4, 3), '.', substr(eleven, 7, 3), '-',
            substr(eleven, 10, 2)) AS cpf
        FROM (SELECT *, concat(ten, {_cpf_digit('ten', 11)}) AS eleven FROM
          (SELECT *, concat(nine, {_cpf_digit('nine', 10)}) AS ten FROM
            (SELECT CAST(i AS INTEGER) AS user_id,
               CAST({draw('i', 81, 9000)} + 1000 AS VARCHAR) AS credit_card_last4,
               {pick('i', 82, G.CARD_BRANDS)} AS credit_card_brand,
               lpad(CAST({draw('i', 83, 1000000000)} AS VARCHAR), 9, '0') AS nine
             FROM (SELECT c_custkey + 1 AS i FROM customer) c) a) b) c""",
    "gn_status_shares": """SELECT booking_status, count(*) AS bookings FROM gen_bookings
        GROUP BY 1""",
}


def _needed(text: str, found: dict[str, None]) -> None:
    for name in CTE:
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(CTE[name], found)
            found[name] = None


def statements() -> dict[str, str]:
    """Every statement with the named subqueries it needs, in order of dependence."""
    out = {}
    for name, body in STATEMENTS.items():
        found: dict[str, None] = {}
        _needed(body, found)
        head = ",\n".join(f"{n} AS ({CTE[n]})" for n in found)
        out[name] = f"WITH {head}\n{body}" if head else body
    return out
