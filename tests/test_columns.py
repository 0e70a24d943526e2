from datetime import date, datetime

from pyspark.sql import functions as F

from staywarehouse.functions import dates, text
from staywarehouse.operators import generate
from staywarehouse.operators.calendar import calendar, calendar_stats
from staywarehouse.operators.history import user_history
from staywarehouse.schemas import enforce, schema, tables
from staywarehouse.sources import staging


def test_calendar(spark):
    days = calendar(spark).cache()
    stats = calendar_stats(days).first()
    assert (stats.total_dates, stats.min_date, stats.max_date) == (
        29220, date(2020, 1, 1), date(2099, 12, 31))
    assert len(days.columns) == 23
    row = {d: days.where(F.col("full_date") == d).first()
           for d in ("2024-02-29", "2024-06-30", "2024-07-01", "2024-12-31")}
    leap = row["2024-02-29"]
    assert (leap.date_sk, leap.is_month_end, leap.day_name) == (20240229, True, "Thursday")
    assert (row["2024-06-30"].fiscal_year, row["2024-06-30"].fiscal_quarter) == (2024, 4)
    assert (row["2024-07-01"].fiscal_year, row["2024-07-01"].fiscal_quarter) == (2025, 1)
    assert row["2024-06-30"].is_weekend and row["2024-06-30"].is_quarter_end
    assert row["2024-12-31"].is_year_end and row["2024-12-31"].semester_number == 2
    assert days.where("month_number = 1 and day_of_month = 1 and week_number <> 1").isEmpty()
    assert days.agg({"week_number": "max"}).first()[0] == 54
    days.unpersist()


def test_null_tokens_and_guids(spark):
    rows = [("None", "12345678-1234-1234-1234-1234567890ab"), ("NAN", "usr_1a2b3c4d"),
            ("null", None), (" null", "g2345678-1234-1234-1234-1234567890ab"),
            (None, "12345678-1234-1234-1234-1234567890ab"),
            ("ok", "123456781234-1234-1234-1234567890-ab")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "k int, name string, user_uuid string")
    got = staging.clean(df, "k").orderBy("k").collect()
    assert [r.name for r in got] == [None, None, None, " null", None, "ok"]
    kept = [r.user_uuid == rows[i][1] for i, r in enumerate(got)]
    assert kept == [True, False, False, False, True, True]
    assert all(len(r.user_uuid) == 36 and r.user_uuid.count("-") == 4 for r in got)
    assert [r.user_uuid for r in staging.clean(df, "k").orderBy("k").collect()] == [
        r.user_uuid for r in got]


def test_equal_raw_ids_get_different_guids(spark):
    df = spark.createDataFrame([(1, "txn_ab"), (2, "txn_ab")], "k int, transaction_id string")
    assert staging.clean(df, "k").select("transaction_id").distinct().count() == 2


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5), (3, None)], "k int, v double")
    assert [r.v for r in staging.clean(df, "k").orderBy("k").collect()] == [None, 1.5, None]


def test_hash_delimiter(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "a string, b string")
    assert df.selectExpr(text.attribute_hash(["a", "b"])).distinct().count() == 1
    assert df.selectExpr(text.attribute_hash(["a", "b"], "|")).distinct().count() == 2


def test_seconds_between_counts_boundaries(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:00.9' a, "
                   "timestamp_ntz'2024-01-01 00:00:01.1' b")
    assert df.select(dates.seconds_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_enforce_fills_casts_and_drops(spark):
    df = spark.sql("select '7' host_id, 'u' host_uuid, 1 user_id, 'n' full_name, 'e' email, "
                   "date'2024-01-01' host_since, cast(null as boolean) is_superhost, 1 junk")
    row = enforce(df, "tb_host")
    assert row.schema.fieldNames() == schema("tb_host").fieldNames()
    got = row.first()
    assert (got.host_id, got.is_superhost, got.total_listings, got.phone) == (7, False, 0, None)
    bad = spark.sql("select 'x' host_id, 'u' host_uuid, 1 user_id, 'n' full_name, 'e' email, "
                    "date'2024-01-01' host_since")
    assert enforce(bad, "tb_host", safe=True).first().host_id is None


def test_schemas_parse():
    assert all(len(schema(t)) > 5 for t in tables())


def test_history_of_one_user(spark):
    rows = [(1, 1, "standard", datetime(2024, 1, 1), datetime(2024, 2, 1), False, 1),
            (2, 1, "vip", datetime(2024, 2, 1), datetime(2024, 2, 11), False, 2),
            (3, 1, "premium", datetime(2024, 2, 11), datetime(9999, 12, 31), True, 3),
            (4, 2, "vip", datetime(2024, 1, 1), datetime(9999, 12, 31), True, 1)]
    df = spark.createDataFrame(rows, "user_sk long, user_id int, user_type string, "
                                     "valid_from timestamp_ntz, valid_to timestamp_ntz, "
                                     "is_current boolean, version_number int")
    df = df.withColumns({c: F.lit("x") for c in ("full_name", "email", "country", "city")})
    got = [(r.version_number, r.change_type, r.previous_user_type, r.days_valid)
           for r in user_history(df, 1).collect()]
    assert [g[:3] for g in got] == [(3, "CURRENT", "vip"), (2, "UPDATE", "standard"),
                                    (1, "INSERT", None)]
    assert got[1][3] == 10


def test_sample_is_exact_and_matches_a_plain_sort(spark):
    rows = spark.range(4000).withColumnRenamed("id", "k").repartition(5)
    m = generate.MODULUS

    def lot(i):
        first = (i % m * 48271 + 9 * 69621) % m
        return ((first * first % m) * 16807 + first * 40692 + 9) % m
    for n in (0, 1, 777, 4000, 9000):
        want = set(sorted(range(4000), key=lambda i: (lot(i), i))[:n])
        assert {r.k for r in generate.sample(rows, n, "k", 9).collect()} == want


def test_generated_domains(spark):
    made = generate.everything(spark, {"users": 400, "hosts": 80, "properties": 200,
                                       "bookings": 2000, "payments": 900, "reviews": 100,
                                       "clickstream": 500})
    counts = {n: df.count() for n, df in made.items()}
    assert counts == {"users": 400, "hosts": 80, "properties": 200, "bookings": 2000,
                      "payments": 900, "reviews": 100, "clickstream": 500}
    b = made["bookings"]
    assert b.where("number_of_nights not between 1 and 30 or number_of_guests not between 1 and "
                   "10 or total_price <> subtotal + cleaning_fee + service_fee or "
                   "checkin_date not between date'2023-01-01' and date'2024-12-30' or "
                   "created_date >= checkin_date").isEmpty()
    shares = {r[0]: r[1] / 2000 for r in b.groupBy("booking_status").count().collect()}
    for status, weight in generate.BOOKING_STATUS_WEIGHTS.items():
        assert abs(shares[status] - weight / 100) < 0.05
    crowd = b.join(made["properties"].select("property_id", "accommodates"), "property_id")
    assert crowd.where("number_of_guests > accommodates").isEmpty()
    assert crowd.count() == 2000
    assert made["hosts"].agg({"total_listings": "sum"}).first()[0] == 200
    assert made["users"].agg({"total_bookings": "sum"}).first()[0] == 2000
    assert made["payments"].select("payment_id").distinct().count() == 900
    tags = made["properties"].selectExpr("split(_amenities, ',') t")
    assert tags.where("size(t) not between 3 and 8 or size(array_distinct(t)) <> size(t)"
                      ).isEmpty()


def test_taxpayer_numbers_are_formally_valid(spark):
    for (cpf,) in generate.sensitive(generate.ids(spark, 50)).select("cpf").collect():
        digits = [int(c) for c in cpf if c.isdigit()]
        assert len(cpf) == 14 and len(digits) == 11
        for size in (9, 10):
            rest = sum(d * (size + 1 - i) for i, d in enumerate(digits[:size])) * 10 % 11 % 10
            assert digits[size] == rest


def test_older_statuses(spark):
    df = spark.createDataFrame([("cancelled_by_user",), ("no_show",)], "s string")
    got = [r[0] for r in df.select(generate.normal_status(F.col("s"))).collect()]
    assert got == ["cancelled", "no_show"]
