from datetime import date, datetime

from pyspark.sql import functions as F

from staywarehouse.operators import facts, scd2
from staywarehouse.operators.calendar import calendar
from staywarehouse.schemas import enforce

NOW = datetime(2024, 3, 1)


def dims(spark):
    users = spark.sql("select cast(1 as bigint) user_sk, 1 user_id, true is_current, "
                      "timestamp_ntz'2024-01-01 00:00:00' valid_from, "
                      "timestamp_ntz'9999-12-31 23:59:59' valid_to")
    places = spark.sql("select cast(9 as bigint) property_sk, 5 property_id, true is_current, "
                       "timestamp_ntz'2024-01-01 00:00:00' valid_from, "
                       "timestamp_ntz'9999-12-31 23:59:59' valid_to")
    return users, places, calendar(spark)


def bookings(spark, rows):
    df = spark.createDataFrame(rows, "booking_id bigint, user_id int, property_id int, "
                                     "checkin_date date")
    return enforce(df.withColumns({
        "booking_uuid": F.lit("b"), "checkout_date": F.date_add("checkin_date", 2),
        "number_of_nights": F.lit(2), "number_of_guests": F.lit(1), "subtotal": F.lit(1),
        "cleaning_fee": F.lit(1), "total_price": F.lit(2), "booking_status": F.lit("completed"),
        "created_date": F.date_sub("checkin_date", 1)}), "tb_booking",
        {"loaded_at": F.lit(NOW).cast("timestamp_ntz")})


def test_rejects_carry_their_reasons_and_nothing_is_lost(spark):
    users, places, dates = dims(spark)
    staged = bookings(spark, [
        (1, 1, 5, date(2024, 5, 1)), (2, 1, 0, date(2024, 5, 1)), (3, 2, 5, date(2024, 5, 1)),
        (4, 2, 0, date(2019, 12, 31)), (5, 1, 5, date(2099, 12, 31)),
        (6, 1, 5, date(2020, 1, 1))])
    done = facts.load(facts.resolve_bookings(staged, None, users, places, dates),
                      facts.BOOKINGS, staged.columns, NOW)
    assert [r.booking_id for r in done.accepted.collect()] == [1]
    reasons = {r.booking_id: r.reject_reason for r in done.rejects.collect()}
    assert reasons == {
        2: "unknown_property", 3: "unknown_user",
        4: "unknown_user,unknown_property,checkin_date_out_of_calendar,"
           "created_date_out_of_calendar",
        5: "checkout_date_out_of_calendar", 6: "created_date_out_of_calendar"}
    assert done.rows_loaded + done.rows_rejected == staged.count()
    assert done.rejects.columns == staged.columns + ["reject_reason"]
    again = facts.load(facts.resolve_bookings(staged, done.accepted, users, places, dates),
                       facts.BOOKINGS, staged.columns, NOW, done.last_key)
    assert (again.rows_loaded, again.rows_rejected) == (0, 5)
    assert facts.preview(staged, done.accepted, facts.BOOKINGS).count() == 5


def test_fee_and_net_are_rounded_one_by_one(spark):
    users, _, dates = dims(spark)
    amounts = ["0.50", "1.50", "16.50", "0.17"]
    staged = enforce(spark.createDataFrame(
        [(i, f"t{i}", i, 1, a, date(2024, 5, 1)) for i, a in enumerate(amounts)],
        "payment_id int, transaction_id string, booking_id bigint, user_id int, amount string, "
        "payment_date date").withColumns({"payment_method": F.lit("pix"),
                                          "payment_status": F.lit("paid")}),
        "tb_payment", {"loaded_at": F.lit(NOW).cast("timestamp_ntz")})
    loaded = spark.range(4).select(F.col("id").alias("booking_id"), F.col("id").alias("booking_sk"))
    done = facts.load(facts.resolve_payments(staged, None, loaded, users, dates),
                      facts.PAYMENTS, staged.columns, NOW)
    got = [(str(r.fee_amount), str(r.net_amount), r.installments)
           for r in done.accepted.orderBy("payment_id").collect()]
    assert got == [("0.02", "0.49", 1), ("0.05", "1.46", 1), ("0.50", "16.01", 1),
                   ("0.01", "0.16", 1)]


def test_payment_id_can_be_part_of_the_dedupe(spark):
    users, _, dates = dims(spark)
    staged = spark.sql("select 1 payment_id, 'new' transaction_id, cast(1 as bigint) booking_id, "
                       "1 user_id, cast(1 as decimal(12,2)) amount, date'2024-05-01' payment_date")
    loaded = spark.sql("select 1 payment_id, 'old' transaction_id")
    booked = spark.sql("select cast(1 as bigint) booking_id, cast(1 as bigint) booking_sk")
    assert facts.resolve_payments(staged, loaded, booked, users, dates).count() == 1
    assert facts.resolve_payments(staged, loaded, booked, users, dates,
                                  also_payment_id=True).isEmpty()


def test_unknown_host_is_minus_one(spark):
    hosts = spark.sql("select 1 host_id, cast(4 as bigint) host_sk, true is_current")
    rows = spark.sql("select * from values (1, 1), (2, 8) t(property_id, host_id)")
    got = {r.property_id: r.host_sk for r in scd2.with_current_host(rows, hosts).collect()}
    assert got == {1: 4, 2: -1}


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_a_batch_without_copies_is_not_moved_to_find_the_first_of_each(spark):
    rows = spark.range(100).selectExpr("if(id % 10 = 0, null, id) AS k", "id AS v")
    got = facts.first_of_key(rows, "k")
    assert not [word for word in ("Join", "Window", "Exchange") if word in _plan(got)]
    assert got.count() == 100


def test_first_of_few_and_of_many_repeated_keys(spark, monkeypatch):
    rows = spark.sql("select * from values (1, 'b'), (1, 'a'), (1, 'a'), (2, 'c'), (null, 'd'), "
                     "(null, 'd') t(k, v)")
    want = [(1, "a"), (2, "c"), (None, "d"), (None, "d")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = facts.first_of_key(rows, "k")
        assert "SortMergeJoin" not in _plan(few) and "BroadcastHashJoin" in _plan(few)
        monkeypatch.setattr(facts, "FEW_KEYS", 0)
        many = facts.first_of_key(rows, "k")
        assert "Join" not in _plan(many)
        for got in (few, many):
            assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_loaded_keys_are_reduced_to_a_batch_only_where_that_spares_a_shuffle(spark):
    loaded = spark.range(50).selectExpr("id AS payment_id", "concat('t', id) AS transaction_id")
    staged = spark.range(40, 60).selectExpr("id AS payment_id", "concat('t', id) AS transaction_id")

    def new():
        return facts.not_loaded(staged, loaded, ("transaction_id",), "payment_id")

    assert "LeftSemi" in _plan(new())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "LeftSemi" not in _plan(new())
        assert sorted(r.payment_id for r in new().collect()) == list(range(50, 60))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_text_keys_are_counted_by_their_hash(spark):
    rows = spark.sql("select * from values ('x', 2), ('x', 1), ('y', 3), (null, 4), (null, 4) "
                     "t(k, v)")
    got = facts.first_of_key(rows, "k")
    assert "xxhash64" in _plan(got)
    assert sorted(map(tuple, got.collect()), key=str) == [
        ("x", 1), ("y", 3), (None, 4), (None, 4)]


def test_a_batch_without_copies_is_moved_once_for_each_lookup(spark):
    users = spark.range(3).selectExpr("id AS user_sk", "cast(id as int) AS user_id",
                                      "id < 3 AS is_current")
    places = spark.range(9).selectExpr("id + 4 AS property_sk", "cast(id as int) AS property_id",
                                       "id < 6 AS is_current")
    dates = calendar(spark)
    staged = bookings(spark, [(1, 1, 5, date(2024, 5, 1)), (2, 1, 8, date(2024, 5, 1)),
                              (None, 1, 5, date(2024, 5, 1))])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = facts.resolve_bookings(staged, None, users, places, dates)
        plan = _plan(found)
        # the rows and the dimension, for users and for properties
        assert plan.count("Exchange hashpartitioning") == 4 and "Window" not in plan
        assert [(r.booking_id, r.user_sk, r.property_sk) for r in found.orderBy("booking_id")
                .collect()] == [(None, 1, 9), (1, 1, 9), (2, 1, None)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
