from dataclasses import replace
from datetime import datetime, timedelta
import random

import pytest
from pyspark.sql import functions as F

from staywarehouse.operators import quality, scd2
from staywarehouse.schemas import empty, enforce, schema

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
USER = "user_id int, user_type string, country string, city string, phone string, " \
       "is_verified boolean"


def users(spark, rows):
    df = spark.createDataFrame(rows, USER)
    return enforce(df.withColumns({
        "user_uuid": F.concat(F.lit("u"), F.col("user_id").cast("string")),
        "full_name": F.lit("n"), "email": F.lit("e")}), "tb_user",
        {"loaded_at": F.lit(T1).cast("timestamp_ntz")})


def merge(spark, current, rows, at, closed=None, start=None):
    return scd2.merge(current, users(spark, rows), scd2.USERS, at, "t", closed, start)


def versions(df):
    return {(r.user_id, r.version_number): r for r in df.collect()}


def test_golden_cases(spark):
    first = merge(spark, empty(spark, schema("dim_users")), [
        (1, "standard", "BR", "A", None, True),      # phone NULL -> ''
        (2, "standard", "BR", "A", "1", True),       # untracked flips
        (3, "standard", "BR", "A", "1", True),       # tracked changes
        (4, "standard", "BR", "A", "1", True),       # absent later
    ], T1)
    assert (first.rows_updated, first.rows_inserted, first.rows_affected) == (0, 4, 4)
    second = merge(spark, first.snapshot, [
        (1, "standard", "BR", "A", "", True), (2, "standard", "BR", "A", "1", False),
        (3, "vip", "BR", "A", "1", True), (5, "premium", None, None, None, False)], T2)
    assert (second.rows_updated, second.rows_inserted, second.rows_affected) == (1, 2, 3)
    rows = versions(second.snapshot)
    assert set(rows) == {(1, 1), (2, 1), (3, 1), (3, 2), (4, 1), (5, 1)}
    assert rows[1, 1].phone is None and rows[1, 1].is_current
    assert rows[2, 1].is_verified is True
    old, new = rows[3, 1], rows[3, 2]
    assert not old.is_current and old.valid_to == T2 == new.valid_from == old.updated_at
    assert old.updated_by == "t" and new.is_current and new.updated_at is None
    assert new.valid_to == datetime(9999, 12, 31, 23, 59, 59)
    assert rows[4, 1].is_current and rows[4, 1].valid_to == new.valid_to
    assert sorted(r.user_sk for r in rows.values()) == [1, 2, 3, 4, 5, 6]


def test_same_batch_twice_changes_nothing(spark):
    rows = [(i, "vip", "BR", "A", None, True) for i in range(20)]
    first = merge(spark, empty(spark, schema("dim_users")), rows, T1)
    again = merge(spark, first.snapshot, rows, T2)
    assert again.rows_affected == 0
    assert again.snapshot.exceptAll(first.snapshot).isEmpty()


def test_reopened_key_continues_its_numbering(spark):
    first = merge(spark, empty(spark, schema("dim_users")), [(1, "vip", "BR", "A", "1", True)], T1)
    closed = first.snapshot.withColumn("is_current", F.lit(False)).withColumn(
        "version_number", F.lit(3))
    result = merge(spark, empty(spark, schema("dim_users")), [(1, "vip", "BR", "A", "1", True)], T3,
                   closed)
    row = result.snapshot.first()
    assert (row.version_number, row.is_current, row.user_sk) == (4, True, 2)


def test_hosts_treat_null_rate_as_zero(spark):
    new = spark.sql("select 1 k, cast(0 as smallint) response_rate, true is_superhost, "
                    "'' host_location").alias("s")
    old = spark.sql("select 1 k, cast(null as smallint) response_rate, true is_superhost, "
                    "cast(null as string) host_location").alias("c")
    pair = new.join(old, F.expr("s.k = c.k"))
    assert pair.where(scd2.changed(scd2.HOSTS)).isEmpty()


def test_case_can_be_ignored(spark):
    first = merge(spark, empty(spark, schema("dim_users")), [(1, "vip", "BR", "a ", "1", True)], T1)
    staged = users(spark, [(1, "VIP", "br", "A", "1", True)])
    assert scd2.pending(first.snapshot, staged, scd2.USERS).count() == 1
    assert scd2.pending(first.snapshot, staged, scd2.USERS, ignore_case=True).isEmpty()


def test_text_keys_of_any_case(spark):
    """A key keeps its first spelling, in open and closed versions, and is not opened anew."""
    by_mail = replace(scd2.USERS, key="email")

    def batch(*rows):
        made = users(spark, [(i, kind, "BR", "A", None, True) for i, (_, kind) in enumerate(rows)])
        mails = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(rows)],
                                      "user_id int, mail string")
        return made.join(mails, "user_id").withColumn("email", F.col("mail")).drop("mail")

    def kept(merged):
        return sorted((r.email, r.version_number, r.user_type, r.is_current)
                      for r in merged.snapshot.collect())

    first = scd2.merge(empty(spark, schema("dim_users")), batch(("Ana@x", "vip"), ("bo@x", "vip")),
                       by_mail, T1, "t", ignore_case=True)
    second = batch(("ANA@X  ", "VIP "), ("BO@x", "premium"), (" bo@x", "vip"))
    done = scd2.merge(first.snapshot, second, by_mail, T2, "t", ignore_case=True)
    assert kept(done) == [(" bo@x", 1, "vip", True), ("Ana@x", 1, "vip", True),
                          ("bo@x", 1, "vip", False), ("bo@x", 2, "premium", True)]
    sets = scd2.preview(first.snapshot, second, by_mail, ignore_case=True)
    assert [r.new_user_type for r in sets["would_update"].collect()] == ["premium"]
    assert [r.email for r in sets["would_insert"].collect()] == [" bo@x"]
    # Without the option they are keys of their own.
    plain = scd2.merge(first.snapshot, second, by_mail, T2, "t")
    assert (plain.rows_updated, plain.rows_inserted) == (0, 3)
    closed = first.snapshot.withColumn("is_current", F.lit(False)).withColumn(
        "version_number", F.lit(3))
    again = scd2.merge(empty(spark, schema("dim_users")), second, by_mail, T3, "t", closed,
                       ignore_case=True)
    assert kept(again) == [(" bo@x", 1, "vip", True), ("Ana@x", 4, "VIP ", True),
                           ("bo@x", 4, "premium", True)]


def test_preview_agrees_with_merge(spark):
    first = merge(spark, empty(spark, schema("dim_users")),
                  [(i, "vip", "BR", "A", None, True) for i in range(9)], T1)
    batch = [(i, "vip" if i % 2 else "premium", "BR", "A", None, True) for i in range(4, 12)]
    sets = scd2.preview(first.snapshot, users(spark, batch), scd2.USERS)
    done = merge(spark, first.snapshot, batch, T2)
    assert sets["would_update"].count() == done.rows_updated
    assert sets["would_insert"].count() == done.rows_inserted - done.rows_updated
    assert sets["would_update"].columns == [
        "action", "user_id", "full_name", "new_user_type", "old_user_type", "new_city",
        "old_city", "reason"]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches_against_a_plain_model(spark, store, seed):
    """Four random batches, compared with versions kept in a dictionary."""
    rng = random.Random(seed)
    model: dict[int, list[tuple]] = {}
    table, closed, start = empty(spark, schema("dim_users")), None, 0
    for step in range(4):
        at = T1 + timedelta(days=step)
        batch = [(i, rng.choice(["vip", "premium"]), rng.choice([None, "", "BR"]),
                  rng.choice([None, "", "A"]), rng.choice([None, "", "1"]), rng.random() < 0.5)
                 for i in rng.sample(range(40), 25)]
        inserted = 0
        for row in batch:
            seen = model.setdefault(row[0], [])
            tracked = (row[1], row[2] or "", row[3] or "", row[4] or "")
            if not seen or seen[-1] != tracked:
                seen.append(tracked)
                inserted += 1
        result = merge(spark, table, batch, at, closed, start)
        assert result.rows_inserted == inserted
        just_closed = result.snapshot.where("not is_current")
        closed = just_closed if closed is None else closed.unionByName(just_closed)
        table, start = result.snapshot, result.last_key
    table = table.where("is_current").unionByName(closed)
    got: dict[int, list[tuple]] = {}
    for r in table.orderBy("user_id", "version_number").collect():
        got.setdefault(r.user_id, []).append(
            (r.user_type, r.country or "", r.city or "", r.phone or ""))
    assert got == {k: v for k, v in model.items() if v}
    bad = quality.audit({"dim_users": table}, quality.RULES).where(
        "violations > 0 and check_name not like 'unique user_uuid%'")
    assert bad.isEmpty()
