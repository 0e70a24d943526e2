"""Filters of written batches: no key is lost, and files without a key are not read."""

import pytest
from pyspark.sql import functions as F

from staywarehouse.operators import keys
from staywarehouse.plans.full_load import Run
from staywarehouse.sources import sketch, staging
from staywarehouse.sources.store import Store, counted

GUID = "00000000-0000-4000-8000-%012d"


def names(spark, first, last):
    return spark.range(first, last).select(F.format_string("txn-%08d", "id").alias("t"))


def test_a_filter_holds_its_keys_and_few_others(spark):
    rows = names(spark, 0, 20_000).union(spark.sql("select cast(null as string)"))
    blocks = sketch.blocks_for(20_000)
    made = sketch.build(rows, "t", blocks)
    assert made.count() <= blocks == 1250
    held = made.withColumn("batch_id", F.lit(7).cast("long"))
    own = rows.withColumn("n", F.monotonically_increasing_id())
    for start in (0, 19_999, 777):
        some = own.where(F.col("t") == f"txn-{start:08d}")
        assert [r[0] for r in sketch.passed(some, "t", held, {7: blocks}).collect()] == [7]
    none = spark.sql("select cast(null as string) t")
    assert sketch.passed(none, "t", held, {7: blocks}).isEmpty()
    # one key at a time: of 20,000 others next to none passes
    blocked = held.crossJoin(spark.range(1)).drop("id")
    others = names(spark, 100_000, 120_000).withColumn("batch_id", F.lit(7).cast("long"))
    tests = others.select("*", *sketch._bits("t"), F.pmod(F.xxhash64("t"), F.lit(blocks)).alias(
        "block")).join(blocked.select("block", *[F.col(f"w{i}").alias(f"h{i}") for i in range(8)]),
                       "block")
    assert tests.where(" and ".join(f"h{i} & w{i} = w{i}" for i in range(8))).count() <= 5


def payments(spark, first, last):
    return spark.range(first, last).select(
        F.col("id").cast("int").alias("payment_id"), F.lit("p").alias("payment_uuid"),
        F.format_string(GUID, "id").alias("transaction_id"), F.col("id").alias("booking_id"),
        F.lit(1).alias("user_id"), F.lit(10).alias("amount"), F.lit("pix").alias("payment_method"),
        F.lit("paid").alias("payment_status"), F.to_date(F.lit("2024-05-01")).alias("payment_date"))


@pytest.fixture
def run(spark, store, clock):
    run = Run(store, "t", clock)
    run.populate_dates()
    user = spark.sql("select 1L user_sk, 1 user_id, true is_current")
    store.append("fact_bookings", spark.range(3000).select(
        F.col("id").alias("booking_id"), F.col("id").alias("booking_sk")), 900, clock())
    from staywarehouse.schemas import nullable, schema
    given = {"user_sk": "1L", "user_id": "1", "is_current": "true"}
    full = user.select(*[F.expr(f"cast({given.get(f.name, 'null')} as {f.dataType.simpleString()})"
                                f" as {f.name}") for f in nullable(schema("dim_users"))])
    store.merge("dim_users", full, "user_id", 901, clock(), 1)
    return run


def test_files_without_a_key_of_the_batch_are_not_read(spark, run, clock):
    store = run.store
    ready = lambda a, b: staging.prepare(payments(spark, a, b), "tb_payment", clock())
    for first in (0, 1000, 2000):
        done = run.load_fact("fact_payments", staged=ready(first, first + 1000))
        assert done["rows_loaded"] == 1000
    state = store.state("fact_payments")
    assert len(state.blocks) == 3 and state.rows == 3000
    batches = sorted(int(p.removeprefix("batch_id=")) for p in state.paths)

    def read(*ids):
        keys_ = spark.createDataFrame([(i,) for i in ids], "transaction_id string")
        files = store.holding("fact_payments", "transaction_id", keys_).inputFiles()
        return sorted({int(f.split("batch_id=")[1].split("/")[0]) for f in files})

    assert read(GUID % 1500) == batches[1:2]
    assert read(GUID % 7, GUID % 2999, None) == [batches[0], batches[2]]
    assert read(GUID % 99_999_999) == [] and read(None) == []
    # more tests than rows: all is read
    many = ready(0, 1500).select("transaction_id")
    assert store.holding("fact_payments", "transaction_id", many).count() == 3000

    # payments known by transaction, under new payment ids and out of range of the earlier ones
    again = ready(900, 1100).withColumn("payment_id", (F.col("payment_id") + 50_000).cast("int"))
    fresh = ready(2990, 3000).withColumn("transaction_id", F.concat("transaction_id", F.lit("x")))
    done = run.load_fact("fact_payments", staged=again.union(fresh))
    assert (done["rows_loaded"], done["rows_skipped"]) == (10, 200)
    done = run.load_fact("fact_payments", staged=again.union(fresh))
    assert (done["rows_loaded"], done["rows_skipped"]) == (0, 210)


def test_batches_without_a_filter_are_always_read(spark, run, clock):
    store = run.store
    rows = staging.prepare(payments(spark, 0, 100), "tb_payment", clock())
    run.load_fact("fact_payments", staged=rows)
    loaded = store.read("fact_payments")
    store.append("fact_payments", loaded.withColumn(
        "transaction_id", F.concat("transaction_id", F.lit("old"))), 950, clock())
    old = staging.prepare(payments(spark, 0, 5), "tb_payment", clock()).withColumn(
        "transaction_id", F.concat("transaction_id", F.lit("old")))
    assert run.load_fact("fact_payments", staged=old)["rows_loaded"] == 0


def test_staged_transactions_are_unique_over_all_batches(spark, store, clock):
    load = lambda df, n: staging.load(store, df, "tb_payment", n, clock())
    load(payments(spark, 0, 50), 1)
    load(payments(spark, 50, 100), 2)
    assert len(store.state("tb_payment").blocks) == 2
    moved = payments(spark, 30, 31).withColumn("payment_id", F.lit(7000))
    with pytest.raises(ValueError, match="transaction_id is not unique, staged rows have it too"):
        load(moved, 3)
    assert load(payments(spark, 100, 110), 4) == 10
    assert Store(spark, store.root).state("tb_payment") == store.state("tb_payment")


def test_counts_come_from_the_write(spark, store, clock):
    for rows in (spark.range(0), spark.range(10).where("id < 0"), spark.range(77).repartition(5)):
        seen, wanted = counted(rows, big="count_if(id > 70)"), rows.count()
        seen[0].write.format("noop").mode("overwrite").save()
        assert seen[1].get["rows"] == wanted and seen[1].get["big"] == (6 if wanted else 0)
    empty = spark.range(0).selectExpr("1 date_sk", "date'2024-01-01' full_date").where("false")
    assert store.append("dim_dates", empty, 1, clock()) == 0 == store.read("dim_dates").count()


def test_ranges_by_a_sketch(spark, monkeypatch):
    from staywarehouse.session import scratch_path
    monkeypatch.setattr(keys, "RANGE_ROWS", 500)
    rows = spark.range(5000).selectExpr("id * 7919 % 5003 AS k", "id", "id % 3 = 0 AS good")
    found = keys.profile(rows, "k")
    assert (found.rows, found.low, found.high, len(found.bounds)) == (5000, 0, 5002, 7)
    parts = {}
    for r in rows.withColumn("p", found.range_of()).collect():
        assert r.p == sum(b <= r.k for b in found.bounds)
        parts[r.p] = parts.get(r.p, 0) + 1
    assert set(parts) == set(range(8)) and max(parts.values()) < 800
    for split in (None, "good"):
        written = keys.materialise(rows, ["k"], "t", split, found)
        some = written.where("good") if split else written
        got = [(r.k, r.sk) for r in keys.number(some, "sk", 10).orderBy("k").collect()]
        wanted = sorted(r.k for r in rows.where("good" if split else "true").collect())
        assert got == [(k, 11 + i) for i, k in enumerate(wanted)]
    # a hundred bounds are searched in two steps; null keys go first
    many = keys.Profile("k", 1, 0, 1, tuple(range(0, 1000, 10)))
    odd = spark.sql("select * from values (-5L), (0L), (9L), (10L), (555L), (990L), (5000L), (null)"
                    " t(k)").withColumn("p", many.range_of())
    assert {r.k: r.p for r in odd.collect()} == {
        -5: 0, 0: 1, 9: 1, 10: 2, 555: 56, 990: 100, 5000: 100, None: 0}
    none = keys.profile(rows.where("false"), "k")
    assert (none.rows, none.low, none.bounds) == (0, None, ())
    path = scratch_path(spark, "one")
    rows.withColumn("k", F.lit(3).cast("long")).write.parquet(path)
    assert len(keys.profile(spark.read.parquet(path), "k").bounds) == 1
