import re
from datetime import datetime

from pyspark.sql import Window, functions as F

from staywarehouse.operators import facts, keys, lookup
from staywarehouse.operators.calendar import calendar
from staywarehouse.operators.keys import profile
from staywarehouse.session import scratch_path


def test_numbers_follow_the_key_order(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), "id").repartition(7)
    got = keys.number(keys.materialise(rows, ["k"], "t"), "sk", 100)
    want = rows.withColumn("sk", F.row_number().over(Window.orderBy("k")) + 100)
    assert got.select("k", "id", F.col("sk").cast("int")).exceptAll(
        want.select("k", "id", "sk")).isEmpty()
    assert got.count() == 5000


def test_numbers_of_a_split_table(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(3000).select("id", (F.col("id") % 3 != 0).alias("good"))
        written = keys.materialise(rows, ["id"], "t", split_by="good")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert written.select("_metadata.file_path").distinct().count() == 16
    got = [(r.id, r.sk) for r in keys.number(written.where("good"), "sk").orderBy("id").collect()]
    assert got == [(i, n + 1) for n, i in enumerate(i for i in range(3000) if i % 3)]


def test_last_key_of_empty_table(spark):
    assert keys.last_key(spark.createDataFrame([], "sk bigint"), "sk") == 0


def test_salted_lookup_equals_plain_join(spark):
    """A third of the rows under one key, some keys unknown, some NULL."""
    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 7).when(
        F.col("id") % 100 == 1, None).otherwise(F.col("id") % 3000).cast("int").alias("k"))
    table = spark.range(2500).select(F.col("id").cast("int").alias("k"),
                                     (F.col("id") * 10).alias("sk"))
    hot = [r.k for r in lookup.hot_keys(rows, "k").collect()]
    assert hot == [7]
    for how in ("left", "inner"):
        plain = rows.join(table, "k", how)
        salted = lookup.salted_lookup(rows, table, "k", how)
        assert salted.columns == plain.columns
        assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_salting_is_used_without_adaptive_skew_joins(spark):
    rows, table = spark.range(10).withColumnRenamed("id", "k"), spark.range(5).select(
        F.col("id").alias("k"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert "_salt" in lookup.lookup(rows, table, "k")._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert lookup.lookup(rows, table, "k").count() == 10


def test_range_of_a_batch_reaches_the_scan(spark):
    from staywarehouse.operators import facts
    from staywarehouse.session import scratch_path
    path = scratch_path(spark, "fact")
    spark.range(1000).withColumnRenamed("id", "booking_id").write.parquet(path)
    batch = spark.range(990, 1010).withColumnRenamed("id", "booking_id")
    new = facts.not_loaded(batch, spark.read.parquet(path), ("booking_id",), "booking_id")
    plan = new._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(booking_id,990), LessThanOrEqual(booking_id,1009)" in plan
    assert sorted(r[0] for r in new.collect()) == list(range(1000, 1010))
    assert lookup.within(batch, batch.where("false"), "booking_id").isEmpty()


def test_copies_of_one_row_spread_over_the_salts(spark):
    rows = spark.range(8000).repartition(8).selectExpr("1 AS k")
    table = spark.sql("select 1 k, 5 sk")
    joined = lookup.salted_lookup(rows, table, "k")
    assert joined.count() == 8000 and joined.agg({"sk": "sum"}).first()[0] == 40000


def test_rows_without_a_key_spread_and_versions_are_found_under_skew(spark):
    """A third of the rows has no key, a third the same one."""
    from staywarehouse.operators.history import as_of
    rows = spark.range(9000).selectExpr(
        "id", "case id % 3 when 0 then null when 1 then 5 else id end AS k",
        "timestamp_ntz'2024-01-15' AS at")
    versions = spark.range(9000).selectExpr(
        "id AS k", "timestamp_ntz'2024-01-01' AS valid_from",
        "timestamp_ntz'2024-02-01' AS valid_to", "id + 1 AS sk")
    salted, _ = lookup.salted_sides(rows, versions, "k")
    largest = salted.groupBy("k", "_salt").count().agg(F.max("count")).first()[0]
    assert largest < 3000 / lookup.SALTS * 2
    plain = as_of(rows, versions, "k", "at", ["sk"])
    assert "BroadcastHashJoin" in plain._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = as_of(rows, versions, "k", "at", ["sk"])
        plan = split._jdf.queryExecution().toString()
        assert "Window" in plan and "Join" not in plan
        assert split.columns == plain.columns == ["id", "k", "at", "sk"]
        assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()
        assert split.where("sk is null").count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760b")


def test_versions_are_carried_through_slices(spark):
    """A third of the rows under one key, which has many versions, gaps and rows on their ends."""
    from staywarehouse.operators import history
    day = "timestamp_ntz'2024-01-01' + make_dt_interval(cast({} as int))"
    rows = spark.range(6000).selectExpr(
        "id", "cast(case when id % 3 = 0 then 7 when id % 50 = 1 then null else id % 900 end as int)"
        " AS k", f"case when id % 40 <> 2 then {day.format('id * 31 % 400')} end AS at")
    versions = spark.range(120).selectExpr(
        "7 AS k", f"{day.format('id * 3')} AS valid_from", f"{day.format('id * 3 + 2')} AS valid_to",
        "id AS sk", "concat('v', id) AS name")
    versions = versions.union(spark.range(800).selectExpr(
        "cast(id as int) k", day.format("id % 5"), "timestamp_ntz'9999-12-31 23:59:59'", "id + 1000",
        "cast(null as string)").where("k <> 7"))
    plain = history.as_of(rows, versions, "k", "at", ["sk", "name"])
    for parts in (1, 2, 12):
        bounds = history.slices(rows.where("k is not null and at is not null"), "k", "at", parts)
        assert set(bounds) == ({7} if parts > 3 else set())
        got = history.carried(rows, versions, "k", "at", ["sk", "name"], parts)
        assert got.columns == plain.columns
        assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
    assert len(bounds[7]) >= 3
    assert 500 < got.where("sk is null").count() < 3000
    largest = got.where("k = 7").groupBy(
        F.expr(" + ".join(f"int(at >= timestamp_ntz'{b}')" for b in bounds[7]))).count()
    assert largest.agg(F.max("count")).first()[0] <= 2000 / (len(bounds[7]) + 1) * 1.5
    none = history.carried(rows.where("false"), versions, "k", "at", ["sk"], 4)
    assert none.isEmpty() and none.columns == ["id", "k", "at", "sk"]


def test_a_hot_user_and_a_hot_property_are_both_split(spark, store):
    """A third of the bookings by one user, a third of one property; dimensions hold replaced rows."""
    rows = spark.range(200_000).selectExpr(
        "cast(id as int) AS booking_id", "cast(if(id % 3 = 0, 7, id % 5000) as int) AS user_id",
        "cast(if(id % 3 = 1, 9, id % 2000) as int) AS property_id",
        "date'2024-01-01' AS checkin_date", "date'2024-01-03' AS checkout_date",
        "date'2024-01-01' AS created_date", "md5(cast(id as string)) AS pad")
    path = scratch_path(spark, "bookings")
    rows.write.parquet(path)
    staged = spark.read.parquet(path)
    for table, name, n in (("dim_users", "user", 5000), ("dim_properties", "property", 2000)):
        every = spark.range(n).selectExpr(f"cast(id as int) AS {name}_id", f"id AS {name}_sk",
                                          "true AS is_current")
        again = every.where("id < 20")
        store.merge(table, every, f"{name}_id", 1, datetime(2024, 1, 1), n)
        store.merge(table, again, f"{name}_id", 2, datetime(2024, 1, 2), n, replaced=20)
    # Of 8 partitions the hot one has 5.0 times the median, just what Spark takes for skew.
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        known = profile(staged, "booking_id")
        found = facts.resolve_bookings(staged, None, store.read_current("dim_users"),
                                       store.read_current("dim_properties"),
                                       calendar(spark).coalesce(1), ends=known)
        dealt = found.repartitionById(len(known.bounds) + 1, known.range_of())
        run = dealt._jdf.queryExecution().executedPlan()
        assert run.execute().count() == 200_000
        final = run.toString().split("== Initial Plan ==")[0]
        assert re.findall(r"SortMergeJoin\(skew=true\) \[(\w+)#", final) == [
            "property_id", "user_id"]
        assert found.where("user_sk IS NULL OR property_sk IS NULL").isEmpty()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_rows_stay_where_they_are_to_be_numbered(spark):
    rows = spark.range(1000, 0, -1).selectExpr("id AS k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = keys.number(keys.materialise(rows, ["k"], "numbered"), "sk", 5)
        assert "SortMergeJoin" not in numbered._jdf.queryExecution().toString()
        assert all(r.sk == r.k + 5 for r in numbered.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_written_tables_are_packed_closely(spark, store):
    written = keys.materialise(spark.range(10).selectExpr("id AS k"), ["k"], "packed")
    store.append("dim_dates", spark.createDataFrame([], store.read("dim_dates").schema), 1,
                 datetime(2024, 1, 1))
    files = written.inputFiles() + store.read("dim_dates").inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
