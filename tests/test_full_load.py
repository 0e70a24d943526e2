from datetime import datetime

import pytest
from pyspark.sql import functions as F

from staywarehouse.operators import audit_states, generate, quality
from staywarehouse.plans import operations, reports
from staywarehouse.plans.full_load import Run
from staywarehouse.session import scratch_path
from staywarehouse.sources import manifest, staging
from staywarehouse.sources.store import Store
from staywarehouse.streaming.incremental import stream_fact

SMALL = {"users": 300, "hosts": 60, "properties": 150, "bookings": 900, "payments": 400,
         "reviews": 100, "clickstream": 10}


@pytest.fixture(scope="module")
def frames(spark):
    folder = scratch_path(spark, "frames")
    made = generate.everything(spark, SMALL)
    manifest.save_snapshot(made, folder)
    lines = {r.table_name: r for r in manifest.save_manifest(
        made, folder, datetime(2024, 1, 1)).collect()}
    assert lines["bookings"].row_count == 900 and lines["users"].seed == 42
    assert "_min_nights" not in lines["properties"].columns
    assert spark.read.json(f"{folder}/manifest").count() == len(made)
    return manifest.read_snapshot(spark, folder, list(made))


def test_everything_once_and_again(spark, store, clock, frames):
    run = Run(store, "t", clock)
    assert store.create("dim_users") and not store.create("dim_users")
    done = run.run(frames)
    assert done["dates"] and done["staged"] == {
        "tb_user": 300, "tb_host": 60, "tb_property": 150, "tb_booking": 900, "tb_payment": 400,
        "tb_review": frames["reviews"].count()}
    assert done["merges"]["dim_users"]["rows_affected"] == 300
    assert done["loads"]["fact_bookings"]["rows_loaded"] == 900
    assert done["loads"]["fact_payments"]["rows_loaded"] == 400
    assert store.read("fact_payments").count() == 400
    spent = store.read_current("dim_users").agg(F.sum("total_spent"),
                                                F.sum("total_bookings")).first()
    paid = frames["payments"].where("payment_status = 'paid'").agg(F.sum("amount")).first()
    assert (spent[0], spent[1]) == (paid[0], 900)
    audit = quality.audit({t: store.read(t) for t in quality.RULES}, quality.RULES)
    assert audit.where("violations > 0 and rule <> 'Q-13'").isEmpty()
    assert done["loads"]["dim_reviews"]["rows_loaded"] == frames["reviews"].count() > 0
    reviewed = run.load_fact("dim_reviews",
                             staged=staging.prepare(frames["reviews"], "tb_review", clock()))
    assert reviewed["rows_loaded"] == 0
    assert run.totals().first().payments == 400

    # the same batch again: nothing changes, and the log says so
    before = {t: store.state(t).paths for t in ("dim_hosts", "dim_properties", "fact_bookings")}
    again = run.run(frames, truncate=True)
    assert not again["dates"]
    assert [m["rows_affected"] for m in again["merges"].values()] == [0, 0, 0]
    assert [m["rows_loaded"] for m in again["loads"].values()] == [0, 0, 0]
    assert {t: store.state(t).paths for t in before} == before
    log = run.etl_summary().collect()
    assert [r.rows_affected for r in log if r.table_name == "fact_bookings"] == [0, 900]
    assert len({r.batch_id for r in log}) == len(log)

    # dry runs write nothing
    state = store.state("fact_bookings")
    sets = operations.preview(run, "load_fact_bookings")
    assert sets["would_insert"].isEmpty()
    assert set(operations.execute(run, "merge_dim_hosts", dry_run=True)) == {
        "would_update", "would_insert"}
    assert store.state("fact_bookings") == state
    assert operations.execute(run, "get_user_history", user_id=5).count() == 1
    assert operations.execute(run, "get_etl_summary", days_back=1).count() == len(log)
    with pytest.raises(ValueError):
        operations.execute(run, "get_etl_summary", dry_run=True)
    with pytest.raises(KeyError):
        operations.execute(run, "no_such_operation")


def test_rejects_are_kept(spark, store, clock, frames):
    run = Run(store, "t", clock)
    some = {k: frames[k] for k in ("users", "hosts", "properties", "bookings")}
    some["users"] = frames["users"].where("user_id > 20")
    done = run.run(some, refresh_metrics=False)["loads"]["fact_bookings"]
    kept = store.read_rejects("fact_bookings", "tb_booking")
    assert done["rows_loaded"] + done["rows_rejected"] == 900
    assert kept.count() == done["rows_rejected"] > 0
    assert {r[0] for r in kept.select("reject_reason").collect()} == {"unknown_user"}


def test_changes_close_versions_and_prune_partitions(spark, store, clock, frames):
    run = Run(store, "t", clock)
    run.run(frames, load=False, refresh_metrics=False)
    changed = frames["users"].withColumn("city", F.expr(
        "if(user_id <= 40, concat(city, ' X'), city)"))
    run.stage({"users": changed}, truncate=True)
    assert run.merge_dimension("dim_users")["rows_updated"] == 40
    current = store.read("dim_users").where("is_current")
    assert current.count() == 300 and store.read_closed("dim_users").count() == 40
    plan = current.select("user_id")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(is_current" in plan
    assert store.read("dim_users").agg(F.max("user_sk")).first()[0] == 340
    assert store.state("dim_users").last_key == 340


def test_errors_are_logged_and_raised(spark, store, frames):
    frozen = datetime(2024, 1, 1)
    run = Run(store, "t", lambda: frozen)
    run.run(frames, load=False, refresh_metrics=False)
    with pytest.raises(ValueError, match="not after the last merge"):
        run.merge_dimension("dim_users")
    errors = run.error_summary().collect()
    assert [e.error_procedure for e in errors] == ["merge_dim_users"]
    assert "not after the last merge" in errors[0].error_message
    assert store.read("dim_users").count() == 300


def test_duplicate_keys_reject_the_batch(spark, store, clock, frames):
    double = frames["users"].unionByName(frames["users"].limit(1))
    with pytest.raises(ValueError, match="tb_user: user_id is not unique"):
        staging.load(store, double, "tb_user", 1, clock())
    assert store.read("tb_user").isEmpty()
    assert staging.load(store, frames["users"], "tb_user", 2, clock()) == 300
    with pytest.raises(ValueError, match="is not unique, staged rows have it too"):
        staging.load(store, frames["users"], "tb_user", 3, clock())
    assert store.read("tb_user").count() == 300
    with pytest.raises(ValueError, match="already committed"):
        store.append("tb_user", store.read("tb_user"), 2, clock())


def test_uncommitted_files_stay_invisible(spark, store, clock):
    rows = spark.sql("select 20240101 date_sk, date'2024-01-01' full_date")
    from staywarehouse.operators.calendar import describe_days
    days = describe_days(rows.select("full_date"))
    store.append("dim_dates", days, 1, clock())
    days.write.parquet(f"{store.root}/data/dim_dates/batch_id=2")
    assert store.read("dim_dates").count() == 1
    store.append("dim_dates", days, 2, clock())
    assert store.read("dim_dates").count() == 2


def test_streamed_bookings_arrive_once(spark, store, clock, frames):
    run = Run(store, "t", clock)
    run.run({k: frames[k] for k in ("users", "hosts", "properties")}, load=False,
            refresh_metrics=False)
    folder, checkpoint = scratch_path(spark, "arrive"), scratch_path(spark, "ckpt")
    ready = staging.prepare(frames["bookings"], "tb_booking", clock())
    ready.where("booking_id <= 500").write.parquet(folder)
    stream_fact(run, "fact_bookings", folder, checkpoint).awaitTermination()
    assert store.read("fact_bookings").count() == 500
    ready.where("booking_id > 400").write.mode("append").parquet(folder)
    stream_fact(run, "fact_bookings", folder, checkpoint).awaitTermination()
    got = store.read("fact_bookings")
    assert got.count() == 900 == got.select("booking_id").distinct().count()
    assert got.agg(F.min("booking_sk"), F.max("booking_sk")).first() == (1, 900)


def test_reports_on_versions_and_ties(spark):
    facts = spark.sql("""select * from values
        (1, 1, 20240101, 'completed', 10.0), (2, 1, 20240101, 'completed', 10.0),
        (3, 2, 20250101, 'completed', 20.0), (4, 3, 20250102, 'cancelled', 99.0)
        t(booking_id, property_sk, checkin_date_sk, booking_status, total_price)""")
    places = spark.sql("""select * from values
        (1, 7, 'B', 'X', 'loft', true), (2, 8, 'A', 'X', 'villa', false),
        (3, 9, 'C', 'X', 'villa', true), (4, 8, 'A', 'X', 'villa', true)
        t(property_sk, property_id, title, city, property_type, is_current)""")
    top = reports.top_properties(facts, places)
    assert [(r.title, r.total_bookings) for r in top.collect()] == [("B", 2)]
    top = reports.top_properties(facts, places, repoint=True)
    assert [r.title for r in top.collect()] == ["A", "B"]
    assert reports.top_properties(facts, places, n=1, repoint=True).count() == 1
    rates = {r.property_type: str(r.cancellation_rate)
             for r in reports.cancellation_rate(facts, places, repoint=True).collect()}
    assert rates == {"loft": "0.00", "villa": "50.00"}
    from staywarehouse.operators.calendar import calendar
    days = calendar(spark, "2024-01-01", "2025-12-31")
    assert [str(r.revenue_ytd) for r in reports.daily_revenue(facts, days).collect()] == [
        "20.00", "40.00"]
    assert [str(r.revenue_ytd) for r in
            reports.daily_revenue(facts, days, reset="year").collect()] == ["20.00", "20.00"]


def test_audit_finds_what_is_wrong(spark):
    users = spark.sql("""select * from values
        (1, 1, 'gold', timestamp_ntz'2024-01-01', timestamp_ntz'2024-02-01', false, 1, 'a'),
        (2, 1, 'vip', timestamp_ntz'2024-02-02', timestamp_ntz'9999-12-31', true, 2, 'a'),
        (3, 1, 'vip', timestamp_ntz'2024-02-02', timestamp_ntz'2024-01-01', true, 4, 'b')
        t(user_sk, user_id, user_type, valid_from, valid_to, is_current, version_number,
          user_uuid)""")
    got = {r.check_name: r.violations for r in quality.audit(
        {"dim_users": users}, quality.RULES, with_declared=False).collect()}
    assert got == {
        "user_type in domain": 1, "valid_from before valid_to": 1,
        "unique user_id,valid_from": 1, "unique user_id where is_current": 1,
        "unique user_uuid where is_current": 0, "versions of user_id are contiguous": 2}
    rule = quality.RULES["dim_users"][0]
    assert [r.user_sk for r in quality.violations(users, rule).collect()] == [1]
    orphan = quality.ReferenceRule("DQ-11", "user_sk", "dim_users", "user_sk")
    rows = spark.sql("select * from values (1), (9), (9), (null) t(user_sk)")
    assert quality.violations(rows, orphan, users).collect()[0]["_n"] == 2
    assert quality.audit({"f": rows, "dim_users": users}, {"f": [orphan]}, False).first()[
        "violations"] == 2


def test_copies_of_a_key_are_settled_alike(spark, store, clock, frames):
    run = Run(store, "t", clock)
    run.run({k: frames[k] for k in ("users", "hosts", "properties")}, load=False,
            refresh_metrics=False)
    ready = staging.prepare(frames["bookings"], "tb_booking", clock()).where("booking_id <= 60")
    other = ready.where("booking_id <= 20").withColumn("number_of_guests", ready.number_of_guests + 1)
    done = run.load_fact("fact_bookings", staged=ready.union(other).union(ready))
    assert (done["rows_loaded"], done["rows_skipped"]) == (60, 80)
    seen = []
    for files in (1, 1000):
        own = Run(Store(spark, scratch_path(spark, "copies")), "t", clock)
        own.run({k: frames[k] for k in ("users", "hosts", "properties")}, load=False,
                refresh_metrics=False)
        folder, checkpoint = scratch_path(spark, "arrive"), scratch_path(spark, "ckpt")
        ready.coalesce(1).write.parquet(folder)
        other.coalesce(1).write.mode("append").parquet(folder)
        stream_fact(own, "fact_bookings", folder, checkpoint, files).awaitTermination()
        seen.append(sorted((r.booking_id, r.number_of_guests) for r in
                           own.store.read("fact_bookings").collect()))
    assert seen[0] == seen[1] == sorted((r.booking_id, r.number_of_guests)
                                        for r in ready.collect())


def test_unknown_frames_are_refused(frames):
    with pytest.raises(ValueError, match="no staging table for clicks"):
        staging.route({"clicks": frames["users"]})


def written(store, table, batch_id):
    """Rows in the files that one batch wrote."""
    root = f"{store.root}/data/{table}/batch_id={batch_id}"
    return store.spark.read.parquet(root).count()


def test_a_merge_writes_what_it_changes(spark, store, clock, frames):
    run = Run(store, "t", clock)
    run.run({"users": frames["users"]}, load=False, refresh_metrics=False)
    before = store.state("dim_users").paths

    def merge(condition):
        users = frames["users"].withColumn("city", F.expr(f"if({condition}, 'Elsewhere', city)"))
        run.stage({"users": users.where("user_id <> 300 or " + str(condition != "user_id = 7"))},
                  truncate=True)
        return run.merge_dimension("dim_users")

    done = merge("user_id = 7")
    assert done["rows_updated"] == 1 and written(store, "dim_users", done["batch_id"]) == 2
    state = store.state("dim_users")
    assert set(before) < set(state.paths) and len(state.overlays) == state.replaced == 1
    done = merge("user_id in (7, 9)")  # 7 as before
    assert done["rows_updated"] == 1 and len(store.state("dim_users").overlays) == 2
    rows = store.read("dim_users")
    assert rows.count() == 302 and rows.where("is_current").count() == 300
    assert store.read_current("dim_users").select("user_id").distinct().count() == 300
    assert [(r.city, r.is_current) for r in
            rows.where("user_id = 7").orderBy("version_number").collect()][1:] == [
        ("Elsewhere", True)]
    back = run.stage({"users": frames["users"]}, truncate=True) and run.merge_dimension("dim_users")
    assert back["rows_updated"] == 2  # both return to where they were, by one more version
    assert [r.version_number for r in store.read_current("dim_users").where(
        "user_id in (7, 9)").collect()] == [3, 3]
    state = store.state("dim_users")
    assert (state.replaced, state.current_rows, len(state.overlays)) == (4, 300, 3)

    # beyond the share all current rows are written and nothing is left out on reading
    run.stage({"users": frames["users"].withColumn("city", F.lit("X"))}, truncate=True)
    done = run.merge_dimension("dim_users")
    state = store.state("dim_users")
    assert written(store, "dim_users", done["batch_id"]) == 300 + done["rows_updated"]
    assert (state.replaced, state.current_rows, state.overlays) == (0, 300, ())
    plan = store.read_current("dim_users")._jdf.queryExecution().toString()
    assert "Join" not in plan
    rows = store.read("dim_users")
    assert rows.where("is_current").count() == 300
    assert rows.count() == 304 + done["rows_updated"]
    last = rows.groupBy("user_id").agg(F.max("version_number").alias("v"),
                                       F.count("*").alias("n"), F.count_if("is_current").alias("c"))
    assert last.where("v <> n or c <> 1").isEmpty()
    versions = quality.audit({"dim_users": rows}, {"dim_users": quality.RULES["dim_users"]})
    assert versions.where("violations > 0").isEmpty()


def test_new_keys_after_changed_ones(spark, store, clock, frames):
    run, users = Run(store, "t", clock), frames["users"]
    run.run({"users": users.where("user_id <= 250")}, load=False, refresh_metrics=False)
    run.stage({"users": users.where("user_id <= 250").withColumn(
        "city", F.expr("if(user_id = 7, 'Elsewhere', city)"))}, truncate=True)
    run.merge_dimension("dim_users")
    run.stage({"users": users.where("user_id > 250")}, truncate=True)
    done = run.merge_dimension("dim_users")
    state = store.state("dim_users")
    assert (done["rows_inserted"], done["rows_updated"]) == (50, 0)
    assert (len(state.overlays), state.current_rows, state.last_key) == (1, 300, 301)
    run.stage({"users": users.where("user_id > 250").withColumn(
        "city", F.expr("if(user_id = 299, 'Elsewhere', city)"))}, truncate=True)
    assert run.merge_dimension("dim_users")["rows_updated"] == 1
    current = store.read_current("dim_users")
    assert current.count() == 300 == current.select("user_id").distinct().count()
    assert current.where("city = 'Elsewhere'").count() == 2
    # another store sees the same by the commit rows alone
    other = Store(spark, store.root)
    assert other.state("dim_users") == store.state("dim_users")
    assert other.read_current("dim_users").exceptAll(current).isEmpty()


def test_metrics_write_changed_rows_and_mark_them(spark, store, clock, frames):
    run = Run(store, "t", clock)
    run.run({**frames, "users": frames["users"].drop("total_bookings", "total_spent")})
    marked = store.read_current("dim_users").where("updated_by = 't'")
    changed = store.read_current("dim_users").where("total_bookings > 0 or total_spent > 0")
    assert marked.count() == changed.count() > 0
    state = store.state("dim_users")
    assert run.update_user_metrics()["rows_affected"] == 300
    assert store.state("dim_users") == state
    one = store.read("fact_payments").where("payment_status = 'paid'").limit(1)
    store.append("fact_payments", one, 900, clock())
    owner = one.join(store.read("dim_users"), "user_sk").first()
    done = run.update_user_metrics()
    assert done["rows_affected"] == 300 and written(store, "dim_users", done["batch_id"]) == 1
    now = store.read("dim_users").where(f"user_id = {owner.user_id}").collect()
    assert [r.total_spent - owner.total_spent for r in now] == [owner.amount]
    assert store.read_current("dim_users").count() == 300


def test_bad_rows_go_to_the_rejects(spark, store, clock, frames):
    run = Run(store, "t", clock)
    odd = frames["users"].withColumns({
        "is_verified": F.expr("if(user_id = 3, 'perhaps', cast(is_verified as string))"),
        "email": F.expr("if(user_id = 4, null, email)"),
        "phone": F.expr("if(user_id = 5, repeat('1', 21), phone)")})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run.stage({"users": odd})
    assert [e.error_procedure for e in run.error_summary().collect()] == ["stage_tb_user"]
    assert run.stage({"users": odd}, safe=True) == {"tb_user": 297}
    kept = store.read_rejects("tb_user").collect()
    assert sorted(r.reject_reason for r in kept) == ["bad_is_verified", "long_phone",
                                                     "missing_email"]
    assert all('"user_id":' in r.raw for r in kept)
    missing = staging.sorted_out(frames["users"].drop("email"), "tb_user", clock())
    assert missing.where("reject_reason is null").isEmpty()
    assert staging.load(store, frames["hosts"].where("false"), "tb_host", 50, clock(),
                        safe=True) == 0


def test_options_reach_the_operators(spark, store, clock, frames):
    run = Run(store, "t", clock)
    some = {k: frames[k] for k in ("users", "hosts", "properties", "bookings", "payments")}
    run.run(some)
    loud = frames["users"].withColumn("city", F.upper("city")).withColumn(
        "country", F.lower("country"))
    run.stage({"users": loud}, truncate=True)
    sets = operations.preview(run, "merge_dim_users", ignore_case=True)
    assert sets["would_update"].isEmpty()
    assert operations.execute(run, "merge_dim_users", ignore_case=True)["rows_affected"] == 0
    assert not operations.preview(run, "merge_dim_users")["would_update"].isEmpty()
    again = staging.prepare(frames["payments"], "tb_payment", clock()).withColumn(
        "transaction_id", F.concat(F.lit("x"), "transaction_id"))
    assert operations.execute(run, "load_fact_payments", staged=again,
                              also_payment_id=True)["rows_loaded"] == 0


def test_a_failing_stream_is_logged(spark, store, clock, frames):
    run = Run(store, "t", clock)
    folder = scratch_path(spark, "arrive")
    staging.prepare(frames["bookings"], "tb_booking", clock()).withColumn(
        "checkin_date", F.lit("soon")).write.parquet(folder)
    with pytest.raises(Exception):
        stream_fact(run, "fact_bookings", folder, scratch_path(spark, "ckpt")).awaitTermination()
    assert {e.error_procedure for e in run.error_summary().collect()} == {"stream_fact_bookings"}
    assert store.read("fact_bookings").isEmpty()


def test_scratch_tables_go_when_a_batch_is_done(spark, store, clock, frames):
    from pathlib import Path
    from staywarehouse.session import shared_folder
    home = Path(shared_folder(spark)) / "staywarehouse" / spark.sparkContext.applicationId
    run = Run(store, "t", clock)
    kept = {p.name for p in home.iterdir()} | {Path(store.root).name}
    run.run({k: frames[k] for k in ("users", "hosts", "properties", "bookings")})
    assert {p.name for p in home.iterdir()} == kept
    assert store.read("fact_bookings").count() == 900


def everything(store):
    """What a load leaves behind, as sets of rows."""
    frames = (store.read("fact_bookings"), store.read_log("etl_batch_log"),
              store.read_log("etl_error_log"), store.read_rejects("fact_bookings", "tb_booking"))
    return [sorted(map(repr, f.collect())) for f in frames]


def test_a_replayed_micro_batch_changes_nothing(spark, store, clock, frames):
    from staywarehouse.operators.facts import ARRIVAL
    from staywarehouse.streaming.incremental import load_batch
    run = Run(store, "t", clock)
    some = {k: frames[k] for k in ("users", "hosts", "properties")}
    some["users"] = some["users"].where("user_id > 20")
    run.run(some, load=False, refresh_metrics=False)
    rows = staging.prepare(frames["bookings"], "tb_booking", clock()).withColumn(
        ARRIVAL, F.col("booking_id"))
    first = load_batch(run, "fact_bookings", rows, "stream:0")
    only_bad = rows.where("user_id <= 20").withColumn("booking_id", F.col("booking_id") + 5000)
    second = load_batch(run, "fact_bookings", only_bad, "stream:1")
    assert first["rows_rejected"] == second["rows_rejected"] > 0 == second["rows_loaded"]
    before = everything(store)
    for number, frame in enumerate((rows, only_bad)):
        for own in (run, Run(Store(spark, store.root), "t", clock)):
            done = load_batch(own, "fact_bookings", frame, f"stream:{number}")
            assert (done["status"], done["rows_loaded"]) == ("REPLAYED", 0)
    assert everything(store) == before
    # the same number of another stream is another micro-batch
    assert load_batch(run, "fact_bookings", rows, "other:0")["rows_skipped"] == first["rows_loaded"]

    # a run that ended between commit and log row: the replay writes the row, once
    lost = rows.where("user_id > 20").limit(30).withColumn("booking_id", F.col("booking_id") + 9000)
    log, store.log = store.log, lambda *_: None
    assert load_batch(run, "fact_bookings", lost, "stream:2")["rows_loaded"] == 30
    store.log = log
    for _ in range(2):
        batch = load_batch(run, "fact_bookings", lost, "stream:2")["batch_id"]
    logged = store.read_log("etl_batch_log").where(F.col("batch_id") == batch).collect()
    assert [r.rows_affected for r in logged] == [30]


def test_an_unreadable_file_leaves_one_error_row(spark, store, clock):
    import time
    from pathlib import Path
    run = Run(store, "t", clock)
    folder = Path(scratch_path(spark, "arrive"))
    folder.mkdir(parents=True)
    (folder / "part-0.parquet").write_bytes(b"this is no Parquet file, however long it is")
    # a plain read of the rows fails in the load, so it is logged there and not by the listener
    query = stream_fact(run, "fact_bookings", str(folder), scratch_path(spark, "ckpt"))
    with pytest.raises(Exception):
        query.awaitTermination()
    # this one ends before any load: its checkpoint is of another source
    checkpoint = Path(scratch_path(spark, "ckpt"))
    (checkpoint / "offsets").mkdir(parents=True)
    (checkpoint / "offsets" / "0").write_text("v1\nnot an offset")
    query = stream_fact(run, "fact_bookings", str(folder), str(checkpoint))
    with pytest.raises(Exception):
        query.awaitTermination()
    for _ in range(60):
        errors = run.error_summary().collect()
        if len(errors) > 1:
            break
        time.sleep(1)
    time.sleep(3)
    errors = run.error_summary().collect()
    assert [e.error_procedure for e in errors] == ["stream_fact_bookings"] * 2
    assert store.read("fact_bookings").isEmpty()


def _lines(df):
    return sorted(tuple(r) for r in df.select("rule", "table_name", "check_name",
                                              "violations").collect())


def test_audit_by_batches(spark, store, clock, frames, monkeypatch):
    run = Run(store, "t", clock)
    run.run(frames)
    whole = {t: store.read(t) for t in quality.RULES}
    assert _lines(run.audit()) == _lines(quality.audit(whole, quality.RULES))
    booked, paid = store.read("fact_bookings"), store.read("fact_payments")
    key = booked.agg(F.max("booking_sk")).first()[0] + 10
    # keys of earlier rows, one twice and one for the third time; payments before their booking
    again = booked.where("booking_id <= 5").unionByName(booked.where("booking_id <= 2"))
    store.append("fact_bookings", again.withColumn("user_sk", F.lit(999_999).cast("long")), 901,
                 clock())
    early = paid.where("payment_id <= 7").withColumns({
        "booking_sk": F.lit(key).cast("long"), "amount": F.lit(-1).cast("decimal(12,2)"),
        "payment_id": F.col("payment_id") + 100_000})
    store.append("fact_payments", early, 902, clock())
    read, batches = [], store.read_batches
    monkeypatch.setattr(store, "read_batches",
                        lambda table, ids: read.append((table, sorted(ids))) or batches(table, ids))
    found = _lines(run.audit())
    whole = {t: store.read(t) for t in quality.RULES}
    assert found == _lines(quality.audit(whole, quality.RULES))
    counts = {line[1:3]: line[3] for line in found}
    assert counts["fact_bookings", "unique booking_id"] == 5
    assert counts["fact_bookings", "user_sk in dim_users.user_sk"] == 7
    assert counts["fact_payments", "booking_sk in fact_bookings.booking_sk"] == 7
    assert counts["fact_payments", "amount not negative"] == 7
    assert [(t, i) for t, i in read if 901 in i or 902 in i] == [
        ("fact_bookings", [901]), ("fact_payments", [902])]

    # the booking arrives: its payments are found without reading them again
    read.clear()
    store.append("fact_bookings", booked.where("booking_id = 9").withColumns({
        "booking_id": F.col("booking_id") + 100_000, "booking_sk": F.lit(key).cast("long")}), 903,
        clock())
    found = _lines(run.audit())
    assert found == _lines(quality.audit({t: store.read(t) for t in quality.RULES},
                                         quality.RULES))
    assert {t for t, _ in read} == {"fact_bookings"}
    assert {line[1:3]: line[3] for line in found}[
        "fact_payments", "booking_sk in fact_bookings.booking_sk"] == 0
    # nothing new: no batch is read; a truncated table begins anew
    read.clear()
    assert _lines(run.audit()) == found and not read
    store.replace("fact_payments", paid.where("payment_id <= 50"), 904, clock())
    assert _lines(run.audit()) == _lines(quality.audit(
        {t: store.read(t) for t in quality.RULES}, quality.RULES))


def test_second_audit_reads_keys_of_earlier_rows_only(spark, store, clock, frames):
    run = Run(store, "t", clock)
    run.run(frames)
    run.audit()
    store.append("fact_bookings", store.read("fact_bookings").where("booking_id = 1"), 901,
                 clock())
    rules = quality.all_rules("fact_bookings")
    state = audit_states.found(
        "fact_bookings", "x", [901], store.read_batches("fact_bookings", [901]),
        store.read_batches("fact_bookings", [
            b for b in store.state("fact_bookings").batches if b != 901]),
        rules, {t: store.read(t) for t in quality.RULES})
    leaves = state._jdf.queryExecution().sparkPlan().collectLeaves()
    scans = [(len(leaf.requiredSchema().fieldNames()), leaf.relation().location().inputFiles())
             for leaf in (leaves.apply(i) for i in range(leaves.size()))
             if leaf.nodeName().startswith("Scan parquet")]
    wide = [files for columns, files in scans if columns > 1]
    assert len(scans) > len(wide) > 0
    assert all("/batch_id=901/" in file for files in wide for file in files)


def test_new_keys_are_counted_with_earlier_ones_by_one_shuffle_of_either(spark):
    rule = quality.UniqueRule("DQ-10", ("k",))
    new = spark.sql("select * from values ('a'), ('a'), ('b'), ('c'), ('d'), (null) t(k)")
    earlier = spark.sql("select * from values ('b'), ('c'), ('c'), ('e'), ('e'), (null) t(k)")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = audit_states._ambiguous(new, earlier, "t", rule)
        assert "Join" not in large._jdf.queryExecution().toString()
        assert large.first().violations == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert audit_states._ambiguous(new, earlier, "t", rule).first().violations == 3
