"""Registered queries by operator id; each reads the whole of its tables.

Results are put into portable form: dates and times as text, decimals as doubles.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import dates, money, text
from ..functions.dates import moment
from ..operators import audit, facts, generate, history, metrics, quality, scd2
from ..operators.calendar import calendar_stats
from ..plans import operations, reports
from ..plans.full_load import Run
from ..session import scratch_path
from ..sources import manifest as snapshots, staging
from ..sources.fixtures import LOADED_AT, TestTables
from ..sources.store import Store
from ..streaming.incremental import stream_fact
from .loaded import BATCH_1, CREATED_BY, LOADED, Loaded, loaded

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
AS_OF = datetime(2024, 1, 20)


def portable(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out.append(f"cast({f.name} as string) AS {f.name}")
        elif isinstance(f.dataType, T.DecimalType):
            out.append(f"cast({f.name} as double) AS {f.name}")
        else:
            out.append(f.name)
    return df.selectExpr(*out)


def query(name: str):
    def register(work: Callable[[Loaded], DataFrame]):
        _QUERIES[name] = lambda spark, folder: portable(work(loaded(spark, folder)))
        return work
    return register


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _count(df: DataFrame, extra: int = 0):
    return df.agg((F.count("*") + extra).alias("n")).scalar()


# ---- sources and sinks --------------------------------------------------------------


@query("io01_snapshot_properties")
def _(w: Loaded):
    folder = scratch_path(w.spark, "snapshot")
    snapshots.save_snapshot({"properties": _gen_properties(w)}, folder)
    return snapshots.read_snapshot(w.spark, folder, ["properties"])["properties"]


@query("io02_manifest")
def _(w: Loaded):
    src = w.source
    return snapshots.manifest({"users": src.users(2, True), "hosts": src.hosts(2),
                               "properties": src.properties(2), "bookings": src.bookings(),
                               "payments": src.payments()})


def _store(w: Loaded) -> Store:
    return Store(w.spark, scratch_path(w.spark, "store"))


@query("io03_staging_append")
def _(w: Loaded):
    store = _store(w)
    staging.load(store, w.source.bookings(), "tb_booking", 1, LOADED_AT)
    return store.read("tb_booking")


@query("io04_staging_truncate_load")
def _(w: Loaded):
    store = _store(w)
    staging.load(store, w.source.users(1, True), "tb_user", 1, LOADED_AT)
    staging.load(store, w.source.users(2, True), "tb_user", 2, LOADED_AT, truncate=True)
    return store.read("tb_user")


@query("io06_pruned_columns")
def _(w: Loaded):
    helpers = w.source.hosts(2).withColumns({"_rank": F.lit(1), "is_current": F.lit(True),
                                             "created_by": F.lit("x")})
    return staging.prune(helpers)


@query("io10_dry_run_previews")
def _(w: Loaded):
    """Result sets of dry runs by name, and how many of the first rows each one shows."""
    run = _run_on(w)
    run.store.merge("dim_users", w.users_1.snapshot, "user_id", 5, LOADED, 0)
    staging.load(run.store, w.source.users(2), "tb_user", 6, LOADED_AT)
    staging.load(run.store, w.source.bookings(), "tb_booking", 7, LOADED_AT)
    parts = [df.agg(F.count("*").alias("shown")).select(
        F.lit(name).alias("operation"), F.lit(action).alias("action"), "shown")
        for name in ("merge_dim_users", "load_fact_bookings")
        for action, df in operations.preview(run, name).items()]
    return reduce(DataFrame.unionByName, parts)


@query("io11_created_once")
def _(w: Loaded):
    """Staging tables that exist are not created again; new ones are, without rows."""
    store = _store(w)
    staging.load(store, w.source.bookings(), "tb_booking", 1, LOADED_AT)
    made = {t: (store.create(t), store.create(t)) for t in ("tb_booking", "tb_payment")}
    parts = [store.read(t).agg(F.count("*").alias("row_count")).select(
        F.lit(t).alias("table_name"), F.lit(once).alias("created"),
        F.lit(again).alias("created_again"), "row_count") for t, (once, again) in made.items()]
    return reduce(DataFrame.unionByName, parts)


@query("io12_staged_hosts_with_defaults")
def _(w: Loaded):
    return w.source.staged("tb_host", 2)


# ---- cleaning -----------------------------------------------------------------------


@query("cl01_clean_events")
def _(w: Loaded):
    return staging.clean(w.source.dirty_clicks(), "event_id")


@query("cl03_guid_check")
def _(w: Loaded):
    raw = w.source.dirty_clicks()
    return raw.selectExpr("event_id", f"{text.is_guid('transaction_id')} AS is_guid")


@query("cl05_typed_with_rejects")
def _(w: Loaded):
    """Events as texts, some of them no numbers or times, staged with rejects."""
    e, store = F.col("event_id"), _store(w)
    raw = w.source.clicks().withColumns({
        "user_id": F.concat(F.col("user_id").cast("string"), F.when(e % 9 == 0, "x").otherwise("")),
        "event_timestamp": F.concat(F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss"),
                                    F.when(e % 11 == 0, "?").otherwise("")),
        "event_type": F.when(e % 13 != 0, F.col("event_type"))})
    staging.load(store, raw, "tb_click", 1, LOADED_AT, safe=True)
    good = store.read("tb_click").select("event_id", "user_id", "event_type", "event_timestamp",
                                         F.lit(None).cast("string").alias("reject_reason"))
    given = F.from_json("raw", "event_id bigint, user_id string, event_type string,"
                               "event_timestamp string")
    bad = store.read_rejects("tb_click").select(given.alias("given"), "reject_reason").select(
        "given.event_id", F.col("given.user_id").try_cast("int").alias("user_id"),
        "given.event_type", F.col("given.event_timestamp").try_cast("timestamp_ntz")
        .alias("event_timestamp"), "reject_reason")
    return good.unionByName(bad)


@query("cl06_staged_clicks")
def _(w: Loaded):
    return w.source.staged("tb_click")


# ---- calendar -----------------------------------------------------------------------


@query("dd01_calendar")
def _(w: Loaded):
    used = w.staged_bookings.groupBy("checkin_date").agg(F.count("*").alias("checkins"))
    days = w.dates.join(used, F.col("full_date") == F.col("checkin_date"), "left")
    return days.drop("checkin_date").withColumn("checkins", F.coalesce("checkins", F.lit(0)))


@query("dd02_calendar_stats")
def _(w: Loaded):
    """The calendar, and how many of its days the bookings use."""
    used = w.bookings.agg(F.count_distinct("checkin_date_sk").alias("n")).scalar()
    return calendar_stats(w.dates).withColumn("checkin_days", used)


# ---- single clauses -----------------------------------------------------------------


@query("pf01_current_users")
def _(w: Loaded):
    return w.users.where("is_current").select("user_sk", "user_id", "user_type", "country",
                                              "city", "version_number")


def _user_pairs(w: Loaded) -> DataFrame:
    s = w.source.staged("tb_user", 2).alias("s")
    c = w.users_1.snapshot.where("is_current").alias("c")
    return s.join(c, F.col("s.user_id") == F.col("c.user_id"))


@query("pf02_null_default_inequality")
def _(w: Loaded):
    new, old = F.col("s.phone"), F.col("c.phone")
    return _user_pairs(w).select(
        "s.user_id", scd2.differs(new, old, "").alias("differs_null_as_empty"),
        (~new.eqNullSafe(old)).alias("differs_null_safe"))


@query("pf03_plain_inequality")
def _(w: Loaded):
    kind = scd2.differs(F.col("s.user_type"), F.col("c.user_type"))
    phone = scd2.differs(F.col("s.phone"), F.col("c.phone"))
    return _user_pairs(w).select("s.user_id", kind.alias("type_differs"),
                                 phone.alias("phone_differs"))


@query("pf04_change_predicate")
def _(w: Loaded):
    return _user_pairs(w).select("s.user_id", scd2.changed(scd2.USERS).alias("changed"))


@query("pf05_eligible_bookings")
def _(w: Loaded):
    rows = w.staged_bookings.where(F.col("booking_status").isin("confirmed", "completed"))
    return rows.select("booking_id", "booking_status", "total_price")


@query("pf11_change_types")
def _(w: Loaded):
    return history.user_history(w.users).groupBy("change_type").agg(
        F.count("*").alias("versions"), F.sum("days_valid").alias("days_valid"))


@query("jn05_host_of_property")
def _(w: Loaded):
    return scd2.with_current_host(w.source.staged("tb_property", 2), w.hosts).select(
        "property_id", "host_id", "host_sk")


@query("jn06_latest_closed_version")
def _(w: Loaded):
    return scd2.latest_version(w.properties.where("not is_current"), "property_id")


@query("jn07_users_without_row")
def _(w: Loaded):
    return w.source.staged("tb_user", 2).join(w.users_1.snapshot, "user_id", "left_anti").select(
        "user_id", "full_name")


@query("jn08_users_with_row")
def _(w: Loaded):
    return w.source.staged("tb_user", 2).join(w.users_1.snapshot, "user_id", "left_semi").select(
        "user_id", "full_name")


@query("ag02_distinct_bookings_by_place")
def _(w: Loaded):
    return reports.revenue_by_place(w.bookings, w.properties, unique_bookings=False)


@query("ag06_booking_span")
def _(w: Loaded):
    return w.bookings.agg(F.count("*").alias("bookings"),
                          F.min("checkin_date_sk").alias("first_checkin"),
                          F.max("checkout_date_sk").alias("last_checkout"))


@query("ag08_bookings_per_user")
def _(w: Loaded):
    return metrics.bookings_per(w.staged_bookings, "user_id")


@query("ag09_paid_per_user")
def _(w: Loaded):
    return metrics.paid_per(w.staged_payments, "user_id")


@query("ag10_amount_totals")
def _(w: Loaded):
    return metrics.amount_totals(w.staged_payments)


@query("ag11_rows_affected")
def _(w: Loaded):
    dims = {"dim_users": w.users, "dim_hosts": w.hosts, "dim_properties": w.properties}
    tallies = [history.merge_tally(rows).select(
        F.when(F.col("batch_ts") == moment(BATCH_1), 1).otherwise(2).alias("batch"),
        F.lit(name).alias("table_name"), "rows_updated", "rows_inserted", "rows_affected")
        for name, rows in dims.items()]
    return reduce(DataFrame.unionByName, tallies)


@query("sl04_exact_sample")
def _(w: Loaded):
    rows = w.source.raw("orders").select((F.col("o_orderkey") + 1).alias("booking_id"))
    n = rows.agg(F.floor(F.count("*") / 5).alias("n")).scalar()
    return generate.sample(rows, n, "booking_id", 42)


@query("sf09_date_parts")
def _(w: Loaded):
    d = F.col("checkin_date")
    return w.staged_bookings.select(
        "booking_id", dates.date_key(d).alias("date_key"), F.quarter(d).alias("quarter"),
        dates.us_week(d).alias("us_week"), F.dayofweek(d).alias("weekday"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.left(F.date_format(d, "EEEE"), F.lit(3)).alias("day_abbreviation"),
        F.last_day(d).alias("month_end"), dates.week_of_month(d).alias("week_of_month"),
        dates.fiscal_year(d).alias("fiscal_year"),
        dates.fiscal_quarter(d).alias("fiscal_quarter"),
        dates.days_between(F.col("created_date"), d).alias("lead_days"),
        F.date_add(d, 7).alias("a_week_later"))


@query("sf04_fee_rounding")
def _(w: Loaded):
    a = F.col("amount")
    return w.staged_payments.select(
        "payment_id", money.share(a, money.FEE_SHARE, "decimal(10,2)").alias("fee_amount"),
        money.share(a, money.NET_SHARE).alias("net_amount"))


@query("sf03_attribute_hash")
def _(w: Loaded):
    return w.source.staged("tb_user", 2, True).selectExpr(
        "user_id", f"{text.attribute_hash(scd2.USERS.hashed)} AS attribute_hash",
        f"{text.attribute_hash(scd2.USERS.hashed, '|')} AS delimited_hash",
        f"{text.short_id('usr', 'user_id')} AS short_id", "concat_ws(', ', city, country) AS place")


@query("sf20_tags")
def _(w: Loaded):
    tags = F.split("_amenities", ",")
    return (_gen_properties(w).select("property_id", F.explode(tags).alias("amenity"))
            .groupBy("amenity").agg(F.count("*").alias("properties")))


# ---- merges and histories -----------------------------------------------------------


# The merge queries run both merges anew; the others share the merged tables.

@query("sc01_merge_users")
def _(w: Loaded):
    return w.second(scd2.USERS, w.first(scd2.USERS)).snapshot


@query("sc02_merge_hosts")
def _(w: Loaded):
    return w.second(scd2.HOSTS, w.first(scd2.HOSTS)).snapshot


@query("sc03_merge_properties")
def _(w: Loaded):
    before = w.first(scd2.PROPERTIES, w.hosts_1.snapshot)
    return w.second(scd2.PROPERTIES, before, w.hosts).snapshot


@query("sc01_reopened_key")
def _(w: Loaded):
    """Versions of users whose last version was closed, as of vip users here."""
    gone = F.col("is_current") & (F.col("user_type") == "vip")
    rows = w.users.withColumn("is_current", F.col("is_current") & ~gone)
    return scd2.merge(rows.where("is_current"), w.source.staged("tb_user", 2), scd2.USERS, LOADED,
                      CREATED_BY, closed=rows.where("not is_current")).inserted


@query("pf02_merge_by_mail_of_any_case")
def _(w: Loaded):
    """Users by mail address; the batch spells some addresses and cities in another way."""
    by_mail = replace(scd2.USERS, key="email")
    batch = w.source.staged("tb_user", 2).withColumns({
        "email": F.expr("if(user_id % 2 = 0, concat(upper(email), '  '), email)"),
        "city": F.expr("if(user_id % 3 = 0, concat(lower(city), ' '), city)")})
    done = scd2.merge(w.users_1.snapshot, batch, by_mail, LOADED, CREATED_BY, ignore_case=True)
    return done.snapshot.select("email", "user_id", "user_type", "country", "city",
                                "version_number", "is_current")


def _preview(w: Loaded, dim: scd2.Dimension, before: scd2.Merge, action: str) -> DataFrame:
    return scd2.preview(before.snapshot, w.source.staged(dim.staging, 2), dim)[action]


for _name, _dim, _before in (("users", scd2.USERS, "users_1"), ("hosts", scd2.HOSTS, "hosts_1"),
                             ("properties", scd2.PROPERTIES, "properties_1")):
    for _action in ("would_update", "would_insert"):
        query(f"sc04_{_name}_{_action}")(
            lambda w, dim=_dim, before=_before, action=_action:
            _preview(w, dim, getattr(w, before), action))


@query("hi01_user_history")
def _(w: Loaded):
    return history.user_history(w.users)


@query("pf06_history_of_one_user")
def _(w: Loaded):
    most = w.staged_bookings.groupBy("user_id").count().orderBy(F.desc("count"), "user_id")
    return history.user_history(w.users, most.first()["user_id"])


@query("hi02_point_in_time")
def _(w: Loaded):
    return history.as_of(w.staged_bookings.select("booking_id", "user_id", "created_date"),
                         w.users, "user_id", "created_date",
                         ["user_sk", "user_type", "version_number"])


# ---- facts, rejects, previews -------------------------------------------------------


@query("fl01_load_bookings")
def _(w: Loaded):
    return w.load_bookings().accepted


@query("fl02_load_payments")
def _(w: Loaded):
    return w.load_payments().accepted


@query("rv01_load_reviews")
def _(w: Loaded):
    return w.load_reviews().accepted


@query("fl01_bookings_as_of_creation")
def _(w: Loaded):
    return w.load_bookings(version_at="created_date").accepted


def _reject_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(F.col("reject_reason").isNotNull()).select(*columns, "reject_reason")


@query("fl03_booking_rejects")
def _(w: Loaded):
    resolved = facts.resolve_bookings(w.staged_bookings, None, w.users, w.properties, w.dates)
    return _reject_columns(resolved, "booking_id", "user_id", "property_id", "checkin_date")


@query("fl03_payment_rejects")
def _(w: Loaded):
    resolved = facts.resolve_payments(w.staged_payments, None, w.bookings, w.users, w.dates)
    return _reject_columns(resolved, "payment_id", "booking_id", "user_id", "amount")


@query("fl04_bookings_would_insert")
def _(w: Loaded):
    return facts.preview(w.staged_bookings, w.bookings, facts.BOOKINGS)


@query("fl04_payments_would_insert")
def _(w: Loaded):
    return facts.preview(w.staged_payments, w.payments, facts.PAYMENTS)


@query("st01_streamed_bookings")
def _(w: Loaded):
    folder = scratch_path(w.spark, "arriving")
    w.staged_bookings.write.parquet(folder)
    run = _run_on(w)
    stream_fact(run, "fact_bookings", folder,
                scratch_path(w.spark, "stream")).awaitTermination()
    return run.store.read("fact_bookings").drop("booking_sk")


def _run_on(w: Loaded) -> Run:
    """A run over a store that holds the merged dimensions and the calendar."""
    run = Run(_store(w), "loader", lambda: LOADED)
    for table, rows, key in (("dim_users", w.users, "user_id"),
                             ("dim_properties", w.properties, "property_id")):
        run.store.merge(table, rows, key, 1, LOADED, 0)
    run.store.append("dim_dates", w.dates, 1, LOADED)
    return run


def _with_copies(rows: DataFrame, column: str) -> DataFrame:
    """Every row, its repetition, and a copy of it that differs in ``column``."""
    kind = rows.schema[column].dataType
    return rows.unionByName(rows).unionByName(
        rows.withColumn(column, (F.col(column) + 1).cast(kind)))


@query("fl01_reload_with_duplicates")
def _(w: Loaded):
    """Completed bookings, then all of them; either load holds copies of every row."""
    run, first = _run_on(w), F.col("booking_status") == "completed"
    for rows in (w.staged_bookings.where(first), w.staged_bookings):
        run.load_fact("fact_bookings", staged=_with_copies(rows, "number_of_guests"))
    return run.store.read("fact_bookings")


@query("fl02_reload")
def _(w: Loaded):
    """Paid payments, then all of them; either load holds copies of every row."""
    run, first = _run_on(w), F.col("payment_status") == "paid"
    run.store.append("fact_bookings", w.bookings, 2, LOADED)
    for rows in (w.staged_payments.where(first), w.staged_payments):
        run.load_fact("fact_payments", staged=_with_copies(rows, "installments"))
    return run.store.read("fact_payments")


@query("fl05_reload_tally")
def _(w: Loaded):
    """What two overlapping loads with copies report, and the rejects they keep."""
    run, first = _run_on(w), F.col("booking_status") == "completed"
    parts = []
    for batch, rows in ((1, w.staged_bookings.where(first)), (2, w.staged_bookings)):
        done = run.load_fact("fact_bookings", staged=_with_copies(rows, "number_of_guests"))
        kept = run.store.read_rejects("fact_bookings", "tb_booking").where(
            F.col("batch_id") == done["batch_id"])
        parts.append(kept.agg(F.count("*").alias("rejects_kept")).select(
            F.lit(batch).alias("load"), *[F.lit(done[n]).cast("bigint").alias(n) for n in (
                "rows_loaded", "rows_rejected", "rows_skipped", "rows_affected")],
            "rejects_kept"))
    return reduce(DataFrame.unionByName, parts)


@query("st02_two_micro_batches")
def _(w: Loaded):
    """Completed bookings arrive, then copies of all bookings with one more guest."""
    run = _run_on(w)
    folder, checkpoint = scratch_path(w.spark, "arriving"), scratch_path(w.spark, "stream")
    more = w.staged_bookings.withColumn(
        "number_of_guests", (F.col("number_of_guests") + 1).cast("smallint"))
    for rows in (w.staged_bookings.where("booking_status = 'completed'"), more):
        rows.write.mode("append").parquet(folder)
        stream_fact(run, "fact_bookings", folder, checkpoint).awaitTermination()
    return run.store.read("fact_bookings").drop("booking_sk")


# ---- metrics, audit, logs -----------------------------------------------------------


@query("um01_user_metrics")
def _(w: Loaded):
    run = Run(_store(w), "loader", lambda: LOADED)
    run.store.merge("dim_users", w.users, "user_id", 1, LOADED, 0)
    for table, rows in (("fact_bookings", w.bookings), ("fact_payments", w.payments)):
        run.store.append(table, rows, 2, LOADED)
    run.update_user_metrics()
    return run.store.read_current("dim_users").select(
        "user_sk", "user_id", "total_bookings", "total_spent", "version_number")


@query("um01_staged_user_metrics")
def _(w: Loaded):
    return metrics.with_metrics(w.source.staged("tb_user", 2, True).select("user_id"),
                                w.staged_bookings, w.staged_payments)


@query("hm01_host_metrics")
def _(w: Loaded):
    return metrics.host_listings(w.source.staged("tb_host", 2),
                                 w.source.staged("tb_property", 2)).select(
        "host_id", "total_listings")


@query("dq_warehouse_audit")
def _(w: Loaded):
    return quality.audit(w.tables, quality.RULES, with_declared=False)


@query("dq10_audit_by_batches")
def _(w: Loaded):
    """Facts in two batches, audited after each; payments of the first have later bookings."""
    run = Run(_store(w), "loader", lambda: LOADED)
    for table, rows, key in (("dim_users", w.users, "user_id"), ("dim_hosts", w.hosts, "host_id"),
                             ("dim_properties", w.properties, "property_id")):
        run.store.merge(table, rows, key, 1, LOADED, 0)
    run.store.append("dim_dates", w.dates, 1, LOADED)
    for batch, odd in ((2, 0), (3, 1)):
        for table, rows, key in (("fact_bookings", w.bookings, "booking_id"),
                                 ("fact_payments", w.payments, "payment_id"),
                                 ("dim_reviews", w.reviews, "review_id")):
            run.store.append(table, rows.where(f"{key} % 2 = {odd}"), batch, LOADED)
        lines = run.audit(with_declared=False)
    return lines


@query("dq14_declared_audit")
def _(w: Loaded):
    rules = {t: [] for t in quality.RULES}
    return quality.audit(w.tables, rules, with_declared=True)


def _staging_tables(w: Loaded) -> dict[str, DataFrame]:
    return {"tb_user": w.source.staged("tb_user", 2, True),
            "tb_host": w.source.staged("tb_host", 2),
            "tb_property": w.source.staged("tb_property", 2), "tb_booking": w.staged_bookings,
            "tb_payment": w.staged_payments, "tb_review": w.staged_reviews}


@query("dq13_staging_audit")
def _(w: Loaded):
    return quality.audit(_staging_tables(w), quality.STAGING_RULES, with_declared=False)


@query("dq14_staging_audit")
def _(w: Loaded):
    tables = _staging_tables(w)
    return quality.audit(tables, {t: [] for t in tables}, with_declared=True)


@query("dq19_over_capacity")
def _(w: Loaded):
    return quality.over_capacity(w.staged_bookings, w.source.staged("tb_property", 2))


def _event_log(w: Loaded) -> DataFrame:
    """Every event as one batch of the log: its type is the table, its time the start."""
    e, start = F.col("event_id"), F.date_trunc("second", "ts").cast("timestamp_ntz")
    return w.source.raw("events").select(
        e.alias("batch_id"), F.col("event_type").alias("table_name"),
        F.when(e % 2 == 0, audit.MERGE).otherwise(audit.LOAD).alias("operation_type"),
        F.col("user_id").alias("rows_affected"), start.alias("start_time"),
        (start + F.make_dt_interval(secs=(e % 600).cast("decimal(18,6)"))).alias("end_time"),
        F.lit("loader").alias("created_by"), start.alias("created_at"))


@query("lg03_etl_summary")
def _(w: Loaded):
    return audit.etl_summary(_event_log(w), AS_OF, 7)


@query("lg04_error_summary")
def _(w: Loaded):
    at = F.date_trunc("second", "ts").cast("timestamp_ntz")
    errors = w.source.raw("events").where("event_type = 'error'").select(
        F.col("event_id").cast("string").alias("error_id"), F.col("user_id").alias("batch_id"),
        F.lit(0).alias("error_number"), F.lit("load").alias("error_procedure"),
        F.col("props").alias("error_message"), at.alias("error_timestamp"),
        F.lit("loader").alias("created_by"))
    return audit.error_summary(errors, AS_OF, 7)


@query("lg01_batch_log_of_full_load")
def _(w: Loaded):
    """Staging, merges, facts and metrics through a store, as its batch log tells it."""
    run, src = Run(_store(w), "loader", lambda: LOADED), w.source
    run.run({"users": src.users(2, True), "hosts": src.hosts(2),
             "properties": src.properties(2), "bookings": src.bookings(),
             "payments": src.payments(), "reviews": src.reviews()})
    return run.etl_summary().select("batch_id", "table_name", "operation_type", "rows_affected",
                                    "start_time", "duration_seconds", "created_by")


@query("lg02_failures")
def _(w: Loaded):
    """The error log after a failed staging and a failed merge, and what they left behind."""
    run, users = _run_on(w), w.source.users(2, True)
    run.store.merge("dim_users", w.users, "user_id", 2, LOADED, 0)
    for work in (lambda: run.stage({"users": users.unionByName(users)}),
                 lambda: run.merge_dimension("dim_users")):
        try:
            work()
        except ValueError:
            continue
    kept = run.store.read("tb_user").agg(F.count("*").alias("n")).scalar()
    return run.error_summary().select("error_procedure", "error_number", "error_message",
                                      "error_timestamp", kept.alias("staged_rows"))


@query("pl02_steps_alone")
def _(w: Loaded):
    """Merges as a dry run, then by themselves, loads without metrics: the log of each step."""
    run, src = Run(_store(w), "loader", lambda: LOADED), w.source
    run.run({"users": src.users(2, True), "hosts": src.hosts(2)}, merge=False, load=False,
            refresh_metrics=False)
    run.merge_all()
    run.load_all()
    run.run(merge=True, load=False, refresh_metrics=False)
    run.run(merge=False, load=False, refresh_metrics=True)
    again = run.populate_dates()
    return run.etl_summary().select("batch_id", "table_name", "operation_type", "rows_affected",
                                    F.lit(again).alias("calendar_written_again"))


# ---- reports ------------------------------------------------------------------------


@query("rp01_daily_revenue")
def _(w: Loaded):
    return reports.daily_revenue(w.bookings, w.dates)


@query("rp01_daily_revenue_per_year")
def _(w: Loaded):
    return reports.daily_revenue(w.bookings, w.dates, reset="year")


@query("rp02_top10_properties")
def _(w: Loaded):
    return reports.top_properties(w.bookings, w.properties)


@query("rp03_cancellation_rate")
def _(w: Loaded):
    return reports.cancellation_rate(w.bookings, w.properties)


def _bookings_on_first_versions(w: Loaded) -> DataFrame:
    resolved = facts.resolve_bookings(w.staged_bookings, None, w.users,
                                      w.properties_1.snapshot, w.dates)
    return resolved.where(F.col("reject_reason").isNull())


@query("rp03_superseded_versions_dropped")
def _(w: Loaded):
    return reports.cancellation_rate(_bookings_on_first_versions(w), w.properties)


@query("rp03_superseded_versions_repointed")
def _(w: Loaded):
    return reports.cancellation_rate(_bookings_on_first_versions(w), w.properties, repoint=True)


@query("rp04_current_counts")
def _(w: Loaded):
    return reports.row_counts({t: df for t, df in w.tables.items() if t != "dim_dates"})


# ---- generated tables ---------------------------------------------------------------


def _gen_users(w: Loaded) -> DataFrame:
    return generate.users(w.source.raw("customer").select((F.col("c_custkey") + 1).alias("id")))


def _gen_properties(w: Loaded) -> DataFrame:
    parts = w.source.raw("part").select((F.col("p_partkey") + 1).alias("id"))
    return generate.properties(parts, _count(w.source.raw("supplier")))


def _gen_bookings(w: Loaded) -> DataFrame:
    orders = w.source.raw("orders").select((F.col("o_orderkey") + 1).alias("id"))
    return generate.bookings(orders, _count(w.source.raw("customer")), _gen_properties(w),
                             _count(w.source.raw("part")))


@query("gn01_users")
def _(w: Loaded):
    return _gen_users(w)


@query("gn02_hosts")
def _(w: Loaded):
    return generate.hosts(_gen_users(w), _count(w.source.raw("supplier")))


@query("gn03_properties")
def _(w: Loaded):
    return _gen_properties(w)


@query("gn04_bookings")
def _(w: Loaded):
    return _gen_bookings(w)


@query("gn05_payments")
def _(w: Loaded):
    most = w.source.raw("orders").agg(F.floor(F.count("*") * 3 / 5).alias("n")).scalar()
    return generate.payments(_gen_bookings(w), most)


@query("gn06_reviews")
def _(w: Loaded):
    return generate.reviews(_gen_bookings(w))


@query("gn07_clickstream")
def _(w: Loaded):
    events = w.source.raw("events").select((F.col("event_id") + 1).alias("id"))
    return generate.clickstream(events, _count(w.source.raw("customer")),
                                _count(w.source.raw("part")))


@query("gn08_sensitive")
def _(w: Loaded):
    return generate.sensitive(w.source.raw("customer").select(
        (F.col("c_custkey") + 1).alias("id")))


@query("gn_status_shares")
def _(w: Loaded):
    return _gen_bookings(w).groupBy("booking_status").agg(F.count("*").alias("bookings"))
