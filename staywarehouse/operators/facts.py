"""Insert-only fact loads: key lookups, explicit rejects and previews.

A load resolves every staged row once into ``resolved`` form: the surrogate keys found, and
a ``reject_reason`` naming the lookups that failed. Rows with a reason are rejects, the
others are numbered and appended. Staged rows whose business key is already loaded are left
out first, so running a load again adds nothing; of copies of a key within the batch the first
counts, and the others are skipped like those of an earlier batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from ..functions.dates import moment
from ..functions.money import FEE_SHARE, NET_SHARE, share
from ..schemas import enforce
from .calendar import with_date_key
from .history import as_of
from .keys import Profile, materialise, number
from .lookup import fits_broadcast, lookup, within


@dataclass(frozen=True)
class Fact:
    table: str
    staging: str
    surrogate: str
    order: str
    dedupe: tuple[str, ...]
    preview: tuple[str, ...]


# Tables, business keys and preview columns of the fact loads.
BOOKINGS = Fact("fact_bookings", "tb_booking", "booking_sk", "booking_id", ("booking_id",),
                ("booking_id", "booking_uuid", "user_id", "property_id", "checkin_date",
                 "checkout_date", "total_price", "booking_status"))
PAYMENTS = Fact("fact_payments", "tb_payment", "payment_sk", "payment_id", ("transaction_id",),
                ("payment_id", "transaction_id", "booking_id", "user_id", "amount",
                 "payment_status", "payment_date"))
REVIEWS = Fact("dim_reviews", "tb_review", "review_sk", "review_id", ("review_id",),
               ("review_id", "booking_id", "user_id", "property_id", "overall_rating",
                "review_date"))

FACTS = {f.table: f for f in (BOOKINGS, PAYMENTS, REVIEWS)}


@dataclass
class Load:
    accepted: DataFrame
    rejects: DataFrame
    rows_loaded: int
    rows_rejected: int
    last_key: int


#: Where a staged row came from, for those that tell: it orders copies of a key.
ARRIVAL = "_arrival"


#: Repeated keys of a batch up to this number are broadcast, so that its other rows stay in place.
FEW_KEYS = 10_000


#: Gives the loaded rows that may hold any of the keys (second) of a column (first).
Holding = Callable[[str, DataFrame], DataFrame]


def first_of_key(rows: DataFrame, key: str) -> DataFrame:
    """One row for each value of ``key``: the first to arrive, or else the least by its columns.

    Keys that repeat are counted first, by the key alone (texts by their hash, so keys whose hashes
    meet may be looked at as well). A batch without any is left as it is; of a few, only their rows
    are shuffled and sorted whole; of more, all rows are, once. The first ones of every task come
    before the others. Rows without the key stay.
    """
    columns = [c for c in rows.columns if c != ARRIVAL]
    order = [ARRIVAL, *columns] if ARRIVAL in rows.columns else columns
    known = F.col(key).isNotNull()
    plain = rows.schema[key].dataType == T.StringType()
    mark = F.xxhash64(key) if plain else F.col(key)
    repeated = (rows.where(known).groupBy(mark.alias("_mark")).agg(F.count("*").alias("_n"))
                .where("_n > 1"))
    found = repeated.count()
    if not found:
        return rows
    if found > FEW_KEYS:
        copies, others = rows.where(known), rows.where(~known)
    else:
        few = F.broadcast(repeated.select("_mark"))
        hit = known & (mark == F.col("_mark"))
        copies, others = rows.join(few, hit, "left_semi"), rows.join(few, hit, "left_anti")
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    first = copies.withColumn("_place", place).where("_place = 1")
    return others.select(rows.columns).union(first.select(rows.columns))


def not_loaded(staged: DataFrame, loaded: DataFrame | None, keys: tuple[str, ...],
               order: str, ends: Profile | None = None,
               holding: Holding | None = None) -> DataFrame:
    """Staged rows none of whose ``keys`` occurs in the loaded fact, one for each key.

    The fact is written in order of ``order``, so by that key only the files in the range of
    the batch are read (``ends``, if known). By any other key those batches of the fact are read
    that ``holding`` cannot rule out (default: all), one column of them; by a batch small enough to
    broadcast the fact is first reduced to its keys, which spares the fact a shuffle.
    """
    rows = staged
    for key in keys:
        rows = first_of_key(rows, key)
    rows = rows.drop(ARRIVAL)
    if loaded is not None:
        for key in keys:
            if key == order:
                known = within(loaded, staged, key, _ends(ends, key))
            else:
                known = loaded if holding is None else holding(key, staged.select(key))
            found = known.select(key)
            if fits_broadcast(staged.select(key)):
                found = found.join(staged.select(key), key, "left_semi")
            rows = rows.join(found, key, "left_anti")
    return rows


def _ends(profile: Profile | None, key: str) -> tuple[object, object] | None:
    return (profile.low, profile.high) if profile is not None and profile.key == key else None


def preview(staged: DataFrame, loaded: DataFrame | None, fact: Fact) -> DataFrame:
    """Rows a load would consider, before any lookup: the real load may reject some."""
    return not_loaded(staged, loaded, fact.dedupe, fact.order).select(
        F.lit("would_insert").alias("action"), *fact.preview)


def _dimension_key(rows: DataFrame, versions: DataFrame, key: str, surrogate: str,
                   moment: str | None) -> DataFrame:
    if moment is not None:
        return as_of(rows, versions, key, moment, [surrogate])
    return lookup(rows, versions.where("is_current").select(key, surrogate), key)


def _with_reason(rows: DataFrame, failures: dict[str, Column]) -> DataFrame:
    reasons = F.concat_ws(",", *[F.when(test, F.lit(name)) for name, test in failures.items()])
    return rows.withColumn("reject_reason", F.when(reasons != "", reasons))


def resolve_bookings(staged: DataFrame, loaded: DataFrame | None, users: DataFrame,
                     properties: DataFrame, calendar: DataFrame,
                     version_at: str | None = None, ends: Profile | None = None) -> DataFrame:
    """Staged bookings with user, property and the three calendar keys.

    Dimension rows are the current ones, or with ``version_at`` the versions valid at that
    column of the booking.
    """
    rows = not_loaded(staged, loaded, BOOKINGS.dedupe, BOOKINGS.order, ends)
    rows = _dimension_key(rows, users, "user_id", "user_sk", version_at)
    rows = _dimension_key(rows, properties, "property_id", "property_sk", version_at)
    for role in ("checkin", "checkout", "created"):
        rows = with_date_key(rows, f"{role}_date", f"{role}_date_sk", calendar)
    return _with_reason(rows, {
        "unknown_user": F.col("user_sk").isNull(),
        "unknown_property": F.col("property_sk").isNull(),
        "checkin_date_out_of_calendar": F.col("checkin_date_sk").isNull(),
        "checkout_date_out_of_calendar": F.col("checkout_date_sk").isNull(),
        "created_date_out_of_calendar": F.col("created_date_sk").isNull(),
    })


def resolve_payments(staged: DataFrame, loaded: DataFrame | None, bookings: DataFrame,
                     users: DataFrame, calendar: DataFrame, version_at: str | None = None,
                     also_payment_id: bool = False, ends: Profile | None = None,
                     holding: Holding | None = None) -> DataFrame:
    """Staged payments with booking, user and calendar keys, fee and net amount.

    Fee and net are rounded one by one, so they may not add up to the amount.
    """
    keys = (*PAYMENTS.dedupe, "payment_id") if also_payment_id else PAYMENTS.dedupe
    rows = not_loaded(staged, loaded, keys, PAYMENTS.order, ends, holding)
    booked = within(bookings.select("booking_id", "booking_sk"), staged, "booking_id")
    rows = lookup(rows, booked, "booking_id")
    rows = _dimension_key(rows, users, "user_id", "user_sk", version_at)
    rows = with_date_key(rows, "payment_date", "payment_date_sk", calendar)
    rows = (rows.withColumn("fee_amount", share(F.col("amount"), FEE_SHARE, "decimal(10,2)"))
            .withColumn("net_amount", share(F.col("amount"), NET_SHARE)))
    return _with_reason(rows, {
        "unknown_booking": F.col("booking_sk").isNull(),
        "unknown_user": F.col("user_sk").isNull(),
        "payment_date_out_of_calendar": F.col("payment_date_sk").isNull(),
    })


def resolve_reviews(staged: DataFrame, loaded: DataFrame | None, users: DataFrame,
                    properties: DataFrame, calendar: DataFrame,
                    version_at: str | None = None, ends: Profile | None = None) -> DataFrame:
    rows = not_loaded(staged, loaded, REVIEWS.dedupe, REVIEWS.order, ends)
    rows = _dimension_key(rows, users, "user_id", "user_sk", version_at)
    rows = _dimension_key(rows, properties, "property_id", "property_sk", version_at)
    rows = with_date_key(rows, "review_date", "review_date_sk", calendar)
    return _with_reason(rows, {
        "unknown_user": F.col("user_sk").isNull(),
        "unknown_property": F.col("property_sk").isNull(),
        "review_date_out_of_calendar": F.col("review_date_sk").isNull(),
    })


def rejects(resolved: DataFrame, staged_columns: list[str]) -> DataFrame:
    return resolved.where(F.col("reject_reason").isNotNull()).select(
        *staged_columns, "reject_reason")


def load(resolved: DataFrame, fact: Fact, staged_columns: list[str], batch_ts: datetime,
         start_key: int = 0, ranges: Profile | None = None) -> Load:
    """Write the resolved rows once, then number the accepted ones and keep the rejects.

    ``ranges`` of the staged order key spare a second run of the lookups; the rows are counted
    while they are written.
    """
    split = resolved.withColumn("_accepted", F.col("reject_reason").isNull())
    seen = Observation()
    written = materialise(split, [fact.order], fact.table, "_accepted", ranges, (seen, {
        "loaded": F.count_if("_accepted"), "rejected": F.count_if(~F.col("_accepted"))}))
    loaded, rejected = seen.get["loaded"], seen.get["rejected"]
    numbered = number(written.where("_accepted"), fact.surrogate, start_key)
    accepted = enforce(numbered, fact.table, {"created_at": moment(batch_ts)})
    return Load(accepted, rejects(written.where(~F.col("_accepted")), staged_columns),
                loaded, rejected, start_key + loaded)
