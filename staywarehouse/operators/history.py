"""Version histories and point-in-time lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import days_between
from .lookup import fits_broadcast


def user_history(users: DataFrame, user_id: int | None = None) -> DataFrame:
    """Versions with change type, previous values and days of validity, newest first.

    Without ``user_id`` the histories of all users. A window group is one user's versions,
    of which each merge adds at most one.
    """
    if user_id is not None:
        users = users.where(F.col("user_id") == user_id)
    line = Window.partitionBy("user_id").orderBy("valid_from", "version_number")
    change = (F.when(F.col("version_number") == 1, "INSERT")
              .when(F.col("is_current"), "CURRENT").otherwise("UPDATE"))
    rows = users.select(
        "user_sk", "user_id", "full_name", "email", "user_type", "country", "city",
        "valid_from", "valid_to", "is_current", "version_number",
        change.alias("change_type"),
        F.lag("user_type").over(line).alias("previous_user_type"),
        F.lag("country").over(line).alias("previous_country"),
        days_between(F.col("valid_from"), F.col("valid_to")).alias("days_valid"))
    if user_id is not None:
        return rows.orderBy(F.col("valid_from").desc(), F.col("version_number").desc())
    return rows


def valid_at(moment: Column, valid_from: Column, valid_to: Column) -> Column:
    """Versions are valid from ``valid_from`` up to, not including, ``valid_to``."""
    return (valid_from <= moment) & (moment < valid_to)


def as_of(rows: DataFrame, versions: DataFrame, key: str, moment: str,
          columns: list[str]) -> DataFrame:
    """Left join ``rows`` with the version of ``key`` valid at column ``moment``.

    Versions that fit a broadcast are joined on the key, the validity range being a residual test
    over the few versions of that key: the rows are not moved. Others are carried forward.
    """
    if not fits_broadcast(versions.select(key, "valid_from", "valid_to", *columns)):
        return carried(rows, versions, key, moment, columns)
    v = versions.select(F.col(key).alias("_key"), F.col("valid_from").alias("_from"),
                        F.col("valid_to").alias("_to"), *columns)
    test = (F.col(key) == F.col("_key")) & valid_at(
        F.col(moment).cast("timestamp_ntz"), F.col("_from"), F.col("_to"))
    return rows.join(v, test, "left").drop("_key", "_from", "_to")


def slices(rows: DataFrame, key: str, at: str, parts: int) -> dict[int, list]:
    """Bounds in time for the keys that fill more than one of ``parts`` ranges of the rows.

    A quantile sketch of the (whole-number) key names a key once for each range that it ends, so
    there are fewer than ``parts`` such keys and bounds; a sketch of the times of these keys alone
    cuts each into as many slices as it fills ranges.
    """
    shares = [i / parts for i in range(1, parts)]
    accuracy = max(10_000, 10 * parts)
    ends = rows.agg(F.percentile_approx(key, shares, accuracy)).first()[0] if shares else None
    often = {k: n for k in set(ends or ()) if (n := ends.count(k)) > 1}
    if not often:
        return {}
    found = (rows.where(F.col(key).isin(list(often))).groupBy(F.col(key).alias("k"))
             .agg(F.percentile_approx(at, shares, accuracy).alias("times")).collect())
    chosen = {}
    for r in found:
        n = often[r.k] + 1
        chosen[r.k] = sorted({r.times[len(r.times) * i // n] for i in range(1, n)})
    return chosen


def carried(rows: DataFrame, versions: DataFrame, key: str, moment: str,
            columns: list[str], parts: int | None = None) -> DataFrame:
    """``as_of`` by one pass over rows and versions together, in order of key and time.

    Every row takes the last version before it, if that is still valid. A key that fills more than
    one of ``parts`` ranges (default: shuffle partitions) is cut into slices of time of like
    size, and a version goes to every slice that its validity meets, so it stands before the
    rows of a slice that begins later. So no key is the work of one task, and a row is not
    compared with all versions of its key. Rows without key or moment are not moved.
    """
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    at, kind, cut, version = "_as_of_at", "_as_of_kind", "_as_of_slice", "_as_of_version"
    timed = rows.withColumn(at, F.col(moment).cast("timestamp_ntz"))
    whole = F.col(key).isNotNull() & F.col(at).isNotNull()
    bounds = slices(timed.where(whole), key, at, parts)

    def slice_of(time: Column) -> Column:
        """How many bounds of its key a time has reached."""
        out = F.lit(0)
        for k, own in bounds.items():
            reached = F.size(F.filter(F.array(*[F.lit(b) for b in own]), lambda b: b <= time))
            out = F.when(F.col(key) == k, reached).otherwise(out)
        return out

    left = timed.where(whole).withColumns({kind: F.lit(1), cut: slice_of(F.col(at))})
    right = versions.where(F.col(key).isNotNull()).select(
        key, F.col("valid_from").alias(at), F.lit(0).alias(kind),
        F.explode(F.sequence(slice_of(F.col("valid_from")), slice_of(F.col("valid_to")))).alias(cut),
        F.struct(F.col("valid_to").alias("_to"), *columns).alias(version))
    line = (Window.partitionBy(key, cut).orderBy(at, kind)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = left.unionByName(right, allowMissingColumns=True).withColumn(
        version, F.last(version, ignorenulls=True).over(line)).where(F.col(kind) == 1)
    valid = F.col(at) < F.col(f"{version}._to")
    found = last.select(*rows.columns, *[
        F.when(valid, F.col(f"{version}.{c}")).alias(c) for c in columns])
    kinds = {f.name: f.dataType for f in versions.schema}
    none = timed.where(~whole).select(*rows.columns, *[
        F.lit(None).cast(kinds[c]).alias(c) for c in columns])
    return found.unionByName(none)


def merge_tally(versions: DataFrame) -> DataFrame:
    """What every merge did to a dimension, by batch time, from its versions alone.

    A replaced key counts twice as affected: its old version closes, its new one is inserted.
    """
    events = versions.select(F.inline(F.array(
        F.struct(F.col("valid_from").alias("batch_ts"), F.lit(0).alias("_closed")),
        F.struct(F.when(~F.col("is_current"), F.col("valid_to")).alias("batch_ts"),
                 F.lit(1).alias("_closed")))))
    return (events.where(F.col("batch_ts").isNotNull()).groupBy("batch_ts")
            .agg(F.sum("_closed").cast("bigint").alias("rows_updated"),
                 F.count_if(F.col("_closed") == 0).alias("rows_inserted"),
                 F.count("*").alias("rows_affected")))
