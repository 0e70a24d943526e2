"""Versioned dimensions (slowly changing, type 2).

A merge first finds the staged rows that need a new version, reading only the key, the
version and the tracked columns of the current rows. Those few rows are written once, get
their surrogate keys, and are then joined back to close the versions they replace. Closed
versions are never rewritten.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from ..functions.dates import moment
from ..functions.text import FOLDED, attribute_hash
from ..schemas import OPEN_END, enforce
from .keys import last_key, materialise, number, profile
from .lookup import lookup


@dataclass(frozen=True)
class Tracked:
    """A column whose change opens a version; ``null_as`` makes NULL equal to that value."""

    column: str
    null_as: object = None


@dataclass(frozen=True)
class Dimension:
    table: str
    staging: str
    key: str
    surrogate: str
    tracked: tuple[Tracked, ...]
    title: str
    preview: tuple[tuple[str, str], ...]
    hashed: tuple[str, ...] = ()


# Tracked columns, hashed columns and preview columns of the dimensions.
USERS = Dimension(
    "dim_users", "tb_user", "user_id", "user_sk",
    (Tracked("user_type"), Tracked("country", ""), Tracked("city", ""), Tracked("phone", "")),
    "full_name", (("user_type", "user_type"), ("city", "city")),
    hashed=("user_type", "country", "city", "phone"))
HOSTS = Dimension(
    "dim_hosts", "tb_host", "host_id", "host_sk",
    (Tracked("is_superhost"), Tracked("response_rate", 0), Tracked("host_location", "")),
    "full_name", (("superhost", "is_superhost"), ("rate", "response_rate")))
PROPERTIES = Dimension(
    "dim_properties", "tb_property", "property_id", "property_sk",
    (Tracked("price_per_night"), Tracked("property_type"), Tracked("city", ""),
     Tracked("accommodates")),
    "title", (("price", "price_per_night"), ("type", "property_type")))

DIMENSIONS = {d.table: d for d in (USERS, HOSTS, PROPERTIES)}


@dataclass
class Merge:
    """Outcome of one merge: ``snapshot`` holds the current rows and those just closed.

    If it is not ``whole``, only those current rows are in it that the merge made.
    """

    snapshot: DataFrame
    inserted: DataFrame
    rows_updated: int
    rows_inserted: int
    last_key: int
    whole: bool = True

    @property
    def rows_affected(self) -> int:
        """A replaced key counts twice: its old version closes, its new one is inserted."""
        return self.rows_updated + self.rows_inserted


def differs(new: Column, old: Column, null_as: object = None,
            ignore_case: bool = False) -> Column:
    """Inequality; NULL never differs unless ``null_as`` says which value it stands for."""
    if null_as is not None:
        new, old = F.coalesce(new, F.lit(null_as)), F.coalesce(old, F.lit(null_as))
    if ignore_case:
        new, old = (F.collate(x.cast("string"), FOLDED) for x in (new, old))
    return new != old


def _is_text(rows: DataFrame, dim: Dimension) -> bool:
    return isinstance(rows.schema[dim.key].dataType, T.StringType)


def _same_key(rows: DataFrame, dim: Dimension, new: str, old: str, ignore_case: bool) -> Column:
    """Equality of the business key; a text is compared like the tracked columns."""
    new, old = F.col(f"{new}.{dim.key}"), F.col(f"{old}.{dim.key}")
    if ignore_case and _is_text(rows, dim):
        new, old = F.collate(new, FOLDED), F.collate(old, FOLDED)
    return new == old


def changed(dim: Dimension, new: str = "s", old: str = "c", ignore_case: bool = False) -> Column:
    """True where any tracked column differs between the aliases ``new`` and ``old``."""
    tests = [differs(F.col(f"{new}.{t.column}"), F.col(f"{old}.{t.column}"), t.null_as,
                     ignore_case and t.null_as != 0) for t in dim.tracked]
    return F.coalesce(reduce(or_, tests), F.lit(False))


def _current_side(current: DataFrame, dim: Dimension) -> DataFrame:
    columns = [dim.key, "version_number", *(t.column for t in dim.tracked)]
    return current.where("is_current").select(*columns).alias("c")


def pending(current: DataFrame, staged: DataFrame, dim: Dimension,
            closed: DataFrame | None = None, ignore_case: bool = False) -> DataFrame:
    """Staged rows that need a version, with ``_replaces`` and the new ``version_number``.

    ``closed`` is needed only where a key may have closed versions and no current one.
    """
    s = staged.alias("s")
    c = _current_side(current, dim)
    pair = s.join(c, _same_key(staged, dim, "s", "c", ignore_case), "left")
    known = F.col(f"c.{dim.key}").isNotNull()
    # A key keeps the spelling of its first version.
    own = [F.coalesce(f"c.{dim.key}", f"s.{dim.key}").alias(dim.key) if name == dim.key
           else F.col(f"s.`{name}`") for name in staged.columns]
    due = pair.where(~known | changed(dim, ignore_case=ignore_case)).select(
        *own, known.alias("_replaces"), F.col("c.version_number").alias("_version"))
    if closed is None:
        return (due.withColumn("version_number", F.coalesce("_version", F.lit(0)) + 1)
                .drop("_version"))
    highest = latest_version(closed, dim.key).withColumnRenamed("version_number", "_highest")
    d, h = due.alias("d"), highest.alias("h")
    own = [F.coalesce(f"h.{dim.key}", f"d.{dim.key}").alias(dim.key) if name == dim.key
           else F.col(f"d.`{name}`") for name in due.columns]
    return (d.join(h, _same_key(staged, dim, "d", "h", ignore_case), "left")
            .select(*own, "h._highest")
            .withColumn("version_number", F.coalesce(
                F.greatest("_version", "_highest"), F.lit(0)) + 1)
            .drop("_version", "_highest"))


def latest_version(versions: DataFrame, key: str) -> DataFrame:
    """The highest version number of every key."""
    return versions.groupBy(key).agg(F.max("version_number").alias("version_number"))


def with_current_host(properties: DataFrame, hosts: DataFrame) -> DataFrame:
    """The current host's surrogate key, -1 for an unknown host."""
    current = hosts.where("is_current").select("host_id", "host_sk")
    found = lookup(properties, current, "host_id")
    return found.withColumn("host_sk", F.coalesce("host_sk", F.lit(-1)))


def preview(current: DataFrame, staged: DataFrame, dim: Dimension,
            ignore_case: bool = False) -> dict[str, DataFrame]:
    """What a merge would do: changed keys with old and new values, and keys to insert."""
    s, c = staged.alias("s"), current.where("is_current").alias("c")
    same = _same_key(staged, dim, "s", "c", ignore_case)
    pairs = [col for name, source in dim.preview
             for col in (F.col(f"s.{source}").alias(f"new_{name}"),
                         F.col(f"c.{source}").alias(f"old_{name}"))]
    update = s.join(c, same).where(changed(dim, ignore_case=ignore_case)).select(
        F.lit("would_update").alias("action"), f"s.{dim.key}", f"s.{dim.title}", *pairs,
        *[F.lit("Attributes changed").alias("reason")] * (dim.key == "user_id"))
    insert = s.join(c, same, "left_anti").select(F.lit("would_insert").alias("action"), "s.*")
    return {"would_update": update, "would_insert": insert}


def merge(current: DataFrame, staged: DataFrame, dim: Dimension, batch_ts: datetime,
          created_by: str, closed: DataFrame | None = None, start_key: int | None = None,
          enrich: Callable[[DataFrame], DataFrame] | None = None,
          ignore_case: bool = False,
          whole: Callable[[int], bool] = lambda replaced: True) -> Merge:
    """Apply one staged batch to a dimension.

    ``current`` holds the current rows. Keys absent from the batch stay as they are, and so
    do keys whose tracked columns are equal, whatever their other attributes say. With
    ``ignore_case`` texts, a business key included, are equal if they differ by case or trailing
    blanks only (a batch holds one spelling of a key). ``whole`` says,
    given the number of replaced rows, whether the snapshot must hold the other current rows.
    """
    if start_key is None:
        start_key = last_key(current, dim.surrogate)
        if closed is not None:
            start_key = max(start_key, last_key(closed, dim.surrogate))
    due = pending(current, staged, dim, closed, ignore_case)
    if enrich is not None:
        due = enrich(due)
    seen = Observation()
    # Ranges of whole numbers are known beforehand; a text is sampled by Spark.
    ranges = None if _is_text(staged, dim) else profile(staged, dim.key)
    due = materialise(due, [dim.key], dim.table, ranges=ranges, seen=(seen, {
        "inserted": F.count("*"), "updated": F.count_if("_replaces")}))
    tally = seen.get

    now = moment(batch_ts)
    computed = {
        "valid_from": now, "valid_to": F.lit(OPEN_END).cast("timestamp_ntz"),
        "is_current": F.lit(True), "created_at": now, "created_by": F.lit(created_by),
    }
    if dim.hashed:
        computed["attribute_hash"] = F.expr(attribute_hash(dim.hashed))
    staged_audit = [c for c in ("valid_from", "valid_to", "is_current", "created_at",
                                "created_by", "updated_at", "updated_by") if c in due.columns]
    fresh = enforce(number(due.drop(*staged_audit), dim.surrogate, start_key),
                    dim.table, computed)

    replaced = due.where("_replaces").select(dim.key, F.lit(True).alias("_closing"))
    closing = F.coalesce("_closing", F.lit(False))
    every = whole(tally["updated"])
    kept = (current.where("is_current").join(replaced, dim.key, "left" if every else "inner")
            .withColumn("is_current", ~closing)
            .withColumn("valid_to", F.when(closing, now).otherwise(F.col("valid_to")))
            .withColumn("updated_at", F.when(closing, now).otherwise(F.col("updated_at")))
            .withColumn("updated_by", F.when(closing, F.lit(created_by))
                        .otherwise(F.col("updated_by"))))
    snapshot = enforce(kept, dim.table).unionByName(fresh)
    return Merge(snapshot, fresh, tally["updated"], tally["inserted"],
                 start_key + tally["inserted"], every)
