"""Cleaning, typing and loading of staging tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

from .. import schemas as S
from ..functions.dates import moment
from ..functions.text import null_token, repair_guid
from ..operators.lookup import within
from ..operators.quality import require_unique
from .store import Store


def prune(df: DataFrame) -> DataFrame:
    """Drop helper columns (leading underscore) and columns the warehouse adds itself."""
    extra = [c for c in df.columns if c.startswith("_") or c in S.WAREHOUSE_ONLY]
    return df.drop(*extra) if extra else df


def clean(df: DataFrame, key: str) -> DataFrame:
    """Repair GUID columns, turn null tokens in texts and NaN in floats into NULL."""
    out = []
    for field in df.schema:
        name, kind = field.name, field.dataType
        if name in S.GUID_COLUMNS:
            out.append(f"{repair_guid(name, key)} AS {name}")
        elif isinstance(kind, T.StringType):
            out.append(f"{null_token(name)} AS {name}")
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            out.append(f"nanvl({name}, null) AS {name}")
        else:
            out.append(name)
    return df.selectExpr(*out)


def prepare(df: DataFrame, table: str, loaded_at: datetime) -> DataFrame:
    """A generated or external frame as a typed staging frame; a bad value is an error."""
    ready = clean(prune(df), S.STAGING_KEYS[table])
    return S.enforce(ready, table, {"loaded_at": moment(loaded_at)})


def sorted_out(df: DataFrame, table: str, loaded_at: datetime) -> DataFrame:
    """Typed rows with ``reject_reason``, NULL for good rows, and ``raw``, the row as given.

    A row is bad if a value does not fit the declared type, if a required value is missing, or
    if a text is longer than declared.
    """
    ready = clean(prune(df), S.STAGING_KEYS[table])
    given, filled = set(ready.columns), {"loaded_at", *S.DEFAULTS.get(table, {})}
    tests = []
    for field in S.schema(table):
        name, kind = field.name, field.dataType.simpleString()
        value = name if name in given else "null"
        if name in given:
            tests.append((f"{name} IS NOT NULL AND try_cast({name} AS {kind}) IS NULL",
                          f"bad_{name}"))
        if not field.nullable and name not in filled:
            tests.append((f"{value} IS NULL", f"missing_{name}"))
        if name in given and (size := S.MAX_LENGTH.get(table, {}).get(name)):
            tests.append((f"length({name}) > {size}", f"long_{name}"))
    reasons = ", ".join(f"if({test}, '{reason}', null)" for test, reason in tests)
    return ready.select(
        *S.typed(ready, table, {"loaded_at": moment(loaded_at)}, safe=True),
        F.expr(f"nullif(concat_ws(',', {reasons}), '') AS reject_reason"),
        F.to_json(F.struct(*ready.columns)).alias("raw"))


def check_keys(df: DataFrame, table: str, earlier: DataFrame | None = None,
               holding: Callable[[str, DataFrame], DataFrame] | None = None) -> None:
    """Raise unless the declared keys are unique in a batch and new to the ``earlier`` rows.

    Only the batch is grouped; the earlier rows are looked through for its keys: those in its
    range, or by another column those that ``holding`` cannot rule out.
    """
    key = S.STAGING_KEYS[table]
    for column in (key, *S.STAGING_UNIQUE.get(table, ())):
        require_unique(df, (column,), table)
        if earlier is not None:
            if column == key:
                known = within(earlier, df, column)
            else:
                known = earlier if holding is None else holding(column, df.select(column))
            if not known.select(column).join(df.select(column), column, "left_semi").isEmpty():
                raise ValueError(f"{table}: {column} is not unique, staged rows have it too")


def load(store: Store, df: DataFrame, table: str, batch_id: int, loaded_at: datetime,
         truncate: bool = False, safe: bool = False) -> int:
    """Clean, type and write one staging table and return the number of rows written.

    Keys must be unique over the whole table; otherwise nothing is committed. A badly typed row
    fails the load, or with ``safe`` goes to the rejects of the table as JSON with its reasons.
    """
    put = store.replace if truncate else store.append
    if safe:
        rows = sorted_out(df, table, loaded_at)
        bad = F.col("reject_reason").isNotNull()
        store.write_rejects(table, rows.where(bad).select("raw", "reject_reason"), batch_id)
        ready = rows.where(~bad).drop("raw", "reject_reason")
    else:
        ready = prepare(df, table, loaded_at)
    return put(table, ready, batch_id, loaded_at,
               verify=lambda rows, earlier: check_keys(
                   rows, table, earlier, lambda column, keys: store.holding(table, column, keys)),
               filtered=next(iter(S.STAGING_UNIQUE.get(table, ())), None))


UNROUTED = {"clickstream"}


def route(frames: dict[str, DataFrame]) -> list[tuple[str, DataFrame]]:
    """(staging table, frame) in load order for the frames that are present.

    Generated tables that no load takes (``UNROUTED``) are left out; a frame of any other name
    is an error.
    """
    if unknown := sorted(set(frames) - set(S.STAGING_ROUTES) - UNROUTED):
        raise ValueError(f"no staging table for {', '.join(unknown)}")
    return [(table, frames[name]) for name, table in S.STAGING_ROUTES.items()
            if frames.get(name) is not None]
