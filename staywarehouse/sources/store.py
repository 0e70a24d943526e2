"""Parquet tables that change by whole batches.

Parquet has no MERGE, so a batch writes its files into a directory of its own and then one
commit row saying which directories the table gained and lost. Readers see the directories
of the committed rows only: a batch that fails before its commit row leaves the table as it
was. Directories being read are never overwritten. One writer per table is assumed.

A merge writes the rows that it changes and no others: the versions that it closes, and current
rows that take the place of earlier ones with the same key. Readers leave out what was replaced,
by an anti-join with the keys of the later current rows. When these outgrow a share of the table
(``FOLD_SHARE``), the next merge writes all current rows once and the count begins anew.

``<root>/data/<table>/batch_id=<n>[/is_current=<bool>]`` holds rows, ``<root>/commits/<table>``
the commit rows, ``<root>/sketches/<table>/batch_id=<n>`` the filter of a batch's key column (see
``sketch``). Paths may be on any file system Spark can write to.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..schemas import empty, nullable, one_row, schema
from ..session import CODEC
from . import sketch

Verify = Callable[[DataFrame, DataFrame | None], None]

#: A merge that would bring the replaced rows above this share of the current ones, or the batches
#: with replacing rows above this number, writes all current rows.
FOLD_SHARE, FOLD_BATCHES = 0.1, 64

_COMMIT = T.StructType([
    T.StructField("batch_id", T.LongType()), T.StructField("table_name", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("added", T.ArrayType(T.StringType())),
    T.StructField("removed", T.ArrayType(T.StringType())),
    T.StructField("row_count", T.LongType()), T.StructField("last_key", T.LongType()),
    T.StructField("batch_ts", T.StringType()),
    # of a merge: its key, the current rows after it, those that it replaces without removing them
    T.StructField("key_column", T.StringType()), T.StructField("current_rows", T.LongType()),
    T.StructField("replaced", T.LongType()),
    # blocks of the batch's filter; the micro-batch that it came from
    T.StructField("blocks", T.LongType()), T.StructField("source", T.StringType())])


@dataclass(frozen=True)
class State:
    """What the commit rows of a table add up to; their number is the number of batches."""

    paths: tuple[str, ...] = ()
    last_batch: int = 0
    last_key: int = 0
    last_merge_ts: datetime | None = None
    batches: tuple[int, ...] = ()
    key: str | None = None
    current_rows: int | None = None
    replaced: int = 0
    overlays: tuple[str, ...] = ()
    rows: int = 0
    blocks: dict[str, int] = field(default_factory=dict)
    sources: dict[str, int] = field(default_factory=dict)
    replaced_at: int = 0

    def folds(self, replaced: int) -> bool:
        """Whether a merge that replaces so many rows should write all current rows."""
        return (not self.current_rows or len(self.overlays) >= FOLD_BATCHES
                or self.replaced + replaced > FOLD_SHARE * self.current_rows)


def _current(path: str) -> bool:
    return path.endswith("/is_current=true")


def counted(df: DataFrame, **counts: str) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of ``rows`` and of what else to count, for one write of it.

    Observed where the rows are written and not before a shuffle, so that a stage which runs
    again after an executor is lost does not count twice.
    """
    seen = Observation()
    more = [F.expr(test).alias(name) for name, test in counts.items()]
    return df.observe(seen, F.count("*").alias("rows"), *more), seen


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._states: dict[str, State] = {}

    def _base(self, table: str) -> str:
        return f"{self.root}/data/{table}"

    def _commits(self, table: str) -> str:
        return f"{self.root}/commits/{table}"

    def refresh(self) -> None:
        """Look again for commits made through other store objects."""
        self._states.clear()

    def state(self, table: str) -> State:
        """The state as of the first look at the table or the last commit made here."""
        if table not in self._states:
            self._states[table] = self._read_state(table)
        return self._states[table]

    def _read_state(self, table: str) -> State:
        reader = self.spark.read.schema(_COMMIT)
        try:
            rows = sorted(reader.json(self._commits(table)).collect(),
                          key=lambda row: row["batch_id"])
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return State()
        paths: dict[str, None] = {}
        made: dict = {"blocks": {}, "sources": {}, "rows": 0}
        overlays: dict[str, None] = {}
        for row in rows:
            for path in row["removed"] or ():
                paths.pop(path, None)
                overlays.pop(path, None)
                made["blocks"].pop(path, None)
            paths.update(dict.fromkeys(row["added"] or ()))
            made["rows"] = row["row_count"] + (0 if row["operation"] == "replace"
                                               else made["rows"])
            if row["operation"] == "replace":
                made["replaced_at"] = row["batch_id"]
            if row["operation"] == "merge":
                made["last_merge_ts"] = datetime.fromisoformat(row["batch_ts"])
            if row["operation"] in ("merge", "metrics"):
                made["key"], made["current_rows"] = row["key_column"], row["current_rows"]
                if row["replaced"]:
                    overlays.update(dict.fromkeys(filter(_current, row["added"] or ())))
                made["replaced"] = (made.get("replaced", 0) + row["replaced"]
                                    if row["replaced"] is not None else 0)
            if row["blocks"] is not None:
                made["blocks"].update(dict.fromkeys(row["added"] or (), row["blocks"]))
            if row["source"] is not None:
                made["sources"][row["source"]] = row["batch_id"]
        if not rows:
            return State()
        return State(paths=tuple(paths), last_batch=rows[-1]["batch_id"],
                     last_key=max(r["last_key"] for r in rows),
                     batches=tuple(r["batch_id"] for r in rows), overlays=tuple(overlays), **made)

    def read(self, table: str) -> DataFrame:
        """The committed rows with the declared schema; an unknown table is empty."""
        state = self.state(table)
        if state.overlays:
            return self.read_closed(table).unionByName(self.read_current(table))
        return self._read(table, state.paths)

    def read_closed(self, table: str) -> DataFrame:
        paths = [p for p in self.state(table).paths if p.endswith("/is_current=false")]
        return self._read(table, paths)

    def read_current(self, table: str) -> DataFrame:
        """The current rows: of every key those of the last batch that has it."""
        state = self.state(table)
        base = [p for p in state.paths if _current(p) and p not in state.overlays]
        if not state.overlays:
            return self._read(table, base)
        declared = schema(table).fieldNames()
        over = self._read(table, state.overlays, "batch_id")
        last = over.groupBy(state.key).agg(F.max("batch_id").alias("_last"))
        # A batch without replaced rows may come after one with some: only new keys are in it.
        kept = self._read(table, base).join(last, state.key, "left_anti")
        newest = over.join(last, state.key).where("batch_id = _last")
        return kept.select(*declared).unionByName(newest.select(*declared))

    def _read(self, table: str, paths: Iterable[str], *more: str) -> DataFrame:
        declared = schema(table)
        if not paths:
            return empty(self.spark, declared)
        base = self._base(table)
        rows = (self.spark.read.schema(nullable(declared)).option("basePath", base)
                .parquet(*[f"{base}/{p}" for p in paths]))
        return rows.select(*declared.fieldNames(), *more)

    def holding(self, table: str, column: str, keys: DataFrame) -> DataFrame:
        """The rows of all batches but those whose filter rejects every key in ``keys``.

        Filters are tested first where that is less work than comparing the keys with the rows.
        """
        state = self.state(table)
        filters = {int(p.removeprefix("batch_id=")): n for p, n in state.blocks.items()}
        if not filters or keys.count() * len(filters) > state.rows:
            return self.read(table)
        root = f"{self.root}/sketches/{table}"
        held = self.spark.read.option("basePath", root).parquet(
            *[f"{root}/batch_id={b}" for b in filters])
        hits = {r.batch_id for r in sketch.passed(keys, column, held, filters).collect()}
        return self._read(table, [p for p in state.paths if p not in state.blocks
                                  or int(p.removeprefix("batch_id=")) in hits])

    def read_batches(self, table: str, batches: Iterable[int]) -> DataFrame:
        """The rows that some batches of a table without merges brought."""
        wanted = {f"batch_id={b}" for b in batches}
        return self._read(table, [p for p in self.state(table).paths if p in wanted])

    def batch_rows(self, table: str, batch_id: int) -> int:
        """The rows that one batch brought."""
        return self._read(table, [f"batch_id={batch_id}"]).count()

    def is_empty(self, table: str) -> bool:
        return self.read(table).isEmpty()

    def _commit(self, table: str, batch_id: int, operation: str, added: list[str],
                removed: list[str], row_count: int, last_key: int, batch_ts: datetime,
                **more: object) -> None:
        row = (batch_id, table, operation, added, removed, row_count, last_key,
               batch_ts.isoformat(), *[more.get(f.name) for f in _COMMIT[8:]])
        one_row(self.spark, _COMMIT, row).write.mode("append").json(self._commits(table))
        self._states.pop(table, None)

    def append(self, table: str, df: DataFrame, batch_id: int, batch_ts: datetime,
               last_key: int | None = None, verify: Verify | None = None,
               filtered: str | None = None, source: str | None = None) -> int:
        """Write ``df`` as one batch, with a filter of its column ``filtered`` if one is named.

        ``source`` names the micro-batch that the rows are, by which a replay is recognised.
        """
        return self._put(table, df, batch_id, batch_ts, last_key, False, verify, filtered, source)

    def replace(self, table: str, df: DataFrame, batch_id: int, batch_ts: datetime,
                last_key: int | None = None, verify: Verify | None = None,
                filtered: str | None = None) -> int:
        """Truncate and load: the former directories leave the table in the same commit."""
        return self._put(table, df, batch_id, batch_ts, last_key, True, verify, filtered)

    def _put(self, table: str, df: DataFrame, batch_id: int, batch_ts: datetime,
             last_key: int | None, truncate: bool, verify: Verify | None,
             filtered: str | None = None, source: str | None = None) -> int:
        """Write, let ``verify`` raise on the new rows and those before, then commit."""
        before = self.state(table)
        if batch_id in before.batches:
            raise ValueError(f"{table}: batch {batch_id} is already committed")
        path = f"batch_id={batch_id}"
        df, seen = counted(df)
        df.write.mode("overwrite").parquet(f"{self._base(table)}/{path}", compression=CODEC)
        rows = seen.get["rows"]
        removed = list(before.paths) if truncate else []
        if verify is not None:
            earlier = self._read(table, before.paths) if before.paths and not truncate else None
            verify(self._read(table, [path]), earlier)
        blocks = sketch.blocks_for(rows) if filtered else None
        if filtered:
            sketch.build(self._read(table, [path]), filtered, blocks).write.mode(
                "overwrite").parquet(f"{self.root}/sketches/{table}/{path}", compression=CODEC)
        self._commit(table, batch_id, "replace" if truncate else "append", [path], removed,
                     rows, before.last_key if last_key is None else last_key, batch_ts,
                     blocks=blocks, source=source)
        return rows

    def merge(self, table: str, snapshot: DataFrame, key: str, batch_id: int,
              batch_ts: datetime, last_key: int, operation: str = "merge",
              replaced: int | None = None) -> None:
        """Commit a merge; the closed rows of ``snapshot`` are added.

        Its current rows are all there are, or, if ``replaced`` is given, they take the place of
        so many earlier ones with the same ``key``.
        """
        before, path = self.state(table), f"batch_id={batch_id}"
        rows, seen = counted(snapshot.hint("rebalance", "is_current"),
                             current="count_if(is_current)")
        rows.write.mode("overwrite").partitionBy("is_current").parquet(
            f"{self._base(table)}/{path}", compression=CODEC)
        total, current = seen.get["rows"], seen.get["current"]
        added = [f"{path}/is_current={name}" for name, n in
                 (("true", current), ("false", total - current)) if n]
        if replaced is None:
            removed, now = [p for p in before.paths if _current(p)], current
        else:
            removed, now = [], (before.current_rows or 0) + current - replaced
        self._commit(table, batch_id, operation, added, removed, total, last_key, batch_ts,
                     key_column=key, current_rows=now, replaced=replaced)

    def create(self, table: str) -> bool:
        """Register an empty table unless it exists."""
        if self.state(table).batches:
            return False
        self._commit(table, 0, "create", [], [], 0, 0, datetime(1970, 1, 1))
        return True

    def write_rejects(self, table: str, rejects: DataFrame, batch_id: int) -> None:
        """Keep the rejected staging rows of one load with their reasons."""
        rejects.write.mode("overwrite").parquet(
            f"{self.root}/rejects/{table}/batch_id={batch_id}", compression=CODEC)

    def read_rejects(self, table: str, staging_table: str | None = None) -> DataFrame:
        """Rejected rows of all loads, told apart by ``batch_id``.

        Rows that a fact load rejects again are there once for each load, the highest
        ``batch_id`` being the latest; those of a failed load may be among them. Without
        ``staging_table`` the rejects of a staging load, as JSON in ``raw``.
        """
        rows = (nullable(schema(staging_table)) if staging_table
                else [T.StructField("raw", T.StringType())])
        fields = T.StructType([*rows, T.StructField("reject_reason", T.StringType()),
                               T.StructField("batch_id", T.LongType())])
        try:
            return self.spark.read.schema(fields).parquet(f"{self.root}/rejects/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty(self.spark, fields)

    def log(self, table: str, entry: DataFrame) -> None:
        """Append to an operation log; a log row is its own commit."""
        entry.write.mode("append").parquet(f"{self.root}/logs/{table}")

    def read_log(self, table: str) -> DataFrame:
        declared = nullable(schema(table))
        try:
            return self.spark.read.schema(declared).parquet(f"{self.root}/logs/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty(self.spark, declared)

    def last_batch_id(self) -> int:
        """The highest batch id logged or committed for any table."""
        known = [self.read_log(t).agg(F.max("batch_id")).first()[0] or 0
                 for t in ("etl_batch_log", "etl_error_log")]
        reader = self.spark.read.schema(_COMMIT)
        try:
            known.append(reader.json(f"{self.root}/commits/*")
                         .agg(F.max("batch_id")).first()[0] or 0)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        return max(known)
