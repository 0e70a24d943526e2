"""The load in stages: staging, dimension merges, fact loads, metrics, totals.

Order matters: properties look up hosts, payments look up bookings. Every stage commits by
itself; a failure is written to the error log and raised again.
"""

from __future__ import annotations

import getpass
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import audit, audit_states, facts, metrics, quality, scd2
from ..functions.dates import moment
from ..operators.calendar import FIRST_DAY, LAST_DAY, calendar
from ..operators.keys import Profile, profile
from ..session import kept_once, scratch_released
from ..sources import staging
from ..sources.store import Store, counted

# Merge and load order.
MERGE_ORDER = ("dim_users", "dim_hosts", "dim_properties")
LOAD_ORDER = ("fact_bookings", "fact_payments", "dim_reviews")
#: Tables that only gain rows, audited batch by batch.
GROWING = ("dim_dates", *LOAD_ORDER)


@dataclass
class Run:
    """A run against one store. ``clock`` gives the batch time and the log times."""

    store: Store
    created_by: str = field(default_factory=getpass.getuser)
    clock: Callable[[], datetime] = lambda: datetime.now().replace(microsecond=0)
    _last_batch: int | None = None

    # ---- shared steps -------------------------------------------------------------

    def next_batch_id(self) -> int:
        """One more than the last id; the store is asked once, as a run is its only writer."""
        if self._last_batch is None:
            self._last_batch = self.store.last_batch_id()
        self._last_batch += 1
        return self._last_batch

    @contextmanager
    def errors_logged(self, procedure: str, batch_id: int | None = None) -> Iterator[None]:
        """Write an error log row for what goes wrong inside, then raise it again."""
        try:
            yield
        except Exception as error:
            self.log_error(procedure, error, batch_id)
            raise

    def log_error(self, procedure: str, error: Exception, batch_id: int | None = None) -> None:
        self.store.log("etl_error_log", audit.error_entry(
            self.store.spark, batch_id, procedure, error, self.clock(), self.created_by))

    def _logged(self, table: str, operation: str, procedure: str,
                work: Callable[[int, datetime], dict]) -> dict:
        """Run ``work`` as one batch with a batch log row, or an error log row."""
        spark, store = self.store.spark, self.store
        batch_id, start = self.next_batch_id(), self.clock()
        with self.errors_logged(procedure, batch_id), scratch_released(spark):
            result = work(batch_id, start)
        store.log("etl_batch_log", audit.batch_entry(
            spark, batch_id, table, operation, result["rows_affected"], start, self.clock(),
            self.created_by))
        return {"batch_id": batch_id, **result, "status": "SUCCESS"}

    # ---- calendar and staging -----------------------------------------------------

    def populate_dates(self, first: str = FIRST_DAY, last: str = LAST_DAY) -> bool:
        """Write the calendar unless it has rows."""
        if not self.store.is_empty("dim_dates"):
            return False
        days = calendar(self.store.spark, first, last)
        self.store.append("dim_dates", days.coalesce(1), self.next_batch_id(), self.clock())
        return True

    def stage(self, frames: dict[str, DataFrame], truncate: bool = False,
              safe: bool = False) -> dict[str, int]:
        """Load the given frames (users, hosts, ...) into their staging tables.

        ``safe`` sets badly typed rows aside as rejects instead of failing.
        """
        batch_id, now, done = self.next_batch_id(), self.clock(), {}
        with self.errors_logged("stage", batch_id):
            routed = staging.route(frames)
        for table, df in routed:
            with self.errors_logged(f"stage_{table}", batch_id):
                done[table] = staging.load(self.store, df, table, batch_id, now, truncate, safe)
        return done

    # ---- merges -------------------------------------------------------------------

    def merge_dimension(self, table: str, dry_run: bool = False,
                        ignore_case: bool = False) -> dict:
        """Merge the staged rows, or return the previews and write nothing.

        The rows that the batch changes are written, or all once replaced ones outgrow a share.
        ``ignore_case`` compares texts without regard to case and trailing blanks.
        """
        dim, store = scd2.DIMENSIONS[table], self.store
        staged = store.read(dim.staging)
        if dry_run:
            return scd2.preview(store.read_current(table), staged, dim, ignore_case)

        def work(batch_id: int, now: datetime) -> dict:
            state = store.state(table)
            if state.last_merge_ts is not None and now <= state.last_merge_ts:
                raise ValueError(f"{table}: batch time {now} is not after the last merge")
            closed = store.read_closed(table) if state.paths else None
            enrich = None
            if table == "dim_properties":
                hosts = store.read_current("dim_hosts")

                def enrich(rows: DataFrame) -> DataFrame:
                    return scd2.with_current_host(rows, hosts)
            outcome = scd2.merge(store.read_current(table), staged, dim, now, self.created_by,
                                 closed, state.last_key, enrich, ignore_case, state.folds)
            if outcome.rows_affected:
                store.merge(table, outcome.snapshot, dim.key, batch_id, now, outcome.last_key,
                            replaced=None if outcome.whole else outcome.rows_updated)
            return {"rows_updated": outcome.rows_updated,
                    "rows_inserted": outcome.rows_inserted,
                    "rows_affected": outcome.rows_affected}

        return self._logged(table, audit.MERGE, f"merge_{table}", work)

    def merge_all(self, dry_run: bool = True) -> dict[str, dict]:
        return {table: self.merge_dimension(table, dry_run) for table in MERGE_ORDER}

    # ---- facts --------------------------------------------------------------------

    def _resolve(self, table: str, staged: DataFrame, loaded: DataFrame,
                 version_at: str | None, also_payment_id: bool, ends: Profile) -> DataFrame:
        store, dates = self.store, self.store.read("dim_dates")
        read = store.read if version_at else store.read_current
        if table == "fact_bookings":
            return facts.resolve_bookings(staged, loaded, read("dim_users"),
                                          read("dim_properties"), dates, version_at, ends)
        if table == "fact_payments":
            return facts.resolve_payments(
                staged, loaded, store.read("fact_bookings"), read("dim_users"), dates, version_at,
                also_payment_id, ends, lambda column, keys: store.holding(table, column, keys))
        return facts.resolve_reviews(staged, loaded, read("dim_users"),
                                     read("dim_properties"), dates, version_at, ends)

    def load_fact(self, table: str, dry_run: bool = False, staged: DataFrame | None = None,
                  version_at: str | None = None, also_payment_id: bool = False,
                  source: str | None = None) -> dict:
        """Load one fact from its staging table or a given staged frame.

        ``source`` names the micro-batch that the frame is; it is committed even without rows, so
        that ``replayed`` finds it.
        ``version_at`` names the date whose dimension versions count; ``also_payment_id`` takes
        a repeated payment id for a repeated payment as well.
        """
        fact, store = facts.FACTS[table], self.store
        rows = store.read(fact.staging) if staged is None else staged
        state = store.state(table)
        loaded = store.read(table) if state.paths else None
        if dry_run:
            return {"would_insert": facts.preview(rows, loaded, fact)}

        def work(batch_id: int, now: datetime) -> dict:
            known = profile(rows, fact.order)
            resolved = self._resolve(table, rows, loaded, version_at, also_payment_id, known)
            columns = [c for c in rows.columns if c != facts.ARRIVAL]
            done = facts.load(resolved, fact, columns, now, state.last_key, known)
            if done.rows_rejected:
                store.write_rejects(table, done.rejects, batch_id)
            if done.rows_loaded or source is not None:
                store.append(table, done.accepted, batch_id, now, done.last_key,
                             filtered=next((k for k in fact.dedupe if k != fact.order), None),
                             source=source)
            skipped = known.rows - done.rows_loaded - done.rows_rejected
            return {"rows_loaded": done.rows_loaded, "rows_rejected": done.rows_rejected,
                    "rows_skipped": skipped, "rows_affected": done.rows_loaded}

        return self._logged(table, audit.LOAD, f"load_{table}", work)

    def replayed(self, table: str, source: str) -> dict | None:
        """What is known of a micro-batch that is already committed, None of a new one.

        Where the run ended between the commit and the log row, the row is written now.
        """
        store, now = self.store, self.clock()
        batch_id = store.state(table).sources.get(source)
        if batch_id is None:
            return None
        if store.read_log("etl_batch_log").where(F.col("batch_id") == batch_id).isEmpty():
            loaded = store.batch_rows(table, batch_id)
            store.log("etl_batch_log", audit.batch_entry(
                store.spark, batch_id, table, audit.LOAD, loaded, now, now, self.created_by))
        return {"batch_id": batch_id, "rows_loaded": 0, "rows_affected": 0, "status": "REPLAYED"}

    def load_all(self, dry_run: bool = True) -> dict[str, dict]:
        return {table: self.load_fact(table, dry_run) for table in LOAD_ORDER}

    # ---- metrics and totals -------------------------------------------------------

    def update_user_metrics(self) -> dict:
        """Refresh bookings and spending of the current user rows in place.

        All current rows count as affected; only rows with other figures are written, or all once
        replaced ones outgrow a share.
        """
        store = self.store

        def work(batch_id: int, now: datetime) -> dict:
            figures = metrics.user_metrics(store.read("dim_users"), store.read("fact_bookings"),
                                           store.read("fact_payments"))
            current, state = store.read_current("dim_users"), store.state("dim_users")
            changed, seen = counted(metrics.outdated(current, figures))
            changed, _ = kept_once(changed, "user_metrics")
            if count := seen.get["rows"]:
                whole = state.folds(count)
                rows = metrics.apply_metrics(current, changed, moment(now), self.created_by,
                                             "left" if whole else "inner")
                store.merge("dim_users", rows, "user_id", batch_id, now, state.last_key,
                            "metrics", None if whole else count)
            if state.current_rows is not None:
                return {"rows_affected": state.current_rows}
            return {"rows_affected": current.count()}

        return self._logged("dim_users", "UPDATE_METRICS", "update_user_metrics", work)

    def totals(self) -> DataFrame:
        return metrics.amount_totals(self.store.read("tb_payment"))

    # ---- audit --------------------------------------------------------------------

    def audit(self, with_declared: bool = True) -> DataFrame:
        """Violations of all declared rules: of the facts by their batches, of the rest whole.

        Batches of a fact that no earlier audit saw are read, and what is found in them is kept;
        of earlier ones and of parents the keys are read. Where a table or a parent was truncated,
        or the rules are others, its states begin anew.
        """
        store = self.store
        tables = {t: store.read(t) for t in quality.RULES}
        with self.errors_logged("audit"):
            rules, bases = {}, {}
            for table in GROWING:
                rules[table] = quality.all_rules(table, with_declared)
                links = {r.parent for r in rules[table] if isinstance(r, quality.ReferenceRule)}
                bases[table] = quality.basis(rules[table], [
                    store.state(t).replaced_at for t in sorted({table, *links})])
            known = audit_states.audited(store.read("audit_states"), bases)
            found = []
            for table in GROWING:
                held = {int(p.removeprefix("batch_id=")) for p in store.state(table).paths}
                if new := sorted(held - known[table]):
                    earlier = store.read_batches(table, known[table]) if known[table] else None
                    found.append(audit_states.found(
                        table, bases[table], new, store.read_batches(table, new), earlier,
                        rules[table], tables))
            if found:
                store.append("audit_states", reduce(DataFrame.unionByName, found),
                             self.next_batch_id(), self.clock())
            parts = audit_states.totals(store.read("audit_states"), bases, rules, tables)
        whole = {t: rules for t, rules in quality.RULES.items() if t not in GROWING}
        return reduce(DataFrame.unionByName, [
            *parts, quality.audit(tables, whole, with_declared)])

    # ---- everything ---------------------------------------------------------------

    def run(self, frames: dict[str, DataFrame] | None = None, truncate: bool = False,
            merge: bool = True, load: bool = True, refresh_metrics: bool = True,
            safe: bool = False) -> dict:
        """All stages, or those asked for, in order; returns what each stage did."""
        done: dict = {"dates": self.populate_dates()}
        if frames:
            done["staged"] = self.stage(frames, truncate, safe)
        if merge:
            done["merges"] = self.merge_all(dry_run=False)
        if load:
            done["loads"] = self.load_all(dry_run=False)
        if refresh_metrics:
            done["metrics"] = self.update_user_metrics()
        return done

    # ---- summaries ----------------------------------------------------------------

    def etl_summary(self, days_back: int = 7) -> DataFrame:
        return audit.etl_summary(self.store.read_log("etl_batch_log"), self.clock(), days_back)

    def error_summary(self, days_back: int = 7) -> DataFrame:
        return audit.error_summary(self.store.read_log("etl_error_log"), self.clock(),
                                   days_back)
