"""Operations by name, each with a dry run that writes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.history import user_history
from .full_load import Run

PREVIEW_ROWS = 5

# name -> (what it does, whether it has a dry run)
OPERATIONS = {
    "merge_dim_users": (lambda run, dry, **k: run.merge_dimension("dim_users", dry, **k), True),
    "merge_dim_hosts": (lambda run, dry, **k: run.merge_dimension("dim_hosts", dry, **k), True),
    "merge_dim_properties": (
        lambda run, dry, **k: run.merge_dimension("dim_properties", dry, **k), True),
    "load_fact_bookings": (lambda run, dry, **k: run.load_fact("fact_bookings", dry, **k), True),
    "load_fact_payments": (lambda run, dry, **k: run.load_fact("fact_payments", dry, **k), True),
    "load_dim_reviews": (lambda run, dry, **k: run.load_fact("dim_reviews", dry, **k), True),
    "update_user_metrics": (lambda run, dry, **k: run.update_user_metrics(), False),
    "get_user_history": (
        lambda run, dry, user_id: user_history(run.store.read("dim_users"), user_id), False),
    "get_etl_summary": (lambda run, dry, days_back=7: run.etl_summary(days_back), False),
    "get_error_summary": (lambda run, dry, days_back=7: run.error_summary(days_back), False),
}


def execute(run: Run, name: str, dry_run: bool = False, **parameters):
    """Run an operation by name; reports take parameters and no dry run."""
    if name not in OPERATIONS:
        raise KeyError(f"unknown operation {name}; known: {', '.join(sorted(OPERATIONS))}")
    action, previews = OPERATIONS[name]
    if dry_run and not previews:
        raise ValueError(f"{name} has no dry run")
    return action(run, dry_run, **parameters)


def preview(run: Run, name: str, **parameters) -> dict[str, DataFrame]:
    """The first rows of each result set of a dry run."""
    sets = execute(run, name, dry_run=True, **parameters)
    return {action: df.limit(PREVIEW_ROWS) for action, df in sets.items()}
