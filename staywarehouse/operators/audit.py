"""Batch log and error log rows, and the look-back summaries over them."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import days_before, moment, seconds_between
from ..schemas import one_row, schema

MERGE, LOAD = "MERGE_SCD2", "LOAD"


def batch_entry(spark: SparkSession, batch_id: int, table: str, operation: str,
                rows_affected: int, start: datetime, end: datetime,
                created_by: str) -> DataFrame:
    row = (batch_id, table, operation, rows_affected, start.replace(microsecond=0),
           end.replace(microsecond=0), created_by, end.replace(microsecond=0))
    return one_row(spark, schema("etl_batch_log"), row)


def error_entry(spark: SparkSession, batch_id: int | None, procedure: str, error: Exception,
                at: datetime, created_by: str) -> DataFrame:
    """One error as a log row; the Spark error class leads the message where there is one.

    Server error numbers have no counterpart: number, severity and state stay 0, 16 and 1,
    those of a user-raised error.
    """
    condition = getattr(error, "getCondition", lambda: None)()
    line, trace = None, error.__traceback__
    while trace is not None:
        line, trace = trace.tb_lineno, trace.tb_next
    text = f"[{condition}] {error}" if condition else f"{type(error).__name__}: {error}"
    row = (uuid.uuid4().hex, batch_id, 0, 16, 1, line, procedure, text,
           at.replace(microsecond=0), created_by)
    return one_row(spark, schema("etl_error_log"), row)


def _since(column: str, as_of: datetime, days_back: int) -> Column:
    return F.col(column) >= days_before(moment(as_of), days_back)


def etl_summary(batch_log: DataFrame, as_of: datetime, days_back: int = 7) -> DataFrame:
    """Batches started in the last ``days_back`` days with their duration, newest first."""
    return (batch_log.where(_since("start_time", as_of, days_back))
            .select("batch_id", "table_name", "operation_type", "rows_affected",
                    "start_time", "end_time",
                    seconds_between(F.col("start_time"), F.col("end_time"))
                    .alias("duration_seconds"), "created_by")
            .orderBy(F.col("start_time").desc(), F.col("batch_id").desc()))


def error_summary(error_log: DataFrame, as_of: datetime, days_back: int = 7) -> DataFrame:
    """Errors of the last ``days_back`` days, newest first."""
    return (error_log.where(_since("error_timestamp", as_of, days_back))
            .select("error_id", "batch_id", "error_number", "error_procedure",
                    "error_message", "error_timestamp", "created_by")
            .orderBy(F.col("error_timestamp").desc(), F.col("error_id").desc()))
