"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def settled(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read again.

    Later steps restart from the files, so a lost executor costs only the step that it worked on.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def reachable(spark: SparkSession) -> SparkSession:
    """``spark``, whose Python workers also look for this package where the driver has it.

    For a package that is on disk but not installed; on a cluster install it, or use --py-files.
    """
    here, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    path = known.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if here not in path.split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join([here, *filter(None, [path])])
    return spark
