"""Parquet snapshots of named frames and the manifest that describes them."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import SEED


def _visible(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def save_snapshot(frames: dict[str, DataFrame], folder: str) -> None:
    """One Parquet table per frame without helper columns."""
    for name, df in frames.items():
        _visible(df).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_snapshot(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder.rstrip('/')}/{n}.parquet") for n in names}


def manifest(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per frame: its name, actual row count, columns and types."""
    def line(name: str, df: DataFrame) -> DataFrame:
        shown = _visible(df)
        return shown.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count",
            F.lit(",".join(shown.columns)).alias("columns"),
            F.lit(",".join(f.dataType.simpleString() for f in shown.schema)).alias("types"))
    return reduce(DataFrame.unionByName, [line(n, df) for n, df in frames.items()])


def save_manifest(frames: dict[str, DataFrame], folder: str, generated_at: datetime,
                  seed: int = SEED) -> DataFrame:
    described = (manifest(frames).withColumn("generated_at", F.lit(generated_at.isoformat()))
                 .withColumn("seed", F.lit(seed)))
    described.coalesce(1).write.mode("overwrite").json(f"{folder.rstrip('/')}/manifest")
    return described
