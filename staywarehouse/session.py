"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: How written tables are compressed: their keys in hexadecimal take about half of what Spark's
#: default leaves of them.
CODEC = "zstd"

# Settings the jobs count on; all but the zone are Spark's defaults, stated to be explicit.
SETTINGS = {
    "spark.sql.session.timeZone": "Etc/UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_SHARED_DIR = "spark.checkpoint.dir"


def builder(app: str = "staywarehouse") -> SparkSession.Builder:
    made = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        made = made.config(key, value)
    return made


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own.
    """
    folder = spark.conf.get(_SHARED_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SHARED_DIR} to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="staywarehouse-")
    spark.conf.set(_SHARED_DIR, folder)
    return folder


def kept_once(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, and where it lies."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete one scratch table that no later read needs; other paths are refused."""
    if not path.startswith(f"{shared_folder(spark)}/staywarehouse/"):
        raise ValueError(f"{path} is not a scratch table")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_made: ContextVar[list[str] | None] = ContextVar("scratch tables made", default=None)


@contextmanager
def scratch_released(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables made inside once all is done; after a failure they stay."""
    made: list[str] = []
    before = _made.set(made)
    try:
        yield
    finally:
        _made.reset(before)
    for path in made:
        discard(spark, path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one written intermediate table."""
    app = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/staywarehouse/{app}/{label}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path
