"""Dense surrogate keys without a single-task window.

Rows are range partitioned and sorted by their business key and written once to the shared
folder. The files then hold consecutive ranges in order, so a row's number is the count of
rows in earlier files plus its position in its own file. Only one count per file is ever
ordered globally. The written table also cuts the lineage: a lost executor re-reads files.

Spark finds ranges by a sample of the rows, for which it runs all that the rows come from once
more. Where they come from staged rows, a profile of the staged key (one pass over one column)
gives the ranges instead, and the joins behind the rows run once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import batched
from math import isqrt

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..schemas import nullable
from ..session import CODEC, scratch_path

#: Rows of a range, about; there are no more ranges than shuffle partitions.
RANGE_ROWS = 100_000


@dataclass(frozen=True)
class Profile:
    """Rows of a batch, the ends of its whole-number key, and bounds of ranges of like size."""

    key: str
    rows: int
    low: int | None
    high: int | None
    bounds: tuple[int, ...] = ()

    def range_of(self) -> Column:
        """The number of the range that the key lies in: the bounds that it reaches, counted.

        They are searched in two steps, over runs of bounds and within one.
        """
        if not self.bounds:
            return F.lit(0)
        step = isqrt(len(self.bounds)) + 1
        runs = list(batched(self.bounds, step))
        key = F.col(self.key)

        def reached(bounds: Column) -> Column:
            return F.size(F.filter(bounds, lambda b: b <= key))

        run = reached(F.array(*[F.lit(r[0]).cast("long") for r in runs[1:]])) \
            if runs[1:] else F.lit(0)
        every = F.array(*[F.array(*[F.lit(b).cast("long") for b in r]) for r in runs])
        return F.coalesce(run * step + reached(F.get(every, run)), F.lit(0))


def profile(rows: DataFrame, key: str) -> Profile:
    """Count, ends and quantiles of ``key``, in one pass that combines sketches of each task."""
    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / most for i in range(1, most)]
    bounds = F.percentile_approx(key, shares, max(10_000, 10 * most)) if shares else F.lit(None)
    got = rows.agg(F.count("*"), F.min(key), F.max(key), bounds).first()
    wanted = min(most, -(-got[0] // RANGE_ROWS))
    every = got[3] or []
    chosen = {int(every[len(every) * i // wanted]) for i in range(1, wanted)} if every else set()
    return Profile(key, got[0], got[1], got[2], tuple(sorted(chosen)))


def materialise(df: DataFrame, order_by: Sequence[str], label: str,
                split_by: str | None = None, ranges: Profile | None = None,
                seen: tuple[Observation, dict[str, Column]] | None = None) -> DataFrame:
    """Write ``df`` in key order, optionally split by a boolean column, and read it back.

    ``ranges`` are those of the first column of ``order_by``. ``seen`` is an observation and what
    it is to count of the written rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    sort = [split_by, *order_by] if split_by else list(order_by)
    if ranges is None:
        dealt = df.repartitionByRange(*order_by)
    else:
        dealt = df.repartitionById(len(ranges.bounds) + 1, ranges.range_of())
    dealt = dealt.sortWithinPartitions(*sort)
    if seen is not None:
        dealt = dealt.observe(seen[0], *[c.alias(name) for name, c in seen[1].items()])
    writer = dealt.write.mode("errorifexists")
    if split_by:
        writer = writer.partitionBy(split_by)
    writer.parquet(path, compression=CODEC)
    return spark.read.schema(nullable(df.schema)).parquet(path)


def number(written: DataFrame, key: str, start: int = 0) -> DataFrame:
    """Add ``key``: start + 1, start + 2, ... in the order ``materialise`` wrote the rows.

    ``written`` may be filtered by its split column, not by others.
    """
    path = F.col("_metadata.file_path")
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int")
    # One row per written file, of which there are no more than ranges: the rows stay where they are.
    files = (written.groupBy(part.alias("_part"), path.alias("_file"))
             .agg(F.count("*").alias("_n")))
    before = Window.orderBy("_part", "_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    placed = written.select("*", path.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return (placed.join(F.broadcast(offsets), "_file")
            .withColumn(key, F.lit(start) + F.col("_base") + F.col("_row") + 1)
            .drop("_file", "_base", "_row"))


def last_key(df: DataFrame, key: str) -> int:
    """The highest key in use, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).alias("last")).first()["last"]
