"""Bloom filters of a key column, one for each written batch, as rows.

A filter has one block of 512 bits for every ``KEYS`` keys. The hash of a key names its block, a
second hash sets one bit in each of the eight words there, so a key that the batch does not hold
passes about once in 100,000 times. Filters are built and tested by grouping and joining on the
block; they take about 4 bytes a key, a fraction of the column that they stand for.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

WORDS, KEYS = 8, 16


def blocks_for(rows: int) -> int:
    """The number of blocks of a filter for so many keys."""
    return max(1, -(-rows // KEYS))


def _bits(key: str) -> list[Column]:
    """The bit of ``key`` in each word."""
    return [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(`{key}`, 1), {6 * i}) & 63 "
                   f"AS int)) AS w{i}") for i in range(WORDS)]


def build(rows: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter of the keys of ``rows``: a row for every block that is not empty."""
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")
    words = [F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]
    return (rows.where(F.col(key).isNotNull()).select(block, *_bits(key))
            .groupBy("block").agg(*words))


def passed(rows: DataFrame, key: str, filters: DataFrame, blocks: dict[int, int]) -> DataFrame:
    """The ``batch_id`` of every filter that some key of ``rows`` passes.

    ``filters`` holds the filters of the batches in ``blocks``, which says how many blocks each
    of them has. Every key is tested in one block of every batch.
    """
    every = F.array(*[F.struct(F.lit(b).cast("long").alias("batch_id"),
                               F.lit(n).cast("long").alias("blocks")) for b, n in blocks.items()])
    once = rows.where(F.col(key).isNotNull()).select(
        F.xxhash64(key).alias("_hash"), *_bits(key)).distinct()
    tests = once.select("*", F.inline(every)).withColumn("block", F.expr("pmod(_hash, blocks)"))
    held = filters.select("batch_id", "block", *[F.col(f"w{i}").alias(f"h{i}")
                                                 for i in range(WORDS)])
    hit = reduce(and_, [F.expr(f"h{i} & w{i} = w{i}") for i in range(WORDS)])
    return tests.join(held, ["batch_id", "block"]).where(hit).select("batch_id").distinct()
