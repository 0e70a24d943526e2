"""Row-preserving lookups of fact rows in a table with one row per key.

The fact side may hold a third of its rows under one key. With adaptive skew joins on,
Spark splits such a partition at run time. Without them the hot keys are found by a
map-side combined count and both sides are salted for just these keys. Rows without a key
match nothing and are spread alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# A key counts as hot from this share of the rows on, so there are at most 1/share of them.
HOT_SHARE = 0.005
SALTS = 64


def _adaptive_skew(spark: SparkSession) -> bool:
    keys = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(spark.conf.get(k, "true").lower() == "true" for k in keys)


def salting(spark: SparkSession) -> bool:
    """Whether joins must spread hot keys themselves."""
    return not _adaptive_skew(spark)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's estimate of the size of ``df`` is within its limit for broadcasts."""
    plan = df._jdf.queryExecution().optimizedPlan()
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(plan.stats().sizeInBytes())) <= limit


def lookup(rows: DataFrame, table: DataFrame, key: str, how: str = "left",
           salted: bool | None = None) -> DataFrame:
    """Join ``rows`` with ``table``, unique on ``key``, whatever the skew of ``rows``."""
    if salted is None:
        salted = salting(rows.sparkSession)
    return salted_lookup(rows, table, key, how) if salted else rows.join(table, key, how)


def within(table: DataFrame, rows: DataFrame, key: str,
           ends: tuple[object, object] | None = None) -> DataFrame:
    """The rows of ``table`` whose ``key`` lies in the range of keys in ``rows``.

    Other rows match nothing. The two ends, if they are not given, are read first, as one row, so
    that they reach the scan as literals: of a table written in key order only the files a batch
    can touch are read.
    """
    low, high = ends or rows.agg(F.min(key), F.max(key)).first()
    if low is None:
        return table.where("false")
    return table.where(F.col(key).between(low, high))


def hot_keys(rows: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """The keys holding more than ``share`` of the rows: fewer than 1/share rows."""
    per_key = rows.groupBy(key).agg(F.count("*").alias("_n"))
    total = rows.agg(F.count("*").alias("_total")).scalar()
    return per_key.where(F.col(key).isNotNull() & (F.col("_n") > total * F.lit(share)))


def salted_lookup(rows: DataFrame, table: DataFrame, key: str, how: str = "left",
                  salts: int = SALTS, share: float = HOT_SHARE) -> DataFrame:
    """Spread each hot key over ``salts`` groups; its one table row is repeated as often."""
    left, right = salted_sides(rows, table, key, salts, share)
    return left.join(right, [key, "_salt"], how).drop("_salt")


def salted_sides(rows: DataFrame, table: DataFrame, key: str, salts: int = SALTS,
                 share: float = HOT_SHARE) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on ``key`` with a ``_salt`` to join on as well."""
    hot = hot_keys(rows, key, share).agg(F.collect_set(key).alias("_hot")).scalar()
    # the input partition takes part so that copies of one row spread as well
    spread = F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), F.lit(salts)).cast("int")
    wide = F.col(key).isNull() | F.array_contains(hot, F.col(key))
    left = rows.withColumn("_salt", F.when(wide, spread).otherwise(F.lit(0)))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    one = F.array(F.lit(0))
    right = table.withColumn("_salt", F.explode(
        F.when(F.array_contains(hot, F.col(key)), every).otherwise(one)))
    return left, right
