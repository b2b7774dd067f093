"""Global row numbers and prefix sums without a single-partition sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import materialize


def seeded_hash(key: Column | str, seed: int) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), column.cast("string")))


def hash_rank(
    df: DataFrame, key: str, seed: int = 0, limit: int | None = None, rank: str = "rank"
) -> DataFrame:
    """Number the rows from 1 in a seeded random order; ``key`` must be unique.

    The order is that of ``md5(seed:key)``. Its first three hex digits cut the rows into
    4,096 even buckets: a table of at most 4,096 counts gives the rank at which each
    bucket starts, and rows are sorted within their bucket only. With ``limit``, buckets
    that start beyond it are dropped before the shuffle. ``df`` is read twice, the first
    time for ``key`` alone.
    """
    hashed = df.withColumn("_hash", seeded_hash(key, seed))
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, 3))
    sizes = df.select(F.substring(seeded_hash(key, seed), 1, 3).alias("_bucket"))
    sizes = sizes.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    if limit is not None:
        starts = starts.where(F.col("_start") < limit)
    within = Window.partitionBy("_bucket").orderBy("_hash", key)
    ranked = hashed.join(F.broadcast(starts), "_bucket").withColumn(
        rank, F.col("_start") + F.row_number().over(within)
    )
    if limit is not None:
        ranked = ranked.where(F.col(rank) <= limit)
    return ranked.drop("_hash", "_bucket", "_start")


def running_offsets(
    df: DataFrame, key: str, length: str, offset: str = "offset", buckets: int | None = None
) -> DataFrame:
    """For each ``key``, the sum of ``length`` over all smaller keys; ``key`` must be unique.

    Keys and lengths alone are range-partitioned and written with the number of their
    range. The ranges' totals, one row per range, are summed up and sent to every task;
    the running sum itself stays within a range.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.select(key, length).repartitionByRange(buckets, key)
    ranged = materialize(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("_range").agg(F.sum(length).alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum(length).over(within), F.lit(0))
    placed = ranged.withColumn("_inner", inner).join(F.broadcast(starts), "_range")
    return placed.select(key, (F.col("_start") + F.col("_inner")).cast("bigint").alias(offset))
