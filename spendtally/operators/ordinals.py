"""Ordinals without a sort of everything, or of a whole group, in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import shared_checkpoint

# 16**3 buckets: about 25,000 names per bucket in a pool of 100 million.
BUCKET_HEX_DIGITS = 3


def dense_ordinals(pool: DataFrame, col: str, out: str = "ordinal") -> DataFrame:
    """Number distinct values 0..P-1 in (digest bucket, value) order.

    Values are distinct, so their digests spread evenly over the buckets; only
    the bucket sizes (at most 4,096 rows) are accumulated in one place.
    """
    b = pool.select(col).distinct().withColumn(
        "_b", F.substring(F.md5(F.col(col).cast("binary")), 1, BUCKET_HEX_DIGITS))
    sizes = b.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rn = F.row_number().over(Window.partitionBy("_b").orderBy(col))
    return (
        b.withColumn("_rn", rn).join(F.broadcast(offsets), "_b")
        .select(col, (F.col("_off") + F.col("_rn") - 1).cast("bigint").alias(out))
    )


def range_ordinals(df: DataFrame, group: str, order: str, out: str = "place", parts: int | None = None) -> DataFrame:
    """Number the rows of each group 0, 1, ... in the order of a column; equal orders come in any order.

    Rows are dealt by ranges of (group, order) and written with their range, so a
    group of any size lies in many ranges.  A range is numbered by itself; what goes
    before it in its group is a running sum over one row per group and range.  A null
    group is a group too.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, F.col(group).asc_nulls_first(), F.col(order).asc_nulls_first())
    # the bounds are drawn from a sample, so the ranges must not be dealt twice
    dealt = shared_checkpoint(dealt.withColumn("_range", F.spark_partition_id()))
    sizes = dealt.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(group).alias("_g"), F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    own = F.row_number().over(Window.partitionBy(group, "_range").orderBy(F.col(order).asc_nulls_first()))
    same = F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r"))
    return dealt.withColumn("_own", own).join(offsets, same).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_off") + F.col("_own") - 1).cast("bigint").alias(out))
