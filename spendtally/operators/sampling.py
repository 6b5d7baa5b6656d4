"""Seeded draws without replacement, one draw per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordinals import dense_ordinals


def hash60(*parts) -> Column:
    """60-bit integer from an MD5 over ``|``-joined parts; the same on every run and engine."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _number(value: int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def draw_ordinals(seed: int | Column, row_key, size, k: int | Column) -> Column:
    """``min(k, size)`` distinct ordinals below ``size``, every subset equally likely.

    Floyd's method (Bentley and Floyd, CACM 1987): for j = size-k .. size-1 take
    a random t <= j, or j itself when t is already drawn.
    """
    first = F.greatest(size - _number(k), F.lit(0)).cast("bigint")

    def step(acc, j):
        t = F.pmod(hash60(_number(seed), row_key, j), j + 1).cast("bigint")
        return F.concat(acc, F.array(F.when(F.array_contains(acc, t), j).otherwise(t)))

    drawn = F.aggregate(F.sequence(first, (size - 1).cast("bigint")),
                        F.array().cast("array<bigint>"), step)
    return F.when(size <= 0, F.array().cast("array<bigint>")).otherwise(drawn)


def sample_candidates(
    inputs: DataFrame,
    pool: DataFrame,
    id_cols: Sequence[str],
    name: str,
    truth: str,
    negative: str,
    candidate: str = "candidate",
    k: int | Column = 20,
    seed: int | Column = 42,
    draw_cols: Sequence[str] = (),
) -> DataFrame:
    """Offer rows ``(id_cols, draw_cols, name, candidate, cand_ord)``.

    Each input gets ``k`` others drawn from the pool (truth excluded); a
    positive row also gets its truth.  ``cand_ord`` is the seeded shuffle order
    within the offer.  Cost is O(inputs * k): ordinals are drawn by arithmetic
    and looked up with one equi-join, so the pool is never paired with the
    inputs.  Several draws are one table: ``k`` and ``seed`` may be columns, and
    ``draw_cols`` tell the draws of a row apart without changing them.
    """
    numbered = dense_ordinals(pool.where(F.trim(candidate) != ""), candidate)
    pool_size = numbered.agg(F.count(F.lit(1))).scalar()
    row_key = F.concat_ws("|", *[F.col(c).cast("string") for c in [*id_cols, name]])
    ids = [*id_cols, *draw_cols, name]
    n = int(inputs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = (
        inputs.select(*ids, truth, negative)
        .join(numbered.select(F.col(candidate).alias(truth), F.col("ordinal").alias("_truth_ord")),
              truth, "left")
        # a row opens into k: spread rows evenly, whatever their size or truth
        .repartition(n, *id_cols, *draw_cols)
        .withColumn("_key", row_key)
        .withColumn("_size", pool_size - F.when(F.col("_truth_ord").isNull(), 0).otherwise(1))
        .withColumn("_draw", draw_ordinals(seed, F.col("_key"), F.col("_size"), k))
    )
    others = (
        base.select(*ids, "_key", "_truth_ord", F.explode_outer("_draw").alias("_o")).where("_o is not null")
        # ordinals skip over the truth's own place
        .withColumn("ordinal", F.when(F.col("_o") >= F.col("_truth_ord"), F.col("_o") + 1)
                    .otherwise(F.col("_o")))
        .join(numbered, "ordinal").select(*ids, "_key", candidate)
    )
    truths = base.where(~F.col(negative)).select(*ids, "_key", F.col(truth).alias(candidate))
    return others.unionByName(truths).select(
        *ids, candidate, hash60(_number(seed), F.lit("shuffle"), F.col("_key"), F.col(candidate)).alias("cand_ord"))
