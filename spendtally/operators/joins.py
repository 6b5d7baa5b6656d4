"""Small join building blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_text import json_ids
from ..functions.text import trim_all


# Parts that rows without a registration number are dealt into.
NULL_PARTS = 32
# A lookup table of up to so many rows is sent to every task.
SHORT_ROWS = 500_000


def sent_if_short(df: DataFrame, rows: int = SHORT_ROWS) -> DataFrame:
    """``df`` with the hint to send it to every task, if it has been counted to be that short."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def attach_supplier_key(
    contracts: DataFrame,
    regkeys: DataFrame,
    on: str = "SupplierCompanyRegistrationNumber",
    null_keys: str = "match",
) -> DataFrame:
    """Inner join on registration number; several keys per number fan out.

    ``null_keys="match"`` lets a missing number meet a missing number;
    ``"drop"`` is the plain SQL join.  Contracts without a number are dealt into
    ``NULL_PARTS`` parts by their content, and keys without one go to each part.  Up to
    ``SHORT_ROWS`` keys are sent to the contracts, which are not shuffled then.
    """
    if null_keys not in ("match", "drop"):
        raise ValueError("null_keys must be 'match' or 'drop'")
    if null_keys == "drop":
        return contracts.join(sent_if_short(regkeys), on, "inner")
    content = [F.col(f"`{c}`") for c in contracts.columns]
    dealt = F.when(F.col(on).isNull(), F.pmod(F.xxhash64(*content), F.lit(NULL_PARTS))).otherwise(0).cast("int")
    every = F.when(F.col("_reg").isNull(), F.sequence(F.lit(0), F.lit(NULL_PARTS - 1))).otherwise(F.array(F.lit(0)))
    keys = sent_if_short(regkeys.withColumnRenamed(on, "_reg").withColumn("_key_part", F.explode(every)))
    same = F.col(on).eqNullSafe(F.col("_reg")) & (F.col("_part") == F.col("_key_part"))
    return contracts.withColumn("_part", dealt).join(keys, same, "inner").drop("_reg", "_part", "_key_part")


def member_rows(df: DataFrame, keys: DataFrame, on: str, keep: bool = True) -> DataFrame:
    """Rows whose key is (``keep=False``: is not) in ``keys``; null is a member of null.

    ``keys`` is reduced to one row per key first, so only ``df`` can be skewed
    and the semi/anti join may be split on that side at run time.
    """
    distinct = keys.select(F.col(on).alias("_k")).distinct()
    return df.join(distinct, F.col(on).eqNullSafe(F.col("_k")), "left_semi" if keep else "left_anti")


def explode_join(df: DataFrame, json_col: str, dim: DataFrame, key: str) -> DataFrame:
    """One row per element of a JSON array of ids, inner-joined to ``dim``.

    Rows with an empty or missing array vanish, as do ids unknown to ``dim``.
    """
    # the outer form parses each text once; the inner join drops the nulls
    ids = df.withColumn("_id", F.explode_outer(json_ids(json_col)))
    return (
        ids.withColumn("_id", F.col("_id").cast("bigint"))
        .join(dim.withColumn("_dim_key", F.col(key)), F.col("_id") == F.col("_dim_key"), "inner")
        .drop("_id", "_dim_key")
    )


def filter_prefixes(df: DataFrame, col: str, prefixes: Sequence[str]) -> DataFrame:
    """Any of several literal prefixes; each one reaches the scan as StringStartsWith."""
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | F.col(col).startswith(p)
    return df.where(cond)


def keep_valid(answers: DataFrame, offers: DataFrame, keys: Sequence[str], answer: str) -> DataFrame:
    """Rows of ``answers`` whose answer is in the offered rows for the same keys."""
    return answers.join(offers.select(*keys, answer).distinct(), [*keys, answer], "left_semi")


def pending_runs(manifest: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Manifest rows with no identical earlier run."""
    return manifest.join(ledger.select(*keys).distinct(), list(keys), "left_anti")


def with_default(df: DataFrame, dim: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """Left lookup; blank or missing values fall back to ``default``, several values to the smallest filled one."""
    filled = F.nullif(trim_all(value), F.lit(""))
    one = dim.groupBy(key).agg(F.min(F.when(filled.isNotNull(), F.col(value))).alias(value))
    return df.join(one, key, "left").withColumn(
        value, F.coalesce(F.nullif(trim_all(value), F.lit("")), default))
