"""Connected components of a link table, and a bounded filter of row keys."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: A key filter has at most so many bits (16 MB), whatever the number of keys.
LEAST_FILTER_BITS, MAX_FILTER_BITS = 1 << 24, 1 << 27


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Links (a, b) -> (node, root): every node of a link and the smallest node it reaches.

    Large-star and small-star rounds: each node hands its neighbours on to the
    smallest of them until only stars are left.  A round is joins and minima over
    the links, so a hub is split like any skewed join key; nothing is collected but
    a checksum.  No links give no rows.
    """
    links = cut(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    for _ in range(max_rounds):
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("s")).first()
        if state["n"] == 0 or (state["n"], state["s"]) == seen:
            break
        seen = (state["n"], state["s"])
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(low, "u")
        small = near.select("u", F.col("m").alias("v")).union(near.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        links = cut(small.distinct())
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    found = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return found.union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def key_filter(keys: DataFrame, key: str) -> np.ndarray:
    """Bitmap of a column of longs: 2 to 16 MB, 16 bits a key as far as that goes, made on the executors.

    A key that is in has its bit set; others may share it, so what passes is looked
    up exactly afterwards.  Only the words of the bitmap come to the driver.
    """
    n = keys.count()
    bits = LEAST_FILTER_BITS
    while bits < min(16 * n, MAX_FILTER_BITS):
        bits <<= 1
    bit = F.pmod(F.col(key), F.lit(bits))
    words = (
        keys.select(bit.alias("b")).groupBy(F.shiftright("b", 6).alias("w"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 as int)))").alias("v")).toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy()
    return out.view(np.uint64)


def in_filter(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the longs may be in the filter."""
    at = keys.astype(np.int64).view(np.uint64) & np.uint64(len(bitmap) * 64 - 1)
    return ((bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def may_be_in(bitmap):
    """The test of ``in_filter`` on a column of longs without nulls, for a broadcast bitmap; only that column goes to Python."""

    def test(keys: pd.Series) -> pd.Series:
        return pd.Series(in_filter(bitmap.value, keys.to_numpy()))

    return F.pandas_udf(test, "boolean")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Key of a row by what it holds, the same in every scan."""
    return F.xxhash64(doc_id, text)
