"""Customer groups for buyers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import buyer_group_key
from ..operators.aggregates import last_wins


def stack_sources(sources: Sequence[DataFrame], cols: Sequence[str], order: str = "ord") -> DataFrame:
    """UNION ALL of same-shaped tables; ``ord`` becomes (source number, row order)."""
    out = None
    for i, df in enumerate(sources):
        part = df.select(*cols, F.struct(F.lit(i).alias("source_no"), F.col(order).alias("row")).alias(order))
        out = part if out is None else out.unionByName(part)
    return out


def build_group_dim(
    sources: Sequence[DataFrame], key: str = "CustomerName", value: str = "CustomerGroup", order: str = "ord"
) -> DataFrame:
    """One group per customer name: the pair whose first appearance is latest."""
    return last_wins(stack_sources(sources, [key, value], order), key, value, order)


def add_customer_group(
    df: DataFrame, dim: DataFrame, buyer: str = "buyer", overwrite: bool = True
) -> DataFrame:
    """Left lookup of the group by normalised buyer name.

    ``overwrite=False`` keeps a group the row already has.  ``dim`` has one row
    per name, so rows never multiply and only ``df`` can be skewed.
    """
    lookup = dim.select(F.col("CustomerName").alias("_name"), F.col("CustomerGroup").alias("_group"))
    out = df.withColumn("_key", buyer_group_key(buyer)).join(lookup, F.col("_key") == F.col("_name"), "left")
    if overwrite or "CustomerGroup" not in df.columns:
        out = out.withColumn("CustomerGroup", F.col("_group"))
    else:
        out = out.withColumn("CustomerGroup", F.coalesce("CustomerGroup", "_group"))
    return out.drop("_key", "_name", "_group")
