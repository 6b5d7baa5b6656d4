"""Eight summary figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.status import amber_flag, has_spend, red_flag
from ..operators.aggregates import count_unique, unpivot_metrics
from ..schemas import SUMMARY_LABELS
from ..sources.tables import shared_table
from .reconcile import reduced_contracts, residual_mi, unmatched_mi


def unmatched_profile(
    contracts: DataFrame, mi: DataFrame, residual: str = "reference", mapping: DataFrame | None = None
) -> DataFrame:
    """Unmatched rows counted per (supplier name, customer name), with ``known_buyer``.

    Counting comes before the joins, so they see one row per pair and names
    instead of every spend row, and contracts are read once.  ``"strict"`` leaves
    out what ``mapping`` matches and drops the mark.
    """
    small = shared_table(mi.groupBy("PairID", "mi_supplier_key", "SupplierName", "CustomerName").agg(
        F.count(F.lit(1)).alias("n_rows")))
    if residual == "strict":
        return residual_mi(contracts, small, mapping, "strict")
    index = reduced_contracts(contracts)
    buyers = index.select(F.col("buyer").alias("_b")).distinct().withColumn("known_buyer", F.lit(True))
    left = unmatched_mi(small, index)
    return left.join(buyers, F.col("CustomerName").eqNullSafe(F.col("_b")), "left").drop("_b").fillna(
        False, ["known_buyer"])


def profile_rows(unmatched: DataFrame) -> DataFrame:
    """The same profile from unmatched rows that exist already."""
    return unmatched.groupBy("SupplierName", "CustomerName").agg(F.count(F.lit(1)).alias("n_rows"))


def summary_stats(contracts: DataFrame, lines: DataFrame, profile: DataFrame, min_months: int = 3) -> DataFrame:
    """``(position, Summary Statistic, Value)``; raw contract rows, pair lines, unmatched profile.

    The figures of each are written before those of the next are made, so what they shuffle is not kept together.
    """
    labels = dict(SUMMARY_LABELS)
    place = {name: i for i, (name, _) in enumerate(SUMMARY_LABELS, 1)}
    parts = [
        contracts.agg(F.count(F.lit(1)).alias("total_contracts")),
        lines.agg(
            F.count(F.lit(1)).alias("pairs_with_key"),
            F.count_if(has_spend("EvidencedSpend")).alias("with_spend"),
            F.count_if(red_flag("expired", "EvidencedSpend")).alias("no_spend_expired"),
            F.count_if(amber_flag("expired", "months_run", "EvidencedSpend", min_months))
            .alias("no_spend_running")),
        _unmatched(profile),
    ]
    out = None
    for p in map(shared_table, parts):
        rows = unpivot_metrics(p, [(c, labels[c]) for c in p.columns]).withColumn(
            "position", _position(p.columns, place))
        out = rows if out is None else out.unionByName(rows)
    return out


def _unmatched(profile: DataFrame) -> DataFrame:
    """Figures of the unmatched rows; with ``known_buyer`` marks they are 0 unless a name is unknown."""
    figures = {
        "unmatched_rows": F.coalesce(F.sum("n_rows"), F.lit(0)),
        "unmatched_suppliers": count_unique("SupplierName"),
        "unmatched_buyers": count_unique("CustomerName"),
    }
    if "known_buyer" in profile.columns:
        unknown = F.count_if(~F.coalesce("known_buyer", F.lit(False))) > 0
        figures = {k: F.when(unknown, v).otherwise(0) for k, v in figures.items()}
    return profile.agg(*[v.alias(k) for k, v in figures.items()])


def _position(columns, place):
    return F.element_at(F.array(*[F.lit(place[c]) for c in columns]), F.col("position"))
