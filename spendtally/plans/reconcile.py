"""Link contracts to spend reports, first exactly, then through matched names.

Inputs carry an order column that stands for the source row order:
``contract_ord`` and ``mi_ord`` (any sortable type; a bigint keeps the large
aggregates on the hash path).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import nullable_key, pair_id
from ..operators.joins import attach_supplier_key, member_rows, sent_if_short
from ..operators.matchers import Matcher
from ..operators.skew import salted_inner_join, salted_left_join
from ..sources.tables import discard, shared_table

# Stands for a null PairID inside joins: null meets null, and no real PairID lacks a "+".
_NULL_PAIR = "null"
# The mark of reduced spend rows whose PairID a contract has.
_MATCHED = "_matched"


def key_contracts(contracts: DataFrame, regkeys: DataFrame, null_keys: str = "match") -> DataFrame:
    """Contracts with ``contract_supplier_key`` and ``PairID``; unknown suppliers drop out."""
    keyed = attach_supplier_key(
        contracts, regkeys.withColumnRenamed("SupplierKey", "contract_supplier_key"), null_keys=null_keys)
    return keyed.withColumn("PairID", pair_id("contract_supplier_key", "buyer"))


def key_mi(mi: DataFrame) -> DataFrame:
    """Spend rows with ``mi_supplier_key`` (whole number or null) and ``PairID``."""
    return (
        mi.withColumn("mi_supplier_key", nullable_key("SupplierKey")).drop("SupplierKey")
        .withColumn("PairID", pair_id("mi_supplier_key", "CustomerName"))
    )


def contract_index(contracts: DataFrame) -> DataFrame:
    """One row per (buyer, PairID): all that matching needs to know of the contracts."""
    return contracts.groupBy("buyer", "PairID").agg(
        F.min("contract_ord").alias("contract_ord"), F.count(F.lit(1)).alias("n_rows"))


def contracts_by_pair(contracts: DataFrame) -> DataFrame:
    """``contract_index`` for each supplier name, with the latest start: serves the matching and ``latest_per_group`` alike."""
    return contracts.groupBy("buyer", "suppliers", "PairID").agg(
        F.max("contract_start").alias("contract_start"), F.min("contract_ord").alias("contract_ord"), F.count(F.lit(1)).alias("n_rows"))


def pair_names(mi: DataFrame) -> DataFrame:
    """One row per (PairID, key, name): all that matching needs to know of the spend rows."""
    return mi.groupBy("PairID", "mi_supplier_key", "CustomerName").agg(F.count(F.lit(1)).alias("n_rows"))


def reduced_contracts(contracts: DataFrame) -> DataFrame:
    """``contract_index``, written once for all who read it; a table reduced already is taken as it is."""
    return contracts if "n_rows" in contracts.columns else shared_table(contract_index(contracts))


def reduced_mi(mi: DataFrame) -> DataFrame:
    """``pair_names``, written once for all who read it; a table reduced already is taken as it is."""
    return mi if "n_rows" in mi.columns else shared_table(pair_names(mi))


def row_number(reduced: DataFrame) -> int:
    """How many rows a reduced table stands for."""
    return reduced.agg(F.sum("n_rows")).first()[0] or 0


def _on_pair(df: DataFrame) -> DataFrame:
    return df.withColumn("_pair", F.coalesce("PairID", F.lit(_NULL_PAIR)))


def _off_pair(joined: DataFrame, contract_columns: list[str], more: list[str]) -> DataFrame:
    """The contracts' columns with their PairID again, and the others'."""
    own = F.when(F.col("_pair") != _NULL_PAIR, F.col("_pair")).alias("PairID")
    return joined.select(*[own if x == "PairID" else F.col(f"`{x}`") for x in contract_columns],
                         *[F.col(f"`{x}`") for x in more if x not in ("PairID", "_pair")])


def _pair_sizes(reduced: DataFrame) -> DataFrame:
    return _on_pair(reduced).groupBy("_pair").agg(F.sum("n_rows").alias("n"))


def _left_join_pairs(
    contracts: DataFrame, mi: DataFrame, c_sizes: DataFrame, m_sizes: DataFrame, min_rows: int, salts: int
) -> DataFrame:
    """contracts left join mi on PairID, built so that a hot pair is split on both sides.

    Each side is shuffled once, with its PairID once.  ``c_sizes`` and ``m_sizes`` tell which pairs are hot.
    """
    c, m = _on_pair(contracts).drop("PairID"), _on_pair(mi).drop("PairID")
    joined = salted_left_join(c, m, "_pair", "contract_ord", "mi_ord", min_rows, salts, left_sizes=c_sizes, right_sizes=m_sizes)
    return _off_pair(joined, contracts.columns, mi.columns)


def reconcile_exact(
    contracts: DataFrame, mi: DataFrame, min_rows: int = 1_000_000, salts: int = 32
) -> DataFrame:
    """Pass 1: every contract with its spend rows, or once with nulls.

    Both sides are read twice, so they are written first, packed; what made them is freed before they are joined.
    """
    c, m = shared_table(contracts), shared_table(mi)
    return _left_join_pairs(c, m, _hot_pairs(c, min_rows), _hot_pairs(m, min_rows), min_rows, salts)


def _hot_pairs(rows: DataFrame, min_rows: int) -> DataFrame:
    """The pairs with at least ``min_rows`` rows and their numbers, written."""
    return shared_table(_on_pair(rows).groupBy("_pair").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_rows))


def matched_mi(mi: DataFrame, contracts: DataFrame) -> DataFrame:
    """Spend rows that have a contract pair.

    Pass 1 keeps every contract, so membership in its result is membership in
    the contracts; no need to join first.
    """
    if _MATCHED in mi.columns:
        return mi.where(F.col(_MATCHED))
    return member_rows(mi, contracts, "PairID")


def unmatched_mi(mi: DataFrame, contracts: DataFrame) -> DataFrame:
    """Spend rows without a contract pair; a table that ``mark_matched`` made is asked for its mark."""
    if _MATCHED in mi.columns:
        return mi.where(~F.col(_MATCHED))
    return member_rows(mi, contracts, "PairID", keep=False)


def mark_matched(names: DataFrame, contracts: DataFrame) -> DataFrame:
    """Reduced spend rows with ``_pair`` and the mark whether a contract has their PairID.

    One shuffle by pair says it for the name map and for both passes; pairs are looked up, not sorted.
    """
    pairs = _on_pair(contracts).select("_pair").distinct().withColumn(_MATCHED, F.lit(True))
    return _on_pair(names).join(pairs.hint("shuffle_hash"), "_pair", "left").withColumn(_MATCHED, F.coalesce(_MATCHED, F.lit(False)))


def split_unmatched(unmatched: DataFrame, contracts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(known buyer without such a contract, unknown buyer name); exact, case-sensitive."""
    buyers = contracts.select(F.col("buyer").alias("CustomerName"))
    return (member_rows(unmatched, buyers, "CustomerName"),
            member_rows(unmatched, buyers, "CustomerName", keep=False))


def buyer_candidates(contracts: DataFrame) -> DataFrame:
    """Distinct buyers in order of first appearance: ``(candidate, cand_ord)``."""
    return (
        contracts.where("buyer is not null").groupBy(F.col("buyer").alias("candidate"))
        .agg(F.min("contract_ord").alias("cand_ord"))
    )


def unknown_names(mi: DataFrame, contracts: DataFrame) -> DataFrame:
    """Distinct names to send to the matcher: ``(name)``.

    One row per (pair, name) is made before any join, so the joins see names,
    not spend rows; rows that are marked already are reduced to names at once.
    """
    named = mi.where("CustomerName is not null")
    pairs = named if _MATCHED in named.columns else named.select("PairID", "CustomerName").distinct()
    left = unmatched_mi(pairs, contracts).select("CustomerName").distinct()
    return split_unmatched(left, contracts)[1].select(F.col("CustomerName").alias("name"))


def unknown_rows(mi: DataFrame, contracts: DataFrame) -> DataFrame:
    """Unmatched (PairID, name) whose name is no known buyer; a missing name is one too."""
    pairs = mi.select("PairID", "CustomerName").distinct()
    return split_unmatched(unmatched_mi(pairs, contracts), contracts)[1]


def name_map(mi: DataFrame, contracts: DataFrame, matcher: Matcher) -> DataFrame:
    """``(CustomerName, AIMatchedName)`` for the unknown names that found a buyer.

    Takes the keyed tables, each of which is read once, or their reduced forms.
    """
    names, index = reduced_mi(mi), reduced_contracts(contracts)
    hits = matcher(unknown_names(names, index), buyer_candidates(index))
    return hits.select(F.col("name").alias("CustomerName"), F.col("match").alias("AIMatchedName"))


def apply_name_map(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add ``AIMatchedName``; one map row per name, so only ``df`` can be skewed."""
    return df.join(mapping, "CustomerName", "left")


def second_pairs(names: DataFrame, contracts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Unmatched (PairID, name) with an unknown name that found a buyer.

    ``names`` is reduced (``pair_names`` or ``spend_by_name``, marked or not); ``OldPairID``
    keeps the own key, ``PairID`` is rebuilt from the matched name.  Known buyers are taken
    out of the map, which is shorter than the names and is written for its length.
    """
    asked = shared_table(split_unmatched(mapping, contracts)[1])
    moved = unmatched_mi(names.join(sent_if_short(asked, MAP_ROWS), "CustomerName", "inner"), contracts)
    return moved.withColumnRenamed("PairID", "OldPairID").withColumn("PairID", pair_id("mi_supplier_key", "AIMatchedName"))


# More contracts than so many are joined in so many parts, one after the other, each written when it is made.
PART_ROWS, PARTS = 5_000_000, 4
# A name map of up to so many rows is sent to every task.
MAP_ROWS = 100_000


def reconcile_two_pass(
    contracts: DataFrame,
    mi: DataFrame,
    matcher: Matcher | None = None,
    min_rows: int = 1_000_000,
    salts: int = 32,
    mapping: DataFrame | None = None,
    names: DataFrame | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    """Pass 1 and pass 2 stacked, marked by ``match_pass``.

    Needs a matcher, or a name map made earlier.  The pass-2 block lists every
    contract again when any unknown row exists, null names included, and is absent otherwise.
    ``names`` and ``index`` are the reduced forms of both sides, if there are any already.
    """
    if mapping is None and matcher is None:
        raise ValueError("give a matcher or a mapping")
    index = reduced_contracts(contracts) if index is None else index
    given, parts = (contracts, mi), PARTS if row_number(index) > PART_ROWS else 1
    if parts > 1:
        contracts, mi = shared_table(contracts), shared_table(mi)
    names = reduced_mi(mi) if names is None else names
    if mapping is None:
        mapping = shared_table(name_map(names, index, matcher))
    pairs = shared_table(second_pairs(names, index, mapping))
    # contracts are shuffled once, for both passes: a pair without spend rows in a pass has one empty row there
    passes = [(names, F.lit(True)), (pairs, unknown_rows(names, index).exists())]
    gaps = None
    for i, (present, there) in enumerate(passes, 1):
        gap = _on_pair(index).select("_pair").distinct().join(_on_pair(present).select("_pair"), "_pair", "left_anti")
        gap = gap.where(there).withColumn("match_pass", F.lit(i))
        gaps = gap if gaps is None else gaps.unionByName(gap)
    own = _on_pair(mi).drop("PairID").withColumns({"match_pass": F.lit(1), "AIMatchedName": F.lit(None).cast("string")})
    sizes = _pair_sizes(names).unionByName(_pair_sizes(pairs)).groupBy("_pair").agg(F.sum("n").alias("n"))
    gaps, left_sizes, right_sizes = (shared_table(x) for x in (
        gaps, _pair_sizes(index).where(F.col("n") >= min_rows), sizes.where(F.col("n") >= min_rows)))
    rows = own.unionByName(_moved_rows(mi, pairs, mapping)).unionByName(gaps, allowMissingColumns=True)
    c, out = _on_pair(contracts).drop("PairID"), None
    for i in range(parts):
        here = F.pmod(F.xxhash64("_pair"), F.lit(parts)) == i
        joined = salted_inner_join(
            c.where(here), rows.where(here), "_pair", "contract_ord", "mi_ord", min_rows, salts, left_sizes=left_sizes, right_sizes=right_sizes)
        part = _off_pair(joined, contracts.columns, own.columns)
        part = shared_table(part) if parts > 1 else part
        out = part if out is None else out.union(part)
    if parts > 1:
        discard(*[own for own, x in zip((contracts, mi), given) if own is not x])
    return out


def _moved_rows(mi: DataFrame, pairs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Spend rows of the second pass with their new ``_pair``.

    They meet the reduced table once; whether a row is unmatched is known there already.
    Rows whose name is not in a small map drop out before the shuffle.
    """
    old = mi.withColumnRenamed("PairID", "OldPairID")
    asked = mapping.select("CustomerName").distinct()
    if asked.limit(MAP_ROWS + 1).count() <= MAP_ROWS:
        old = old.join(F.broadcast(asked), "CustomerName", "left_semi")
    moved = old.join(pairs.select("OldPairID", "CustomerName", "AIMatchedName", "PairID"), ["OldPairID", "CustomerName"])
    return _on_pair(moved).drop("OldPairID", "PairID").withColumn("match_pass", F.lit(2))


def residual_mi(
    contracts: DataFrame, mi: DataFrame, mapping: DataFrame | None = None, residual: str = "reference",
    names: DataFrame | None = None,
) -> DataFrame:
    """Spend rows left without a contract.

    ``"reference"``: rows whose own PairID has no contract, name-matched ones
    included; nothing at all when no unknown row exists.  ``"strict"``: rows
    matched in neither pass.  What is left is found on the reduced tables, so spend
    rows go through one join.  ``contracts`` may be the index; ``names`` are the reduced
    spend rows, if there are any already.
    """
    if residual not in ("reference", "strict"):
        raise ValueError("residual must be 'reference' or 'strict'")
    index = reduced_contracts(contracts)
    if residual == "reference":
        return unmatched_mi(mi, index).where(unknown_rows(reduced_mi(mi) if names is None else names, index).exists())
    if mapping is None:
        return unmatched_mi(mi, index)
    names = reduced_mi(mi) if names is None else names
    found = matched_mi(second_pairs(names, index, mapping), index)
    gone = found.select(F.col("OldPairID").alias("PairID"), "CustomerName")
    left = unmatched_mi(names, index).join(gone, ["PairID", "CustomerName"], "left_anti")
    left = left.select(F.col("PairID").alias("_p"), F.col("CustomerName").alias("_n")).distinct()
    return mi.join(left, F.col("PairID").eqNullSafe(F.col("_p")) & F.col("CustomerName").eqNullSafe(F.col("_n")), "left_semi")


def reconcile(
    contracts: DataFrame,
    mi: DataFrame,
    regkeys: DataFrame,
    matcher: Matcher,
    residual: str = "reference",
    null_keys: str = "match",
    min_rows: int = 1_000_000,
    salts: int = 32,
) -> tuple[DataFrame, DataFrame]:
    """Raw contracts, spend rows and key pairs -> (combined, unmatched).

    The name map is small, costly and read several times, so it is cut off
    from its lineage.
    """
    c, m = key_contracts(contracts, regkeys, null_keys), key_mi(mi)
    names, index = reduced_mi(m), reduced_contracts(c)
    mapping = shared_table(name_map(names, index, matcher))
    combined = reconcile_two_pass(c, m, mapping=mapping, min_rows=min_rows, salts=salts, names=names, index=index)
    return combined, residual_mi(index, m, mapping, residual, names)


def spend_by_name(mi: DataFrame) -> DataFrame:
    """Spend rows reduced to one row per (key, name, group).

    The only pass over all spend rows; its buffers have fixed width when
    ``mi_ord`` has, so it runs as a hash aggregate with map-side combine and a
    pair or buyer owning a third of the rows shrinks before the shuffle.
    """
    return mi.groupBy("mi_supplier_key", "CustomerName", "PairID", "CustomerGroup").agg(
        F.sum("EvidencedSpend").alias("spend"), F.count(F.lit(1)).alias("n_rows"),
        F.min("mi_ord").alias("mi_ord"))


def spend_by_group(mi: DataFrame) -> DataFrame:
    """Spend rows reduced to one row per (PairID, group); the same hash aggregate, for those who need no names."""
    return mi.groupBy("PairID", "CustomerGroup").agg(
        F.sum("EvidencedSpend").alias("spend"), F.count(F.lit(1)).alias("n_rows"), F.min("mi_ord").alias("mi_ord"))


def spend_by_pair(names: DataFrame, key: str = "PairID") -> DataFrame:
    """``(key, spend, n_rows, mi_group)`` from ``spend_by_name`` or ``spend_by_group`` rows.

    ``mi_group`` is the first non-null group with its position; equal positions
    fall back to text order.  ``names`` is read and shuffled once; a pair has one row
    per name and group in it, however many spend rows.
    """
    pair = Window.partitionBy(key)
    first = pair.orderBy(F.col("CustomerGroup").isNull(), "mi_ord", "CustomerGroup")
    group = F.when(F.col("CustomerGroup").isNotNull(), F.struct("mi_ord", "CustomerGroup"))
    return names.select(
        key, F.sum("spend").over(pair).alias("spend"), F.sum("n_rows").over(pair).alias("n_rows"), group.alias("mi_group"),
        F.row_number().over(first).alias("_r")).where("_r = 1").drop("_r")


__all__ = [
    "apply_name_map", "buyer_candidates", "contract_index", "contracts_by_pair", "key_contracts", "key_mi", "mark_matched",
    "matched_mi", "name_map", "pair_names", "reconcile", "reconcile_exact", "reconcile_two_pass", "reduced_contracts", "reduced_mi",
    "residual_mi", "second_pairs",
    "spend_by_group", "spend_by_name", "spend_by_pair", "split_unmatched", "unknown_names", "unknown_rows", "unmatched_mi",
]
