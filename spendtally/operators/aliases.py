"""Chains of aliases: a name renamed, merged or taken over several times before it reaches a name on offer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..sources.tables import shared_checkpoint

# Rounds of spreading ends over names with several successors; one round a branching on the way.
MAX_BRANCHINGS = 100


def _jumps(single: DataFrame) -> DataFrame:
    """``(key, target)`` of names with one successor: the first name on the way that has none or several.

    Pointer doubling: a round replaces each target by the target's own, so a chain of
    n names takes log2(n) rounds.  A name that still points to one with a single
    successor afterwards runs into a cycle without exit and is left out.
    """
    jumps = shared_checkpoint(single)
    rounds = max(1, jumps.count()).bit_length()
    for _ in range(rounds):
        further = jumps.select(F.col("key").alias("target"), F.col("target").alias("_next"))
        jumps = shared_checkpoint(
            jumps.join(further, "target", "left").select("key", F.coalesce("_next", "target").alias("target"), F.col("_next").isNotNull().alias("moved")))
        if jumps.where("moved").isEmpty():
            break
        jumps = jumps.drop("moved")
    jumps = jumps.select("key", "target")
    return jumps.join(jumps.select(F.col("key").alias("target")), "target", "left_anti")


def chain_ends(links: DataFrame, candidates: DataFrame) -> DataFrame:
    """``(key, low, high)``: least and greatest candidate that a key leads to, for all keys that lead to one.

    ``links(key, target)`` are distinct, ``candidates(key, low, high)`` one row per
    key.  A candidate's key is an end, whatever its own links; names that lead
    nowhere or only round in a cycle are left out; a cycle with an exit has its
    exit's ends.  Equal ``low`` and ``high`` mean a single end.
    """
    open_links = shared_checkpoint(links.join(candidates, "key", "left_anti"))
    degree = open_links.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("target").alias("target"))
    jumps = shared_checkpoint(_jumps(degree.where("n = 1").select("key", "target")))
    # links of branching names, past the chains that follow them
    branches = open_links.join(degree.where("n > 1").select("key"), "key", "left_semi")
    past = jumps.select(F.col("key").alias("target"), F.col("target").alias("_end"))
    branches = shared_checkpoint(branches.join(past, "target", "left").select("key", F.coalesce("_end", "target").alias("target")).distinct())
    ends = shared_checkpoint(candidates.select("key", "low", "high"))
    known = ends
    before = None
    for _ in range(MAX_BRANCHINGS):
        found = shared_checkpoint(
            branches.join(known.withColumnRenamed("key", "target"), "target").groupBy("key")
            .agg(F.min("low").alias("low"), F.max("high").alias("high")))
        if before is not None and found.exceptAll(before).isEmpty():
            break
        before, known = found, ends.unionByName(found)
    else:
        raise RuntimeError(f"more than {MAX_BRANCHINGS} branchings one after the other")
    return known.unionByName(jumps.join(known.withColumnRenamed("key", "target"), "target").select("key", "low", "high"))


def alias_chain_hits(names: DataFrame, candidates: DataFrame, aliases: DataFrame) -> DataFrame:
    """``(name, match)``: names whose alias chains, of any length, end in exactly one candidate.

    ``aliases(alias, candidate)`` says what a name is called next; both sides are
    compared by ``name_key``.  A chain ends at the first name on offer.  A name whose
    chains end in several candidates, in none, or only in itself finds nothing.
    """
    links = aliases.select(t.name_key("alias").alias("key"), t.name_key("candidate").alias("target")).where(
        "length(key) > 0 and length(target) > 0 and key <> target").distinct()
    offered = candidates.select(t.name_key("candidate").alias("key"), "candidate").groupBy("key").agg(
        F.min("candidate").alias("low"), F.max("candidate").alias("high"))
    links, offered = shared_checkpoint(links), shared_checkpoint(offered)
    ends = chain_ends(links, offered)
    # a name's own links count even if it is on offer itself
    first = names.select("name", t.name_key("name").alias("key")).join(links, "key").select("name", "target")
    led = first.join(ends.withColumnRenamed("key", "target"), "target").groupBy("name").agg(
        F.min("low").alias("low"), F.max("high").alias("match"))
    return led.where("low = match and match <> name").select("name", "match")
