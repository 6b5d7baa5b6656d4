"""The matcher contract and the built-in matchers.

A matcher is any callable ``(inputs, candidates) -> DataFrame`` with
``inputs(name)``, ``candidates(candidate, cand_ord)`` and a result
``(name, match, score, rule)`` holding at most one row per name and only
matched names.  An input is never offered itself.  A user can wrap a service of
their own in ``mapInPandas`` and pass that.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import ClassVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import shared_checkpoint
from .blocking import DEFAULT_SPARE, close_pairs, sharing_pairs
from .rules import RULES, first_rule, rule_hits
from .scoring import (
    SIMILARITY_THRESHOLD,
    EditBound,
    best_per_input,
    levenshtein_similarity,
    top_ratios,
)

Matcher = Callable[[DataFrame, DataFrame], DataFrame]


# Names with a near-perfect match are settled at this threshold first.
FIRST_THRESHOLD = 0.95
# Where no piece of a name need survive, names with a fair match are settled at this one before.
MIDDLE_THRESHOLD = 0.75


def _settle(df: DataFrame, key: str) -> DataFrame:
    """Names spread evenly over the shuffle partitions and cut off from their lineage.

    A names table is read several times and each row opens into many, so it
    must be neither computed again nor packed into a few partitions by size.
    """
    if getattr(df, "_settled", False):
        return df
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = shared_checkpoint(df.repartition(n, key))
    out._settled = True
    return out


def _in_turn(inputs: DataFrame, candidates: DataFrame, steps) -> DataFrame:
    """Apply matchers in turn; each sees only the names the earlier ones left open."""
    names = _settle(inputs.select("name").where("name is not null").distinct(), "name")
    cands = _settle(candidates, "candidate")
    found = None
    for i, step in enumerate(steps):
        if found is None:
            left = names
        else:
            left = names.join(found.select("name"), "name", "left_anti")
        hits = step(left, cands)
        if i < len(steps) - 1:  # read by the next step and by the result
            hits = shared_checkpoint(hits)
        found = hits if found is None else found.unionByName(hits)
    return found


@dataclass(frozen=True)
class _SimilarityMatcher:
    """Best candidate at or above ``threshold``, found in two rounds.

    A name whose best score reaches the higher first threshold is settled there
    exactly, as all its candidates at that level are seen; the high threshold
    makes long, selective pieces.  Only the other names meet the wider search.  Any
    threshold above 0 is possible; at the lowest ones names meet by the characters
    that they share, and only those without a fair match do.
    """

    threshold: float = SIMILARITY_THRESHOLD
    spare: int = DEFAULT_SPARE
    first_threshold: float = FIRST_THRESHOLD
    by_ratio: ClassVar[bool] = False

    def __call__(self, inputs: DataFrame, candidates: DataFrame) -> DataFrame:
        levels = {max(self.first_threshold, self.threshold), self.threshold}
        if not self._bound(self.threshold).cuts:
            levels.add(MIDDLE_THRESHOLD)
        return _in_turn(inputs, candidates, [lambda i, c, t=t: self._best(i, c, t) for t in sorted(levels, reverse=True)])

    def _bound(self, t: float) -> EditBound:
        return EditBound(t, ratio=self.by_ratio)

    def _pairs(self, inputs: DataFrame, candidates: DataFrame, t: float) -> DataFrame:
        bound = self._bound(t)
        return close_pairs(inputs, candidates, bound, self.spare) if bound.cuts else sharing_pairs(inputs, candidates, bound)


@dataclass(frozen=True)
class LevenshteinMatcher(_SimilarityMatcher):
    """Similarity is 1 - edit distance / longer length, case ignored."""

    def _best(self, inputs: DataFrame, candidates: DataFrame, t: float) -> DataFrame:
        scored = self._pairs(inputs, candidates, t).withColumn("score", levenshtein_similarity("a", "c"))
        return best_per_input(scored, ["name"], t).withColumn("rule", F.lit("levenshtein"))


@dataclass(frozen=True)
class RatioMatcher(_SimilarityMatcher):
    """Similarity is the matching-blocks ratio, case ignored.

    Matching blocks are a common subsequence, so pairs at the threshold are
    within a known number of edits and the blocking loses nothing.
    """

    by_ratio: ClassVar[bool] = True

    def _best(self, inputs: DataFrame, candidates: DataFrame, t: float) -> DataFrame:
        scored = top_ratios(self._pairs(inputs, candidates, t), t)
        return best_per_input(scored, ["name"], t).withColumn("rule", F.lit("ratio"))


@dataclass(frozen=True)
class RuleMatcher:
    """First rule with exactly one fitting candidate."""

    rules: tuple[str, ...] = RULES
    aliases: DataFrame | None = field(default=None, compare=False)

    def __call__(self, inputs: DataFrame, candidates: DataFrame) -> DataFrame:
        names = _settle(inputs.select("name").where("name is not null").distinct(), "name")
        return first_rule(rule_hits(names, _settle(candidates, "candidate"), self.rules, self.aliases))


@dataclass(frozen=True)
class CascadeMatcher:
    """Matchers in turn; each sees only the names the earlier ones left open."""

    steps: tuple[Matcher, ...] = (RuleMatcher(), RatioMatcher())

    def __call__(self, inputs: DataFrame, candidates: DataFrame) -> DataFrame:
        return _in_turn(inputs, candidates, self.steps)
