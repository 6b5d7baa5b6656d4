"""Pairwise name similarity."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import _col, trim_all
from . import block_ratio
from .block_ratio import block_ratios

# travels to the workers by value, so they need no copy of this package
cloudpickle.register_pickle_by_value(block_ratio)

# --- fixed values -----------------------------------------------------------
SIMILARITY_THRESHOLD = 0.85
# ----------------------------------------------------------------------------

_EPS = 1e-9


def folded(c) -> Column:
    return F.lower(trim_all(c))


def levenshtein_similarity(a, b) -> Column:
    """1 - distance / longer length, on text as given."""
    a, b = _col(a), _col(b)
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))


def matching_blocks_ratio(a, b) -> Column:
    """Ratcliff-Obershelp ratio 2M / (|a| + |b|); the argument order matters."""
    def ratios(x: pd.Series, y: pd.Series) -> pd.Series:
        there = (x.notna() & y.notna()).to_numpy()
        out = np.full(len(x), np.nan)
        out[there] = block_ratios(x[there].tolist(), y[there].tolist())
        return pd.Series(out).astype(object).where(there, None)

    return F.pandas_udf(ratios, T.DoubleType())(_col(a), _col(b))


def char_signature(c: str, half: int) -> Column:
    """One of two 64-bit masks of a text column's characters, repeats counted.

    The k-th occurrence of a character sets one of 128 bits.  One inserted or
    deleted character changes at most one bit and a replaced one at most two,
    so far pairs are told apart by counting differing bits.
    """
    chars = f"filter(array_distinct(split({c}, '')), ch -> ch <> '')"
    bits = (
        f"flatten(transform({chars}, ch -> transform(sequence(1, length({c}) - length(replace({c}, ch, ''))), "
        f"k -> pmod(hash(ch, k), 128))))"
    )
    mine = f"filter({bits}, p -> p div 64 = {half})"
    return F.expr(f"aggregate({mine}, 0L, (acc, p) -> acc | shiftleft(1L, cast(p % 64 as int)))")


@dataclass(frozen=True)
class EditBound:
    """How far apart two texts may be and still reach a similarity threshold.

    ``max_len``: longest partner of a text of a given length; ``tolerance``: the
    most edits between two texts of given lengths; ``overlap``: the fewest
    characters they share, repeats counted.  All work on numbers and, through SQL
    text, on columns.  ``cuts``: whether a piece of a text must survive the edits.
    """

    threshold: float
    ratio: bool = False

    def __post_init__(self):
        if not 0 < self.threshold <= 1:
            raise ValueError(f"threshold must be above 0 and at most 1, got {self.threshold}")

    @property
    def cuts(self) -> bool:
        return self.threshold > (2 / 3 if self.ratio else 0.5)

    @property
    def stretch(self) -> float:
        """Longest partner length per character."""
        t = self.threshold
        return (2 - t) / t if self.ratio else 1 / t

    def max_len(self, n: str) -> str:
        return f"cast(floor({n} * {self.stretch!r}D + {_EPS}) as int)"

    def min_len(self, n: str) -> str:
        return f"cast(ceil({n} / {self.stretch!r}D - {_EPS}) as int)"

    def tolerance(self, n: str, m: str) -> str:
        size = f"({n} + {m})" if self.ratio else f"greatest({n}, {m})"
        return f"cast(floor({1 - self.threshold!r}D * {size} + {_EPS}) as int)"

    def overlap(self, n: str, m: str) -> str:
        size = f"({n} + {m}) / 2D" if self.ratio else f"greatest({n}, {m})"
        return f"cast(greatest(1, ceil({self.threshold!r}D * {size} - {_EPS})) as int)"

    def prefix(self, n: str) -> str:
        """Tokens of which a text must share one with any partner, if all texts order theirs alike."""
        return f"({n} - {self.overlap(n, self.min_len(n))} + 1)"

    def bits(self, n: str, m: str) -> str:
        """Most differing ``char_signature`` bits."""
        return self.tolerance(n, m) if self.ratio else f"2 * {self.tolerance(n, m)}"

    def pieces_needed(self, n: str) -> str:
        """Pieces a text is cut into so that one survives any allowed edits."""
        return f"({self.tolerance(n, self.max_len(n))} + 1)"


def best_per_input(scored: DataFrame, ids, threshold: float) -> DataFrame:
    """Highest score at or above the threshold; the earliest candidate wins ties.

    A plain mergeable aggregate, so repeated pairs do no harm and a name with
    very many candidates is combined before the shuffle.  The threshold comes
    after it: a filter on the score would be pushed into the pairing join ahead
    of that join's cheap tests.
    """
    best = F.min(F.struct((-F.col("score")).alias("neg"), "cand_ord", "candidate"))
    return (
        scored.groupBy(*ids).agg(best.alias("_b"))
        .select(*ids, F.col("_b.candidate").alias("match"), (-F.col("_b.neg")).alias("score"))
        .where((F.col("score") >= threshold) & (F.col("score") > 0))
    )


def top_ratios(pairs: DataFrame, threshold: float) -> DataFrame:
    """``(name, candidate, cand_ord, score)``: pairs that may hold a name's best ratio.

    ``pairs(name, a, candidate, cand_ord, c, differing)``.  ``differing`` caps
    the ratio at 1 - differing / (|a| + |c|).  Pairs are scored where they are
    made: of a batch, each name's pair with the highest cap first, then those
    whose cap is not below the best ratio that the task met for the name.
    """
    slack, names_kept = _EPS, 1_000_000

    def score(batches):
        best = {}
        for batch in batches:
            if len(best) > names_kept:
                best.clear()
            size = batch["a"].str.len() + batch["c"].str.len()
            cap = 1.0 - batch["differing"] / size
            batch = batch.assign(cap=cap).sort_values(["name", "cap"], ascending=[True, False], kind="stable")
            batch = batch.drop_duplicates(["name", "candidate"])
            first = ~batch["name"].duplicated()
            for part in (batch[first], batch[~first]):
                part = part[part["cap"] >= part["name"].map(best).fillna(threshold) - slack]
                if part.empty:
                    continue
                part = part.assign(score=block_ratios(part["a"].tolist(), part["c"].tolist()))
                part = part[part["score"] >= part["name"].map(best).fillna(threshold)]
                best.update(part.groupby("name")["score"].max().to_dict())
                yield part[["name", "candidate", "cand_ord", "score"]]

    types = dict(pairs.dtypes)
    return pairs.mapInPandas(
        score, f"name string, candidate string, cand_ord {types['cand_ord']}, score double")
