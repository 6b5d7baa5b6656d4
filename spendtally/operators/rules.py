"""Name-matching rules: case and punctuation, brackets, legal forms, acronyms,
extra descriptors, shortened forms, user aliases and chains of them.

Arrays are opened with the outer forms: a plain explode adds a "not empty" filter
that is pushed down to the scan and computes the array once more for every row.

A rule's hit counts only when exactly one candidate fits (precision first).
Candidates are reduced to one row per key before they meet the inputs, so a key
shared by very many names never makes pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from .aliases import alias_chain_hits

# --- fixed values: rule names in order of trust -------------------------------
RULES = ("normalised", "brackets", "suffix", "acronym", "alias", "alias_chain", "descriptor", "shortened")
# ------------------------------------------------------------------------------
_NO = {r: i for i, r in enumerate(RULES, 1)}


def _one(col):
    return F.array(col)


def _runs(tokens, from_start: bool, proper: bool):
    """Token runs from the start (or to the end) of a name, as text."""
    last = F.size(tokens) - (1 if proper else 0)
    idx = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    if from_start:
        return F.transform(idx, lambda i: F.array_join(F.slice(tokens, F.lit(1), i), " "))
    return F.transform(idx, lambda i: F.array_join(F.slice(tokens, -i, i), " "))


def _keys(df: DataFrame, col: str, rules, candidate_side: bool) -> DataFrame:
    """Explode ``(rule_no, key)`` rows for the equality rules asked for."""
    name = F.col(col)
    tokens = F.filter(F.split(t.suffix_key(name), " "), lambda w: w != "")
    parts = []

    def add(rule, keys):
        if rule in rules:
            parts.append(F.transform(keys, lambda k: F.struct(F.lit(_NO[rule]).alias("rule_no"), k.alias("key"))))

    add("normalised", _one(t.name_key(name)))
    add("brackets", _one(t.bracket_key(name)))
    add("suffix", _one(t.suffix_key(name)))
    if candidate_side:
        add("acronym", t.acronym_keys(name))
        add("shortened", F.array_distinct(F.concat(_runs(tokens, True, True), _runs(tokens, False, True))))
    else:
        add("acronym", _one(t.acronym_input(name)))
        add("shortened", _one(t.suffix_key(name)))
    if not parts:
        parts = [F.array().cast("array<struct<rule_no:int,key:string>>")]
    return df.select(col, F.inline_outer(F.concat(*parts))).where(F.length("key") > 0)


def _unique_by_key(inputs: DataFrame, candidates: DataFrame, rules) -> DataFrame:
    """``(name, rule_no, match)`` for equality rules with a single fitting candidate."""
    groups = (
        _keys(candidates, "candidate", rules, True).groupBy("rule_no", "key")
        .agg(F.count_distinct("candidate").alias("n"), F.min("candidate").alias("lo"),
             F.max("candidate").alias("hi"))
        .where("n <= 2")
    )
    # the asked name itself is not on offer: in a group of two, the other one is the hit
    joined = _keys(inputs, "name", rules, False).join(groups, ["rule_no", "key"])
    hit = F.when((F.col("n") == 1) & (F.col("lo") != F.col("name")), F.col("lo")) \
        .when((F.col("n") == 2) & (F.col("lo") == F.col("name")), F.col("hi")) \
        .when((F.col("n") == 2) & (F.col("hi") == F.col("name")), F.col("lo"))
    return joined.select("name", "rule_no", hit.alias("match")).where("match is not null")


# Candidates filed under a word, and inputs that hold it, meet in cells of about so many a side.
WORD_BLOCK_ROWS = 10_000


def _word_mask(tokens: str) -> str:
    """64 bits that stand for the words of a name; a set's mask holds the mask of each subset."""
    return f"aggregate({tokens}, 0L, (m, w) -> m | shiftleft(1L, cast(pmod(xxhash64(w), 64) as int)))"


def word_cells(filed: DataFrame, asked: DataFrame, block_rows: int = WORD_BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join on ``word`` with ``_part`` and ``_copy``: a frequent word's postings are split.

    Candidates of a word are dealt into parts and inputs into copies, and each is
    sent to all of the other's, so that every pair meets in one cell.
    """
    def sizes(df, name):
        return df.groupBy("word").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(name))

    split = sizes(filed, "_parts").join(sizes(asked, "_copies"), "word").where("_parts > 1 or _copies > 1")
    one = F.lit(1)
    c = (
        filed.join(split, "word", "left").withColumn("_part", F.pmod(F.xxhash64("candidate"), F.coalesce("_parts", one)).cast("int"))
        .withColumn("_copy", F.explode_outer(F.expr("sequence(0, coalesce(_copies, 1) - 1)"))).drop("_parts", "_copies")
    )
    a = (
        asked.join(split, "word", "left").withColumn("_copy", F.pmod(F.xxhash64("name"), F.coalesce("_copies", one)).cast("int"))
        .withColumn("_part", F.explode_outer(F.expr("sequence(0, coalesce(_parts, 1) - 1)"))).drop("_parts", "_copies")
    )
    return c, a


def _descriptor_hits(inputs: DataFrame, candidates: DataFrame, block_rows: int = WORD_BLOCK_ROWS) -> DataFrame:
    """Candidates whose words are a proper subset of the input's words.

    A candidate is filed under its rarest word only; any input holding all its
    words holds that one, so nothing is lost.  A word that stays frequent, because
    names consist of frequent words alone, has its postings split.  Sizes and word
    masks tell most pairs apart before their words are compared.  The fullest fit
    wins if it is the only one of its size.
    """
    c = candidates.select("candidate", t.name_tokens("candidate").alias("ct")).where(F.size("ct") > 0)
    c = c.withColumns({"cn": F.size("ct"), "cm": F.expr(_word_mask("ct"))})
    words = c.select("*", F.explode_outer("ct").alias("word"))
    common = words.groupBy("word").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    rarest = Window.partitionBy("candidate").orderBy(F.coalesce("_n", F.lit(0)), "word")
    filed = (
        words.join(common, "word", "left").withColumn("_r", F.row_number().over(rarest))
        .where("_r = 1").select("word", "candidate", "ct", "cn", "cm")
    )
    asked = inputs.select("name", t.name_tokens("name").alias("nt"))
    asked = asked.withColumns({"nn": F.size("nt"), "nm": F.expr(_word_mask("nt"))}).select(
        "*", F.explode_outer("nt").alias("word")).where("word is not null")
    filed, asked = word_cells(filed, asked, block_rows)
    fits = (
        asked.join(filed, ["word", "_part", "_copy"])
        .where("cn < nn and (cm & nm) = cm and candidate <> name and size(array_except(ct, nt)) = 0")
        .groupBy("name", F.col("cn").alias("fit"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("candidate").alias("match"))
    )
    return (
        fits.groupBy("name").agg(F.max(F.struct("fit", "n", "match")).alias("b"))
        .where("b.n = 1")
        .select("name", F.lit(_NO["descriptor"]).alias("rule_no"), F.col("b.match").alias("match"))
    )


def rule_hits(
    inputs: DataFrame,
    candidates: DataFrame,
    rules=RULES,
    aliases: DataFrame | None = None,
) -> DataFrame:
    """Every unique hit ``(name, rule_no, match)`` of the chosen rules."""
    unknown = set(rules) - set(RULES)
    if unknown:
        raise ValueError(f"unknown rules {sorted(unknown)}; known: {list(RULES)}")
    names = inputs.select("name").where("name is not null").distinct()
    cands = candidates.select("candidate").where("candidate is not null").distinct()
    hits = _unique_by_key(names, cands, rules)
    if "descriptor" in rules:
        hits = hits.unionByName(_descriptor_hits(names, cands))
    if "alias" in rules and aliases is not None:
        known = (
            aliases.select(t.name_key("alias").alias("key"), "candidate")
            .join(cands, "candidate", "left_semi")
            .groupBy("key").agg(F.count_distinct("candidate").alias("n"), F.min("candidate").alias("match"))
            .where("n = 1")
        )
        hits = hits.unionByName(
            names.withColumn("key", t.name_key("name")).join(known, "key")
            .where(F.col("match") != F.col("name"))
            .select("name", F.lit(_NO["alias"]).alias("rule_no"), "match"))
    if "alias_chain" in rules and aliases is not None:
        hits = hits.unionByName(
            alias_chain_hits(names, cands, aliases).select("name", F.lit(_NO["alias_chain"]).alias("rule_no"), "match"))
    return hits


def first_rule(hits: DataFrame) -> DataFrame:
    """The most trusted rule's hit per name: ``(name, match, score, rule)``."""
    best = hits.groupBy("name").agg(F.min(F.struct("rule_no", "match")).alias("b"))
    rule = F.element_at(F.array(*[F.lit(r) for r in RULES]), F.col("b.rule_no"))
    return best.select("name", F.col("b.match").alias("match"), F.lit(1.0).alias("score"), rule.alias("rule"))
