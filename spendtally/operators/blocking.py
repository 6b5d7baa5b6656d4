"""Similarity-join blocking that loses no qualifying pair.

A candidate that may take at most T edits is cut into T + 1 pieces and up to
``spare`` more.  Each edit harms at most one piece, so of any T + 1 pieces one
appears unchanged in a qualifying input (the pigeonhole rule of PassJoin, Li et
al., VLDB 2011).  The other pieces may therefore be ignored: the most common
ones are, which keeps words that every name shares ("council", "department")
out of the join.  Pieces meet the inputs' substrings in one equi-join; length
and position limits discard most chance meetings inside it.

Below the threshold at which a piece must survive, names meet by the characters
they share (``sharing_pairs``): a name's characters, repeats numbered, are put in
one order, the rarest first, and two names that share enough of them share one
among the first few (the prefix rule of set similarity joins, Chaudhuri et al.,
ICDE 2006).

Arrays are opened with explode_outer: a plain explode adds a "not empty" filter
that is pushed down to the scan and computes the array once more for every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scoring import EditBound, char_signature, folded

# Pieces that may be ignored; measured best on names made of shared words.
DEFAULT_SPARE = 8
# Spare pieces are not cut shorter than this.
MIN_PIECE_LENGTH = 3
# A piece counts as common from this many candidates on.
COMMON_PIECE_ROWS = 8


def _piece_count(bound: EditBound, n: str, spare: int) -> str:
    """Pieces of a text of length ``n``: the needed ones, and spare ones while pieces keep their length."""
    need = bound.pieces_needed(n)
    return f"greatest({need}, least({need} + {spare}, {n} div {MIN_PIECE_LENGTH}))"


def candidate_pieces(candidates: DataFrame, bound: EditBound, spare: int) -> DataFrame:
    """``(candidate, cand_ord, c, cl, c0, c1, piece_no, pos, piece)`` for every piece."""
    c = (
        candidates.withColumn("c", F.lower("candidate")).where(F.length("c") > 0)
        .withColumn("cl", F.length("c"))
        .withColumns({"c0": char_signature("c", 0), "c1": char_signature("c", 1)})
        .withColumn("_m", F.expr(_piece_count(bound, "cl", spare)))
    )
    numbered = c.select("*", F.explode_outer(F.expr("sequence(0, _m - 1)")).alias("piece_no"))
    return (
        numbered.withColumn("pos", F.expr("cast(floor(piece_no * cl / _m) as int)"))
        .withColumn("_end", F.expr("cast(floor((piece_no + 1) * cl / _m) as int)"))
        .withColumn("piece", F.expr("substring(c, pos + 1, _end - pos)"))
        .drop("_m", "_end")
    )


def input_substrings(inputs: DataFrame, bound: EditBound, spare: int) -> DataFrame:
    """``(name, a, al, a0, a1, at, piece)``: substrings of each piece length a partner may use."""
    a = (
        inputs.withColumn("a", folded("name")).where(F.length("a") > 0).withColumn("al", F.length("a"))
        .withColumns({"a0": char_signature("a", 0), "a1": char_signature("a", 1)})
    )
    m = _piece_count(bound, "l", spare)
    sizes = (
        f"array_distinct(flatten(transform(sequence(greatest(1, {bound.min_len('al')}), {bound.max_len('al')}), "
        f"l -> array(cast(floor(l / {m}) as int), cast(ceil(l / {m}) as int)))))"
    )
    return (
        a.select("*", F.explode_outer(F.expr(f"filter({sizes}, q -> q <= al)")).alias("_q"))
        .where("_q is not null")
        .select("*", F.explode_outer(F.expr("sequence(0, al - _q)")).alias("at"))
        .withColumn("piece", F.expr("substring(a, at + 1, _q)")).drop("_q")
    )


def close_pairs(
    inputs: DataFrame,
    candidates: DataFrame,
    bound: EditBound,
    spare: int = DEFAULT_SPARE,
    split_rows: int = 10_000,
    spread_rows: int = 64,
    splits: int = 16,
) -> DataFrame:
    """Pairs that may reach the threshold: ``(name, a, candidate, cand_ord, c, differing)``.

    A superset of the qualifying pairs; a pair can come more than once.
    ``differing`` is a lower bound on inserted plus deleted characters.
    ``inputs(name)`` and ``candidates(candidate, cand_ord)`` hold distinct
    names.  A name is never paired with itself.  A piece shared by more than
    ``split_rows`` candidates has them split in parts of that many, ``splits`` at
    least; words common among candidates are common among inputs too, so the inputs
    of a piece are spread as well: one more part per ``spread_rows`` candidates up to
    ``splits``, then by the square root of their number.
    """
    if not bound.cuts:
        raise ValueError(f"no piece need survive at a threshold of {bound.threshold}; use sharing_pairs")
    pieces = candidate_pieces(candidates, bound, spare)
    common = (
        pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= COMMON_PIECE_ROWS)
        .withColumn("_parts", F.when(F.col("_n") >= split_rows, F.greatest(F.lit(splits), F.ceil(F.col("_n") / split_rows).cast("int"))).otherwise(1))
        .withColumn("_spread", F.greatest(F.least(F.lit(splits), F.ceil(F.col("_n") / spread_rows).cast("int")),
                                          F.ceil(F.sqrt(F.col("_n") / spread_rows)).cast("int")))
    )
    rarest = Window.partitionBy("candidate").orderBy(F.coalesce("_n", F.lit(0)), "piece_no")
    kept = (
        pieces.join(common, "piece", "left")
        .withColumn("_r", F.row_number().over(rarest))
        .where(F.col("_r") <= F.expr(bound.pieces_needed("cl")))
        .withColumn("_part", F.pmod(F.xxhash64("candidate"), F.coalesce("_parts", F.lit(1))).cast("int"))
        .withColumn("_copy", F.explode_outer(F.expr("sequence(0, coalesce(_spread, 1) - 1)")))
        .select("piece", "_part", "_copy", "candidate", "cand_ord", "c", "cl", "c0", "c1", "pos")
    )
    grams = (
        input_substrings(inputs, bound, spare)
        .join(common.where("_parts > 1 or _spread > 1").select("piece", "_parts", "_spread"), "piece", "left")
        .withColumn("_copy", F.pmod(F.xxhash64("name"), F.coalesce("_spread", F.lit(1))).cast("int"))
        .withColumn("_part", F.explode_outer(F.expr("sequence(0, coalesce(_parts, 1) - 1)")))
        .select("piece", "_part", "_copy", "name", "a", "al", "a0", "a1", "at")
    )
    shift, limit = "(at - pos)", bound.tolerance("al", "cl")
    differing = "bit_count(a0 ^ c0) + bit_count(a1 ^ c1)"
    # cheap tests first; the banded edit distance stops early on far pairs
    near = (
        f"cl between {bound.min_len('al')} and {bound.max_len('al')} and "
        f"abs({shift}) + abs(al - cl - {shift}) <= {limit} and "
        f"{differing} <= {bound.bits('al', 'cl')} and name <> candidate"
    )
    if not bound.ratio:
        near += f" and levenshtein(a, c, {limit}) >= 0"
    # few bytes go in and many pairs come out, so the parallelism is set here
    # rather than left to a size-based merge of shuffle partitions
    n = int(inputs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grams = grams.repartition(n, "piece", "_part", "_copy")
    k = kept.withColumnsRenamed({"piece": "_p", "_part": "_q", "_copy": "_c"}).repartition(n, "_p", "_q", "_c")
    same = (F.col("piece") == F.col("_p")) & (F.col("_part") == F.col("_q")) & (F.col("_copy") == F.col("_c"))
    return (
        grams.join(k, same & F.expr(near))
        .select("name", "a", "candidate", "cand_ord", "c", F.expr(differing).alias("differing"))
    )


def _character_tokens(names: DataFrame, text: str, length: str) -> DataFrame:
    """``(token, text)``: one row for each character of a text, the k-th occurrence as a token of its own."""
    chars = f"filter(array_distinct(split({text}, '')), ch -> ch <> '')"
    tokens = (
        f"flatten(transform({chars}, ch -> transform(sequence(1, length({text}) - length(replace({text}, ch, ''))), "
        f"k -> xxhash64(ch, k))))"
    )
    return names.select(text).distinct().withColumn(length, F.length(text)).select(text, length, F.explode_outer(F.expr(tokens)).alias("token"))


def _prefixes(tokens: DataFrame, common: DataFrame, bound: EditBound, text: str, length: str) -> DataFrame:
    """``(text, prefix)``: the first tokens of each text, rarest among candidates first."""
    ranked = tokens.join(common, "token", "left").groupBy(text, length).agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "token"))).alias("_all"))
    return ranked.select(text, F.expr(f"slice(transform(_all, t -> t.token), 1, {bound.prefix(length)})").alias("prefix"))


def sharing_pairs(inputs: DataFrame, candidates: DataFrame, bound: EditBound, block_rows: int = 2_000) -> DataFrame:
    """Pairs that may reach any threshold above 0: columns and inputs as ``close_pairs``.

    A superset of the qualifying pairs; each pair comes once.  Names of a token meet
    in cells of about ``block_rows`` names a side, so a character that all names hold
    is work for many tasks; a pair is looked at in the cell of the first token that
    both prefixes hold, and there length, character signature and (for the edit
    distance) the banded distance decide.  At a low threshold most names do share
    enough characters, so the work comes near the product of both sides; put a
    higher threshold first and give this join what is left.
    """
    a = inputs.withColumn("a", folded("name")).where(F.length("a") > 0)
    c = candidates.withColumn("c", F.lower("candidate")).where(F.length("c") > 0)
    c_tokens, a_tokens = _character_tokens(c, "c", "cl"), _character_tokens(a, "a", "al")
    common = c_tokens.groupBy("token").agg(F.count(F.lit(1)).alias("_n"))
    ap = _prefixes(a_tokens, common, bound, "a", "al").withColumnRenamed("prefix", "ap")
    cp = _prefixes(c_tokens, common, bound, "c", "cl").withColumnRenamed("prefix", "cp")
    ap, cp = ap.select("*", F.explode("ap").alias("token")), cp.select("*", F.explode("cp").alias("token"))

    def blocks(rows, name):
        return rows.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(name))

    cells = blocks(ap, "_spread").join(blocks(cp, "_parts"), "token")
    left = (
        a.join(ap, "a").join(cells, "token").withColumns({"a0": char_signature("a", 0), "a1": char_signature("a", 1), "al": F.length("a")})
        .withColumn("_copy", F.pmod(F.xxhash64("name"), F.col("_spread")).cast("int"))
        .withColumn("_part", F.explode(F.expr("sequence(0, _parts - 1)")))
        .select("token", "_part", "_copy", "name", "a", "al", "a0", "a1", "ap")
    )
    right = (
        c.join(cp, "c").join(cells, "token").withColumns({"c0": char_signature("c", 0), "c1": char_signature("c", 1), "cl": F.length("c")})
        .withColumn("_part", F.pmod(F.xxhash64("candidate"), F.col("_parts")).cast("int"))
        .withColumn("_copy", F.explode(F.expr("sequence(0, _spread - 1)")))
        .select(F.col("token").alias("_t"), F.col("_part").alias("_q"), F.col("_copy").alias("_c"), "candidate", "cand_ord", "c", "cl", "c0", "c1", "cp")
    )
    differing = "bit_count(a0 ^ c0) + bit_count(a1 ^ c1)"
    near = (
        f"cl between {bound.min_len('al')} and {bound.max_len('al')} and {differing} <= al + cl - 2 * {bound.overlap('al', 'cl')} "
        "and name <> candidate and array_intersect(ap, cp)[0] = token"
    )
    if not bound.ratio:
        near += f" and levenshtein(a, c, {bound.tolerance('al', 'cl')}) >= 0"
    # few bytes go in and many pairs come out, and cells are of bounded size, so the parallelism is set here
    n = int(inputs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left, right = left.repartition(n, "token", "_part", "_copy"), right.repartition(n, "_t", "_q", "_c")
    same = (F.col("token") == F.col("_t")) & (F.col("_part") == F.col("_q")) & (F.col("_copy") == F.col("_c"))
    return left.join(right.hint("merge"), same & F.expr(near)).select(
        "name", "a", "candidate", "cand_ord", "c", F.expr(differing).alias("differing"))
