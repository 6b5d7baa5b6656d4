"""Time-varying curriculum: source targets, training positions from integrated weight schedules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, keep_columns, word_count

#: Relative weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: Weight over training time, as (time, weight) knots with straight lines between, repeating over the sources.
SCHEDULES = (((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.5), (1.0, 0.5)))
EPOCHS = 3
#: Leading hex digits of a document's hash that name its bin within a source.
BIN_DIGITS = 3


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """One row per source: ``source_no``, ``source_size``, ``target``.

    Targets share the sum of all sizes by weight, none above ``epochs`` times its
    source; what is above goes to the others by weight.  That is the level ``l``
    with sum(min(l * weight, cap)) = total: sources in order of cap / weight are
    full up to the first one that the level leaves below its cap.
    """
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(int(w)) for w in weights])
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("source_no", F.row_number().over(by_code_point) - 1)
    s = s.withColumn("weight", F.element_at(listed, (F.col("source_no") % len(weights) + 1).cast("int")).cast("long"))
    s = s.withColumn("cap", F.col("source_size") * epochs)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    everyone = Window.partitionBy()
    s = s.withColumns({
        "place": F.row_number().over(fill),
        "full_before": F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"),
        "weight_left": F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)),
        "total": F.sum("source_size").over(everyone),
    })
    s = s.withColumn("level", (F.col("total") - F.col("full_before")) / F.col("weight_left"))
    s = s.withColumn("below", F.col("level") * F.col("weight") < F.col("cap"))
    first = F.min(F.when(F.col("below"), F.struct("place", "level"))).over(everyone)
    s = s.withColumn("first", first)
    full = F.col("first").isNull() | (F.col("place") < F.col("first.place"))
    target = F.when(full, F.col("cap").cast("double")).otherwise(F.col("first.level") * F.col("weight"))
    return s.select("source", "source_no", "source_size", target.alias("target"))


def invert_demand(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Time at which the integral of a schedule reaches ``share`` of its whole."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    whole, before, out = sum(areas), 0.0, F.lit(float(knots[-1][0]))
    pieces = []
    for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas):
        a = F.greatest(share * F.lit(whole) - F.lit(before), F.lit(0.0))
        root = F.sqrt(F.lit(w0 * w0) + a * F.lit(2 * (w1 - w0) / (t1 - t0)))
        step = F.when(a > 0, F.lit(2.0) * a / (F.lit(w0) + root)).otherwise(F.lit(0.0))
        before += area
        pieces.append((share * F.lit(whole) <= F.lit(before), F.lit(t0) + step))
    for inside, time in reversed(pieces):
        out = F.when(inside, time).otherwise(out)
    return out


def allocate(
    docs: DataFrame, size: Column, seed: str = "mix", weights: Sequence[int] = WEIGHTS,
    schedules: Sequence = SCHEDULES, epochs: int = EPOCHS,
) -> DataFrame:
    """What the mix takes of every row: one row per row of ``docs``.

    Each source's documents stand in the order of a seeded hash of their id and
    form a stream of words, repeated ``epochs`` times; the mix takes the stream's
    first ``target`` words, so the last document reached counts in part.  A copy
    that begins at word c trains at the time when the source's schedule has asked
    for c of its target words (``position``, from 0 to 1).  Running sums go by bins
    of the hash, so that a large source is no single task; equal rows are one run.

    Null ids sort first, a null source is a source of its own, null texts have size 0;
    an empty table gives none.  Columns: doc_id, source, text_hash, size, i (number
    among equal rows), n (equal rows), source_no, source_size, target, start, taken.
    """
    text_hash = F.xxhash64("text")
    order = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")))
    sized = cut(docs.select("doc_id", "source", text_hash.alias("text_hash"), size.cast("long").alias("size")))
    targets = source_targets(sized, weights, epochs)
    runs = sized.groupBy("doc_id", "source", "text_hash", "size").agg(F.count("*").alias("n")).withColumn("h", order)
    runs = runs.withColumn("bin", F.substring("h", 1, BIN_DIGITS)).withColumn("words", F.col("size") * F.col("n"))
    by_bin = Window.partitionBy("source").orderBy("bin")
    bins = runs.groupBy("source", "bin").agg(F.sum("words").alias("bin_words"))
    bins = bins.select(F.col("source").alias("b_source"), F.col("bin").alias("b_bin"),
                       (F.sum("bin_words").over(by_bin) - F.col("bin_words")).alias("bin_start"))
    inside = Window.partitionBy("source", "bin").orderBy("h", "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    runs = runs.withColumn("run_start", F.sum("words").over(inside) - F.col("words"))
    runs = runs.join(bins, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bin") == F.col("b_bin")))
    t = targets.withColumnRenamed("source", "t_source")
    runs = runs.join(t, F.col("source").eqNullSafe(F.col("t_source")))
    # a run of equal rows opens in two steps, so that no array grows with it
    block = 1024
    rows = runs.withColumn("block", F.explode(F.expr(f"sequence(0L, (n - 1) div {block})")))
    rows = rows.withColumn("i", F.explode(F.expr(f"sequence(block * {block}, least(n, (block + 1) * {block}) - 1)")))
    rows = rows.withColumn("start", F.col("bin_start") + F.col("run_start") + F.col("i") * F.col("size"))
    words = F.floor(F.col("target") + F.lit(0.5)).cast("long")
    taken = sum((F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), words - F.col("source_size") * k - F.col("start")))
                 for k in range(epochs)), F.lit(0).cast("long"))
    return rows.select("doc_id", "source", "text_hash", "size", "i", "n", "source_no", "source_size", "target", "start", taken.alias("taken"))


def position(offset: Column, schedules: Sequence = SCHEDULES) -> Column:
    """Training time of the copy that begins at word ``offset`` of its source's stream."""
    share = F.when(F.col("target") > 0, offset / F.col("target")).otherwise(F.lit(0.0))
    out = None
    for k, knots in enumerate(schedules):
        here = F.col("source_no") % len(schedules) == k
        out = F.when(here, invert_demand(share, knots)) if out is None else out.when(here, invert_demand(share, knots))
    return out


def _copies(epochs: int) -> Column:
    """How often a row is trained on: until its taken words are used up; a row without words, in each round that reaches it."""
    words = F.floor(F.col("target") + F.lit(0.5))
    reached = sum((F.when((F.col("start") + F.col("source_size") * k < words) | ((F.col("source_size") == 0) & F.lit(k == 0)), 1).otherwise(0)
                   for k in range(epochs)), F.lit(0))
    some = F.expr("cast((taken - 1) div size as int) + 1")
    return F.when(F.col("size") == 0, reached).when(F.col("taken") > 0, some).otherwise(0)


def _placed(docs: DataFrame, added: Sequence[str], size: Column, seed: str, weights, schedules, epochs: int) -> DataFrame:
    """Every row as ``row``, without the columns of ``added``, beside its size, source_size, target, taken and positions."""
    kept = keep_columns(docs, list(added))
    key = F.xxhash64("doc_id", "source", "text_hash", "size").alias("key")
    plan = allocate(docs, size, seed, weights, schedules, epochs).withColumn("copies", _copies(epochs))
    numbers = F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array().cast("array<int>"))
    positions = F.transform(numbers, lambda k: position(F.col("start") + k * F.col("source_size"), schedules))
    plan = cut(plan.select(F.col("doc_id").alias("p_id"), key, "i", "n", "size", "source_size", "target", "taken", positions.alias("positions")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), "doc_id", "source",
                       F.xxhash64("text").alias("text_hash"), size.cast("long").alias("size"))
    rows = rows.select("row", "doc_id", key)
    # rows without an equal meet their plan at once; equal rows, if there are any, are numbered first
    one, several = plan.filter("n = 1").drop("i", "n"), plan.filter("n > 1").drop("n")
    both = rows.join(one, "key")
    if not several.isEmpty():
        equal = rows.join(several.select("key").distinct(), "key", "left_semi")
        equal = equal.withColumn("i", F.row_number().over(Window.partitionBy("key", "doc_id").orderBy(F.lit(1))) - 1).join(several, ["key", "i"])
        both = both.unionByName(equal.drop("i"))
    return both.filter(F.col("doc_id").eqNullSafe(F.col("p_id"))).select("row", "doc_id", "size", "source_size", "target", "taken", "positions")


def mixed_documents(
    docs: DataFrame, size: Column, seed: str = "mix", weights: Sequence[int] = WEIGHTS,
    schedules: Sequence = SCHEDULES, epochs: int = EPOCHS,
) -> DataFrame:
    """The rows of ``docs``, each once, range-sorted by their first training position, those not taken last.

    Adds ``source_size``, ``target``, ``taken`` and ``positions`` (of all copies, in
    order); they replace namesakes of the input.  Rows as in ``allocate``; a row of
    size 0 takes no words, and has a position for each round that reaches its place
    (one, if its whole source has no words).
    """
    added = ["source_size", "target", "taken", "positions"]
    kept = keep_columns(docs, added)
    rows = _placed(docs, added, size, seed, weights, schedules, epochs)
    return rows.orderBy(F.get("positions", 0).asc_nulls_last(), "doc_id").select(*[F.col(f"row.`{c}`") for c in kept], *added)


def training_order(
    docs: DataFrame, size: Column, seed: str = "mix", weights: Sequence[int] = WEIGHTS,
    schedules: Sequence = SCHEDULES, epochs: int = EPOCHS,
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, sorted by training position.

    Adds ``position`` and ``mix_words`` (words to train on: all, or fewer in the
    last document that a source gives).  Both replace namesakes of the input.  A row
    of size 0 (a null, empty or blank text) stays, with 0 words, once for each round
    of its source that reaches its place.
    """
    added = ["position", "mix_words"]
    kept = keep_columns(docs, added)
    rows = _placed(docs, added, size, seed, weights, schedules, epochs)
    rows = rows.select("row", "doc_id", "size", "taken", F.posexplode("positions").alias("k", "position"))
    words = F.least(F.col("size"), F.col("taken") - F.col("k") * F.col("size"))
    return rows.withColumn("mix_words", words).select(
        *[F.col(f"row.`{c}`") for c in kept], "position", "mix_words", F.col("doc_id").alias("_id")
    ).orderBy("position", "_id").drop("_id")


def mix_digest(documents: DataFrame) -> DataFrame:
    """What the mix takes of every document, from the whole documents sorted by first training position (null: none taken)."""
    size = word_count(F.col("text"))
    mixed = mixed_documents(documents.select("doc_id", "source", "text"), size)
    return mixed.select("doc_id", size.alias("size"), "source_size", "target", "taken",
                        F.when(F.col("taken") > 0, F.get("positions", 0)).alias("position"))


#: The same result in DuckDB.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT *, CASE (source_no % 3) WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS cap FROM (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no
    FROM d GROUP BY source)
), f AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, source_no) AS place,
    CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
      / CAST(sum(weight) OVER (ORDER BY cap / weight, source_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
  FROM s
), u AS (
  SELECT min(place) AS place, arg_min(level, place) AS level FROM f WHERE level * weight < cap
), t AS (
  SELECT f.source, f.source_no, f.source_size,
    CASE WHEN u.place IS NULL OR f.place < u.place THEN CAST(f.cap AS DOUBLE) ELSE u.level * f.weight END AS target
  FROM f, u
), r AS (
  SELECT doc_id, size, source, CAST(sum(size) OVER (PARTITION BY source
      ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix'), doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
  FROM d
), a AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, t.source_no, r.start,
    greatest(0, least(r.size, w - r.start)) + greatest(0, least(r.size, w - r.start - t.source_size))
      + greatest(0, least(r.size, w - r.start - 2 * t.source_size)) AS taken
  FROM r JOIN (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS w FROM t) t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, taken,
  CASE WHEN taken = 0 THEN NULL WHEN start / target <= 0 THEN 0.0
       WHEN source_no % 3 = 0 THEN 2.0 * (start / target) / (0.5 + sqrt(0.25 + (start / target) * 2.0))
       WHEN source_no % 3 = 1 THEN 2.0 * (start / target) / (1.0 + sqrt(1.0 + (start / target) * 0.0))
       ELSE 2.0 * (start / target) / (1.5 + sqrt(2.25 + (start / target) * -2.0)) END AS position
FROM a
"""
