"""Score name matchers against labelled pairs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators.rules import RULES
from ..operators.sampling import sample_candidates
from ..operators.scoring import SIMILARITY_THRESHOLD, folded, matching_blocks_ratio
from ..sources.tables import normalise_na, resolve_col
from .requests import accept_responses

# --- fixed values -----------------------------------------------------------
NUM_DISTRACTORS = 20
SEED = 42
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class RunConfig:
    """One evaluation run; several run as one job."""

    run_name: str
    scorer: str = "ratio"
    similarity_threshold: float = SIMILARITY_THRESHOLD
    num_distractors: int = NUM_DISTRACTORS
    seed: int = SEED
    prompt_file: str = ""
    prompt_sha: str = ""
    dataset_sha: str = ""


def labelled_rows(benchmark: DataFrame, id_col: str = "ID") -> DataFrame:
    """``(row_id, input_name, ground_truth, error_type, entity_type, negative)``, trimmed, null as ''."""
    src = normalise_na(benchmark, fill="")
    cols = {"input_name": "Input Name", "ground_truth": "Match Option",
            "error_type": "Error Type", "entity_type": "Entity Type"}
    return src.select(
        F.col(f"`{resolve_col(src, id_col)}`").alias("row_id"),
        *[t.trim_all(F.col(f"`{resolve_col(src, v)}`")).alias(k) for k, v in cols.items()],
    ).withColumn("negative", t.is_negative_control("error_type", "ground_truth"))


def candidate_pool(rows: DataFrame) -> DataFrame:
    """Distinct real options: ``(candidate)``."""
    return rows.select(t.trim_all("ground_truth").alias("candidate")).where(
        t.is_real_option("candidate")).distinct()


CONFIG_SCHEMA = (
    "run_name string, scorer string, similarity_threshold double, num_distractors int, seed int, "
    "prompt_file string, prompt_sha string, dataset_sha string"
)
SCORERS = ("ratio", "levenshtein", "cascade")
#: What tells one draw of candidates from another.
DRAW = ["num_distractors", "seed"]
Configs = Sequence[RunConfig] | DataFrame


def config_table(spark: SparkSession, configs: Configs) -> DataFrame:
    """The runs as a table with the columns of ``RunConfig``, one row a run."""
    if isinstance(configs, DataFrame):
        return configs.select(*[F.col(f).cast(t) for f, t in (c.split(" ") for c in CONFIG_SCHEMA.split(", "))])
    for c in configs:
        if c.scorer not in SCORERS:
            raise ValueError(f"unknown scorer {c.scorer!r}; use {', '.join(SCORERS)}")
    return spark.createDataFrame([astuple(c) for c in configs], CONFIG_SCHEMA)


def listed(rows: DataFrame, configs: Configs | RunConfig) -> DataFrame:
    """Drawn candidates, the asked name included if it was drawn: one row per draw and candidate.

    Runs with equal size and seed share their draw; ``num_distractors`` and ``seed``
    name it.  One run given by itself has one draw, and no such columns.
    """
    if isinstance(configs, RunConfig):
        return listed(rows, [configs]).drop(*DRAW)
    runs = config_table(rows.sparkSession, configs)
    draws = runs.agg(F.collect_set(F.struct(*DRAW))).scalar()
    every = rows.withColumn("_d", F.explode(draws)).select("*", *[F.col(f"_d.{c}").alias(c) for c in DRAW])
    return sample_candidates(
        every, candidate_pool(rows), ["row_id"], "input_name", "ground_truth", "negative",
        k=F.col("num_distractors"), seed=F.col("seed"), draw_cols=DRAW)


def offers(rows: DataFrame, configs: Configs | RunConfig) -> DataFrame:
    """Offered candidates, the asked name itself left out: one row per draw and candidate."""
    return listed(rows, configs).where(F.col("candidate") != F.col("input_name"))


# Rules that need no table of aliases.
_RULE_NOS = [i for i, r in enumerate(RULES, 1) if not r.startswith("alias")]


def rule_keys(names: DataFrame) -> DataFrame:
    """What the rules compare, once for each distinct ``name``: keys, words and acronyms."""
    keys = {"normalised": t.name_key("name"), "brackets": t.bracket_key("name"), "suffix": t.suffix_key("name"),
            "acronym": t.acronym_input("name"), "acronyms": t.acronym_keys("name")}
    return names.select("name").where("name is not null").distinct().withColumns(keys).withColumn(
        "words", F.array_distinct(F.split("suffix", " ")))


def _with_rule_no(pairs: DataFrame, keys: DataFrame) -> DataFrame:
    """Add the first rule by which the pair (``input_name``, ``candidate``) fits, else null.

    A name stands in many pairs, so its keys are looked up, not made again; one row a
    name on that side, so only the pairs can be skewed.
    """
    asked = ["normalised", "brackets", "suffix", "words", "acronym"]
    offered = ["normalised", "brackets", "suffix", "words", "acronyms"]
    keyed = (
        pairs.join(keys.select(F.col("name").alias("candidate"), *[F.col(k).alias(f"c_{k}") for k in offered]), "candidate", "left")
        .join(keys.select(F.col("name").alias("input_name"), *[F.col(k).alias(f"a_{k}") for k in asked]), "input_name", "left"))
    filled = (F.length("a_suffix") > 0) & (F.length("c_suffix") > 0)
    tests = {r: F.col(f"a_{r}") == F.col(f"c_{r}") for r in ("normalised", "brackets", "suffix")}
    tests["acronym"] = F.coalesce(F.array_contains("c_acronyms", F.col("a_acronym")), F.lit(False))
    tests["descriptor"] = filled & (F.size("c_words") < F.size("a_words")) & (
        F.size(F.array_except("c_words", "a_words")) == 0)
    tests["shortened"] = filled & (F.col("c_suffix").startswith(F.concat("a_suffix", F.lit(" ")))
                                   | F.col("c_suffix").endswith(F.concat(F.lit(" "), F.col("a_suffix"))))
    rule = F.coalesce(*[F.when(tests[RULES[i - 1]], i) for i in _RULE_NOS])
    return keyed.withColumn("rule_no", rule).select(*pairs.columns, "rule_no")


def best_offers(
    offered: DataFrame, ids: Sequence[str], least_ratio: float | Column, rules: bool | Column = True, names: DataFrame | None = None
) -> DataFrame:
    """What each scorer chooses from an offer: (ids, ``levenshtein``, ``ratio``, ``rule``).

    The first two are the best match with its score; ratios below ``least_ratio`` may
    be left out.  ``rule`` is the match of the first rule that fits one candidate only;
    without ``rules`` there is none.  ``names(name)`` holds all names of the offers and
    saves finding them there.
    """
    if names is None:
        names = offered.select(F.explode(F.array("input_name", "candidate")).alias("name"))
    a, c = folded("input_name"), F.lower("candidate")
    distance = F.levenshtein(a, c)
    longest = F.greatest(F.length(a), F.length(c))
    # M matched characters are a common subsequence, so the distance is at most la + lb - 2M = (1 - ratio) * (la + lb)
    most = (F.length(a) + F.length(c)) * (F.lit(1.0) - least_ratio) + F.lit(1e-6)
    # if no run asks for the rules, no name has keys, and no rule fits
    keys = rule_keys(names.where(rules if isinstance(rules, Column) else F.lit(rules)))
    scored = _with_rule_no(offered.select(*ids, "input_name", "candidate", "cand_ord"), keys).withColumns({
        "a": a, "c": c, "edits": F.when(longest > 0, 1.0 - distance / longest).otherwise(0.0), "near": distance <= most})
    # far pairs go to Python as nulls and come back as such
    scored = scored.withColumn("blocks", matching_blocks_ratio(F.when(F.col("near"), F.col("a")), F.when(F.col("near"), F.col("c"))))

    def best(score):
        return F.min(F.when(F.col(score) > 0, F.struct((-F.col(score)).alias("neg"), "cand_ord", "candidate")))

    by_rule = [F.count(F.when(F.col("rule_no") == i, 1)).alias(f"n{i}") for i in _RULE_NOS]
    by_rule += [F.min(F.when(F.col("rule_no") == i, F.col("candidate"))).alias(f"c{i}") for i in _RULE_NOS]
    found = scored.groupBy(*ids).agg(best("edits").alias("e"), best("blocks").alias("b"), *by_rule)
    return found.select(
        *ids, *[F.struct(F.col(f"{k}.candidate").alias("match"), (-F.col(f"{k}.neg")).alias("score")).alias(v)
                for k, v in (("e", "levenshtein"), ("b", "ratio"))],
        F.coalesce(*[F.when(F.col(f"n{i}") == 1, F.col(f"c{i}")) for i in _RULE_NOS]).alias("rule"))


def is_correct(negative, prediction, truth) -> Column:
    """Negative rows want no match, the others exactly their truth; 0 or 1."""
    p = F.col(prediction)
    return F.when(F.col(negative), p.isNull()).otherwise(
        F.coalesce(p == F.col(truth), F.lit(False))).cast("int")


def _run_rows(rows: DataFrame, runs: DataFrame, *columns: str) -> DataFrame:
    """Labelled rows for every run, with the run's columns; the runs come as one value, whatever their number."""
    every = runs.agg(F.collect_list(F.struct(*columns))).scalar()
    return rows.withColumn("_run", F.explode(every)).select("*", *[F.col(f"_run.{c}").alias(c) for c in columns]).drop("_run")


def predictions(rows: DataFrame, configs: Configs) -> DataFrame:
    """One row per labelled row and run.

    The runs are a table: every draw is made, and every offer scored, once for all
    runs that share it, and threshold and scorer are columns, so the plan does not
    grow with the number of runs.
    """
    runs = config_table(rows.sparkSession, configs)
    least = runs.agg(F.coalesce(F.min(F.when(F.col("scorer") != "levenshtein", F.col("similarity_threshold"))), F.lit(2.0))).scalar()
    ruled = runs.agg(F.max(F.col("scorer") == "cascade")).scalar()
    names = rows.select(F.explode(F.array("input_name", "ground_truth")).alias("name")).union(candidate_pool(rows))
    best = best_offers(offers(rows, runs), ["row_id", *DRAW], least, ruled, names)
    asked = _run_rows(rows, runs, "run_name", "scorer", "similarity_threshold", *DRAW)
    reached = lambda scorer: F.when(F.col(scorer)["score"] >= F.col("similarity_threshold"), F.col(scorer)["match"])
    match = (
        F.when(F.col("scorer") == "levenshtein", reached("levenshtein")).when(F.col("scorer") == "ratio", reached("ratio"))
        .when(F.col("scorer") == "cascade", F.coalesce("rule", reached("ratio")))
        .otherwise(F.raise_error(F.concat(F.lit("unknown scorer "), F.col("scorer")))))
    return _judged(asked.join(best, ["row_id", *DRAW], "left").withColumn("match", match))


def _judged(matched: DataFrame) -> DataFrame:
    """Labelled rows with ``run_name`` and ``match`` -> predictions, right or wrong."""
    return (
        matched.withColumn("prediction", t.clean_prediction("match"))
        .withColumn("correct", is_correct("negative", "prediction", "ground_truth"))
        .select("run_name", "row_id", "input_name", "ground_truth", "prediction", "correct", "error_type",
                "entity_type", F.col("negative").cast("int").alias("is_negative_control"))
    )


def predictions_from_responses(rows: DataFrame, responses: DataFrame, configs: Configs) -> DataFrame:
    """One row per labelled row and run, scored from a service's answers: (run_name, row_id, response).

    Only answers that the run's drawn list holds count; a row without one predicts no match.
    """
    runs = config_table(rows.sparkSession, configs)
    asked = _run_rows(rows, runs, "run_name", *DRAW)
    # a row's answer in a run, with the draw that the run used
    given = responses.select("run_name", "row_id", "response").join(asked.select("run_name", "row_id", *DRAW), ["run_name", "row_id"])
    given = accept_responses(given, listed(rows, runs), ["row_id", *DRAW])
    return _judged(asked.join(given.select("run_name", "row_id", "match"), ["run_name", "row_id"], "left"))


def accuracy_by(preds: DataFrame, keys: Sequence[str] = ("error_type", "entity_type")) -> DataFrame:
    """``(run_name, metric, rows, accuracy)``: overall and by each key, in one pass."""
    sets = [["run_name"]] + [["run_name", k] for k in keys]
    grouped: GroupedData = preds.groupingSets(sets, "run_name", *keys)
    metric = F.lit("accuracy_overall")
    for k in keys:
        prefix = f"accuracy_{k.removesuffix('_type')}_"
        metric = F.when(F.grouping(k) == 0, F.concat(F.lit(prefix), t.metric_slug(F.coalesce(F.col(k), F.lit(""))))) \
            .otherwise(metric)
    return grouped.agg(metric.alias("metric"), F.count(F.lit(1)).alias("rows"),
                       F.avg("correct").alias("accuracy")).select("run_name", "metric", "rows", "accuracy")


def run_summary(preds: DataFrame, rows: DataFrame, configs: Configs) -> DataFrame:
    """One record per run: parameters, overall accuracy and two accuracy maps."""
    keys = ["error_type", "entity_type"]
    cells = preds.groupingSets([["run_name"], *[["run_name", k] for k in keys]], "run_name", *keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg("correct").alias("a"),
        *[(F.grouping(k) == 0).alias(f"is_{k}") for k in keys])
    overall = ~F.col("is_error_type") & ~F.col("is_entity_type")
    # a handful of cells per run
    out = cells.groupBy("run_name").agg(
        F.max(F.when(overall, F.col("a"))).alias("accuracy_overall"), F.max(F.when(overall, F.col("n"))).alias("rows"),
        *[F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col(f"is_{k}"), F.struct(k, "a")))))
          .alias(f"accuracy_by_{k}") for k in keys])
    pool_size = candidate_pool(rows).agg(F.count(F.lit(1))).scalar()
    fields = ["prompt_file", "prompt_sha", "dataset_sha", "similarity_threshold", "num_distractors", "seed"]
    runs = config_table(rows.sparkSession, configs).select("run_name", *fields)
    return out.join(runs, "run_name", "left").withColumn("candidate_pool_size", pool_size)
