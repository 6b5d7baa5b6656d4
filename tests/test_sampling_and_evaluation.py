from collections import Counter

import pytest
from pyspark.sql import functions as F

from spendtally.operators.joins import pending_runs
from spendtally.operators.ordinals import dense_ordinals
from spendtally.operators.sampling import draw_ordinals, sample_candidates
from spendtally.plans import evaluate as ev
from spendtally.plans import requests as rq
from spendtally.schemas import BENCHMARK, RUN_KEYS, RUN_LEDGER

COLS = ["row_id"], "input_name", "ground_truth", "negative"


def draw(spark, rows, pool, k, seed=42):
    inputs = spark.createDataFrame(rows, "row_id int, input_name string, ground_truth string, negative boolean")
    names = spark.createDataFrame([(p,) for p in pool], "candidate string")
    out = {}
    for r in sample_candidates(inputs, names, *COLS, k=k, seed=seed).orderBy("cand_ord").collect():
        out.setdefault(r.row_id, []).append(r.candidate)
    return out


def test_positive_holds_truth_once(spark):
    got = draw(spark, [(1, "x", "A", False)], "ABCDE", 2)[1]
    assert len(got) == 3 and got.count("A") == 1 and len(set(got)) == 3


def test_negative_never_holds_truth(spark):
    got = draw(spark, [(1, "x", "A", True)], "ABCDE", 3)[1]
    assert len(got) == 3 and "A" not in got


def test_small_pool_and_unknown_truth(spark):
    got = draw(spark, [(1, "x", "A", False), (2, "y", "Q", False), (3, "z", "N/A", True)], "ABC", 20)
    assert sorted(got[1]) == ["A", "B", "C"]
    assert sorted(got[2]) == ["A", "B", "C", "Q"]
    assert sorted(got[3]) == ["A", "B", "C"]


def test_same_seed_same_draw(spark):
    rows = [(i, f"n{i}", "A", True) for i in range(20)]
    pool = [chr(65 + i) for i in range(26)]
    assert draw(spark, rows, pool, 5) == draw(spark, rows[::-1], pool[::-1], 5)
    assert draw(spark, rows, pool, 5) != draw(spark, rows, pool, 5, seed=43)


def test_draws_are_even(spark):
    df = spark.range(4000).select(F.explode(draw_ordinals(7, F.col("id"), F.lit(10), 3)).alias("o"))
    counts = Counter(r.o for r in df.collect())
    assert sorted(counts) == list(range(10)) and sum(counts.values()) == 12000
    assert all(1050 < c < 1350 for c in counts.values())


def test_ordinals_are_dense(spark):
    df = spark.range(5000).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("v"))
    got = [r.ordinal for r in dense_ordinals(df.union(df), "v").collect()]
    assert sorted(got) == list(range(5000))


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        (1, "Home Ofice", "Home Office", "Typo", "Buyer", "x"),
        (2, "DWP", "Department for Work and Pensions", "Acronym", "Buyer", "x"),
        (3, "Cabinet Office (CO)", " Cabinet Office ", "Brackets", "Buyer", "x"),
        (4, "Rutland County Council", "N/A", "Negative control - no match", "Buyer", "x"),
        (5, "N/A", "Ministry of Unicorn Affairs", "Negative control - spurious", "Buyer", "x"),
        (6, "Capgem ini", "Capgemini", "Typo", "Supplier", "x"),
    ]
    return ev.labelled_rows(spark.createDataFrame(data, BENCHMARK)).cache()


def test_rows_and_pool(rows):
    by_id = {r.row_id: r for r in rows.collect()}
    assert by_id[5].input_name == "" and by_id[4].ground_truth == ""
    assert [by_id[i].negative for i in range(1, 7)] == [False, False, False, True, True, False]
    assert sorted(r.candidate for r in ev.candidate_pool(rows).collect()) == [
        "Cabinet Office", "Capgemini", "Department for Work and Pensions", "Home Office", "Ministry of Unicorn Affairs"]


def test_predictions_of_three_scorers(rows):
    configs = [ev.RunConfig("lev", "levenshtein"), ev.RunConfig("ratio"), ev.RunConfig("rules", "cascade")]
    preds = ev.predictions(rows, configs).cache()
    right = {(r.run_name, r.row_id) for r in preds.where("correct = 1").collect()}
    assert right == {("lev", i) for i in (1, 4, 5, 6)} | {("ratio", i) for i in (1, 4, 5, 6)} | {
        ("rules", i) for i in range(1, 7)}
    acc = {(r.run_name, r.metric): r.accuracy for r in ev.accuracy_by(preds).collect()}
    assert acc["ratio", "accuracy_overall"] == pytest.approx(4 / 6)
    assert acc["rules", "accuracy_error_negative_control___no_match"] == 1.0
    assert acc["ratio", "accuracy_entity_supplier"] == 1.0 and acc["lev", "accuracy_error_acronym"] == 0.0
    assert len(acc) == 3 * (1 + 5 + 2)
    summary = {r.run_name: r for r in ev.run_summary(preds, rows, configs).collect()}
    assert summary["lev"].rows == 6 and summary["lev"].candidate_pool_size == 5 and summary["lev"].seed == 42
    assert summary["rules"].accuracy_by_error_type["Acronym"] == 1.0
    assert summary["ratio"].accuracy_by_entity_type == {"Buyer": 0.6, "Supplier": 1.0}


def test_unknown_scorer(rows):
    with pytest.raises(ValueError):
        ev.predictions(rows, [ev.RunConfig("x", "magic")])


def test_requests_and_answers(spark, rows):
    offered = ev.offers(rows, ev.RunConfig("r"))
    prompts = rq.prompt_requests(offered, ["row_id"], "Q {input_name} of {candidates}").collect()
    assert len(prompts) == 6 and all(p.prompt.startswith(f"Q {p.input_name} of ") for p in prompts)
    answers = spark.createDataFrame(
        [(1, '{"match": "Home Office"}'), (2, '{"match": null}'), (3, "somebody"), (6, '"Capgemini"')],
        "row_id int, response string")
    got = {r.row_id: r.match for r in rq.accept_responses(answers, offered, ["row_id"]).collect()}
    assert got == {1: "Home Office", 2: None, 3: None, 6: "Capgemini"}


def test_echoed_answer_stays_if_listed(spark):
    listed = spark.createDataFrame([(1, "A"), (1, "B"), (2, "B")], "row_id int, candidate string")
    answers = spark.createDataFrame([(1, '{"match": "A"}'), (2, '{"match": "A"}')], "row_id int, response string")
    assert {r.row_id: r.match for r in rq.accept_responses(answers, listed, ["row_id"]).collect()} == {1: "A", 2: None}


def test_pending_runs(spark):
    done = [("p1", "s1", "d", 20, 42, 0.85), ("p1", "s1", "d", 20, 42, 0.85)]
    todo = done[:1] + [("p1", "s2", "d", 20, 42, 0.85), ("p1", "s1", "d", 20, 42, 0.9)]
    left = pending_runs(spark.createDataFrame(todo, RUN_LEDGER), spark.createDataFrame(done, RUN_LEDGER), RUN_KEYS)
    assert sorted((r.prompt_sha, r.similarity_threshold) for r in left.collect()) == [("s1", 0.9), ("s2", 0.85)]


def test_pruned_ratios_equal_all_ratios(spark):
    import random
    from difflib import SequenceMatcher

    rng = random.Random(4)
    names = ["".join(rng.choice("abc ") for _ in range(rng.randint(1, 12))).strip() or "a" for _ in range(40)]
    offered = spark.createDataFrame(
        [(i, a, c, j) for i, a in enumerate(names) for j, c in enumerate(names) if a != c],
        "row_id int, input_name string, candidate string, cand_ord int")
    for threshold in (0.3, 0.6, 0.85):
        best = ev.best_offers(offered, ["row_id"], threshold).where(f"ratio.score >= {threshold}")
        got = dict(best.select("row_id", "ratio.match").collect())
        want = {}
        for i, a in enumerate(names):
            scores = [(-SequenceMatcher(None, a, c).ratio(), j, c) for j, c in enumerate(names) if a != c]
            if scores and -min(scores)[0] >= threshold:
                want[i] = min(scores)[2]
        assert got == want


def test_answers_to_two_prompts(rows):
    right = rows.select(F.lit("a").alias("run_name"), "row_id", F.to_json(F.struct(F.col("ground_truth").alias("match"))).alias("response"))
    runs = [ev.RunConfig("a"), ev.RunConfig("b", seed=7)]
    got = {}
    for r in ev.predictions_from_responses(rows, right, runs).collect():
        got.setdefault(r.run_name, []).append(r)
    assert len(got["a"]) == len(got["b"]) == rows.count()
    assert all(r.correct for r in got["a"]) and all(r.prediction is None for r in got["b"])
    assert all(r.correct == r.is_negative_control for r in got["b"])


def test_runs_are_a_table_and_the_plan_does_not_grow(spark, rows):
    few = [ev.RunConfig("r0")]
    many = [ev.RunConfig(f"r{i}", ev.SCORERS[i % 3], 0.4 + 0.05 * (i % 11), 2 + i % 3, 40 + i % 2) for i in range(40)]
    size = lambda runs: len(ev.predictions(rows, runs)._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert size(few) == size(many)
    alone = {r.run_name: (r["rows"], r.accuracy) for c in many[:6] for r in ev.accuracy_by(ev.predictions(rows, [c])).where("metric = 'accuracy_overall'").collect()}
    together = ev.accuracy_by(ev.predictions(rows, ev.config_table(spark, many))).where("metric = 'accuracy_overall'").collect()
    assert len(together) == 40 and all((r["rows"], r.accuracy) == alone[r.run_name] for r in together if r.run_name in alone)
    with pytest.raises(Exception, match="unknown scorer"):
        bad = ev.config_table(spark, few).withColumn("scorer", F.lit("magic"))
        ev.predictions(rows, bad).collect()


def test_rule_keys_are_made_once_for_a_name(spark):
    names = spark.createDataFrame([("Alpha Beta Ltd",), ("Alpha Beta Ltd",), (None,), ("ABL",)], "name string")
    keys = {r.name: r for r in ev.rule_keys(names).collect()}
    assert set(keys) == {"Alpha Beta Ltd", "ABL"} and ev.rule_keys(names).count() == 2
    assert keys["Alpha Beta Ltd"].suffix == "alpha beta" and keys["ABL"].acronym == "ABL"
    offered = spark.createDataFrame(
        [(1, "Alpha Beta", "Alpha Beta Ltd", 1), (1, "Alpha Beta", "Gamma", 2), (2, "ABL", "Alpha Beta Ltd", 1)],
        "row_id int, input_name string, candidate string, cand_ord int")
    listed = offered.select(F.explode(F.array("input_name", "candidate")).alias("name"))
    for given in (None, listed):
        best = {r.row_id: r.rule for r in ev.best_offers(offered, ["row_id"], 0.85, names=given).collect()}
        assert best == {1: "Alpha Beta Ltd", 2: "Alpha Beta Ltd"}
    assert ev.best_offers(offered, ["row_id"], 0.85, False).where("rule is not null").count() == 0
