"""Labelled pairs made from every part name; sampling, scoring and run bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.joins import pending_runs as not_yet_run
from ..operators.joins import with_default
from ..plans import evaluate as ev
from ..plans import requests as rq
from ..schemas import RUN_KEYS
from ..sources.prompts import file_stem
from . import shapes as sh
from .book import Book

query = Book()

K, SEED = 20, 42
PROMPT = "Input name:\n{input_name}\n\nCandidate names:\n{candidates}\n\nAnswer with one candidate or None."

_ROWS_SQL = """
raw AS (
  SELECT p_partkey, p_name || ' ' || p_brand || ' ' || lower(p_type) AS name, p_size % 6 AS kind, p_type FROM part),
labelled AS (
  SELECT p_partkey AS row_id,
    CASE kind WHEN 0 THEN '' WHEN 1 THEN upper(name) WHEN 2 THEN name || ' (UK)' WHEN 3 THEN name || ' Ltd'
      WHEN 4 THEN substr(name, 1, 2) || substr(name, 4) ELSE 'Unknown Body ' || p_partkey END AS input_name,
    CASE kind WHEN 5 THEN '' ELSE name END AS ground_truth,
    CASE kind WHEN 0 THEN 'Negative control - spurious' WHEN 1 THEN 'Special character' WHEN 2 THEN 'Brackets'
      WHEN 3 THEN 'Legal entity suffix' WHEN 4 THEN 'Typo' ELSE 'Negative control - no match' END AS error_type,
    CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'Buyer' ELSE 'Supplier' END AS entity_type,
    kind IN (0, 5) AS negative FROM raw),
pool AS (SELECT candidate, row_number() OVER (ORDER BY substr(md5(candidate), 1, 3), candidate) - 1 AS ordinal
  FROM (SELECT DISTINCT ground_truth AS candidate FROM labelled WHERE ground_truth <> ''))
"""
_OFFERS_SQL = "RECURSIVE " + _ROWS_SQL.strip() + f""",
base AS (
  SELECT l.*, row_id || '|' || input_name AS key, p.ordinal AS truth_ord,
    (SELECT count(*) FROM pool) - CASE WHEN p.ordinal IS NULL THEN 0 ELSE 1 END AS size
  FROM labelled l LEFT JOIN pool p ON candidate = ground_truth),
draw AS (
  SELECT row_id, key, size, greatest(size - {K}, 0) AS j, []::BIGINT[] AS drawn FROM base
  UNION ALL
  SELECT row_id, key, size, j + 1, list_append(drawn, CASE WHEN list_contains(drawn, t) THEN j ELSE t END) FROM (
    SELECT *, ('0x' || substr(md5(concat_ws('|', '{SEED}', key, j::VARCHAR)), 1, 15))::BIGINT % (j + 1) AS t
    FROM draw WHERE j < size)),
picked AS (
  SELECT b.row_id, b.key, CASE WHEN o >= truth_ord THEN o + 1 ELSE o END AS ordinal FROM (
    SELECT row_id, unnest(drawn) AS o FROM draw WHERE j = size) d JOIN base b USING (row_id)),
offered AS (
  SELECT row_id, candidate, ('0x' || substr(md5(concat_ws('|', '{SEED}', 'shuffle', key, candidate)), 1, 15))::BIGINT AS cand_ord
  FROM (SELECT row_id, key, candidate FROM picked JOIN pool USING (ordinal)
    UNION ALL SELECT row_id, key, ground_truth FROM base WHERE NOT negative))
"""
_PREDICTED_SQL = _OFFERS_SQL + """,
scored AS (
  SELECT row_id, candidate, cand_ord, 1.0::DOUBLE - levenshtein(lower(input_name), lower(candidate))::DOUBLE
    / greatest(length(input_name), length(candidate))::DOUBLE AS score
  FROM offered JOIN labelled USING (row_id) WHERE candidate <> input_name),
chosen AS (
  SELECT row_id, candidate AS prediction FROM scored WHERE score >= 0.85
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY score DESC, cand_ord, candidate) = 1),
predicted AS (
  SELECT l.*, prediction, CASE WHEN negative THEN (prediction IS NULL)::INT
    ELSE coalesce(prediction = ground_truth, false)::INT END AS correct
  FROM labelled l LEFT JOIN chosen USING (row_id))
"""


def _benchmark(spark, sf):
    """Parts as a labelled set in the exchanged column layout."""
    name, kind = F.concat_ws(" ", "p_name", "p_brand", F.lower("p_type")), F.col("p_size") % 6
    key = F.col("p_partkey").cast("string")
    return sh.table(spark, sf, "part").select(
        F.col("p_partkey").alias("ID"),
        F.when(kind == 0, "N/A").when(kind == 1, F.upper(name)).when(kind == 2, F.concat(name, F.lit(" (UK)")))
        .when(kind == 3, F.concat(name, F.lit(" Ltd")))
        .when(kind == 4, F.concat(F.substring(name, 1, 2), F.substr(name, F.lit(4))))
        .otherwise(F.concat(F.lit("Unknown Body "), key)).alias("Input Name"),
        F.when(kind == 5, "N/A").otherwise(name).alias("Match Option"),
        F.when(kind == 0, "Negative control - spurious").when(kind == 1, "Special character")
        .when(kind == 2, "Brackets").when(kind == 3, "Legal entity suffix").when(kind == 4, "Typo")
        .otherwise("Negative control - no match").alias("Error Type"),
        F.when(F.col("p_type").isin("ECONOMY", "SMALL"), "Buyer").otherwise("Supplier").alias("Entity Type"))


def _rows(spark, sf):
    return ev.labelled_rows(_benchmark(spark, sf))


def _lev():
    return ev.RunConfig("levenshtein", "levenshtein", prompt_file="none.txt")


@query(f"WITH {_ROWS_SQL} SELECT row_id, input_name, ground_truth, error_type, entity_type, negative FROM labelled")
def labelled_rows(spark, sf):
    return _rows(spark, sf)


@query(f"WITH {_ROWS_SQL} SELECT candidate FROM pool")
def candidate_pool(spark, sf):
    return ev.candidate_pool(_rows(spark, sf))


@query(f"WITH {_ROWS_SQL} SELECT candidate, ordinal::BIGINT AS ordinal FROM pool")
def dense_ordinals(spark, sf):
    from ..operators.ordinals import dense_ordinals as number

    return number(ev.candidate_pool(_rows(spark, sf)), "candidate")


@query(f"WITH {_OFFERS_SQL} SELECT row_id, candidate, cand_ord FROM offered")
def sample_candidates(spark, sf):
    from ..operators.sampling import sample_candidates as sample

    rows = _rows(spark, sf)
    drawn = sample(rows, ev.candidate_pool(rows), ["row_id"], "input_name", "ground_truth", "negative", k=K, seed=SEED)
    return drawn.select("row_id", "candidate", "cand_ord")


@query(f"""WITH {_PREDICTED_SQL} SELECT 'levenshtein' AS run_name, row_id, input_name, ground_truth, prediction,
  correct::BIGINT AS correct, error_type, entity_type, negative::BIGINT AS is_negative_control FROM predicted""")
def predictions(spark, sf):
    return ev.predictions(_rows(spark, sf), [_lev()]).withColumns({
        "correct": F.col("correct").cast("bigint"), "is_negative_control": F.col("is_negative_control").cast("bigint")})


@query(f"""WITH {_PREDICTED_SQL},
  g AS (SELECT error_type, entity_type, count(*)::BIGINT AS n, avg(correct) AS accuracy FROM predicted
    GROUP BY GROUPING SETS ((), (error_type), (entity_type)))
  SELECT 'levenshtein' AS run_name, CASE WHEN error_type IS NOT NULL THEN 'accuracy_error_' ||
      replace(replace(lower(error_type), ' ', '_'), '-', '_')
    WHEN entity_type IS NOT NULL THEN 'accuracy_entity_' || lower(entity_type) ELSE 'accuracy_overall' END AS metric,
    n AS rows, accuracy FROM g""")
def accuracy_by(spark, sf):
    return ev.accuracy_by(ev.predictions(_rows(spark, sf), [_lev()]))


def _keyed_sql(side: str, name: str) -> str:
    keys = {"k1": sh.NAME_KEY_SQL, "k2": sh.BRACKET_KEY_SQL, "k3": sh.SUFFIX_KEY_SQL}
    return ", ".join(f"{v.replace('{x}', name)} AS {side}{k}" for k, v in keys.items())


# no input is a single word, so the acronym rule has no counterpart here
@query(f"""WITH {_PREDICTED_SQL.replace("offered AS (", "listed AS (", 1).replace("FROM offered JOIN", "FROM listed JOIN")},
  offered AS (SELECT row_id, candidate, cand_ord, lower(trim(input_name)) AS p, lower(candidate) AS q,
      {_keyed_sql("a", "input_name")}, {_keyed_sql("c", "candidate")}
    FROM listed JOIN labelled USING (row_id) WHERE candidate <> input_name), {sh.ratios_sql()},
  by_ratio AS (SELECT row_id, candidate FROM offered JOIN ratios USING (p, q) WHERE ratio >= 0.85
    QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY ratio DESC, cand_ord, candidate) = 1),
  fits AS (SELECT row_id, candidate, CASE WHEN ak1 = ck1 THEN 1 WHEN ak2 = ck2 THEN 2 WHEN ak3 = ck3 THEN 3
      WHEN ak3 <> '' AND ck3 <> '' AND list_has_all(string_split(ak3, ' '), string_split(ck3, ' '))
        AND len(list_distinct(string_split(ck3, ' '))) < len(list_distinct(string_split(ak3, ' '))) THEN 6
      WHEN ak3 <> '' AND (starts_with(ck3, ak3 || ' ') OR ends_with(ck3, ' ' || ak3)) THEN 7 END AS rule_no FROM offered),
  single AS (SELECT row_id, rule_no, min(candidate) AS candidate FROM fits WHERE rule_no IS NOT NULL
    GROUP BY row_id, rule_no HAVING count(*) = 1),
  by_rule AS (SELECT row_id, arg_min(candidate, rule_no) AS candidate FROM single GROUP BY row_id),
  answers AS (
    SELECT 'levenshtein' AS run_name, row_id, prediction AS answer FROM chosen
    UNION ALL SELECT 'ratio', row_id, candidate FROM by_ratio
    UNION ALL SELECT 'cascade', row_id, candidate FROM by_rule
    UNION ALL SELECT 'cascade', row_id, candidate FROM by_ratio WHERE row_id NOT IN (SELECT row_id FROM by_rule)),
  judged AS (
    SELECT run_name, error_type, entity_type, CASE WHEN negative THEN (answer IS NULL)::INT
      ELSE coalesce(answer = ground_truth, false)::INT END AS correct
    FROM (SELECT l.*, unnest(['levenshtein', 'ratio', 'cascade']) AS run_name FROM labelled l) LEFT JOIN answers USING (run_name, row_id)),
  g AS (SELECT run_name, error_type, entity_type, count(*)::BIGINT AS n, avg(correct) AS accuracy FROM judged
    GROUP BY GROUPING SETS ((run_name), (run_name, error_type), (run_name, entity_type)))
  SELECT run_name, CASE WHEN error_type IS NOT NULL THEN 'accuracy_error_' ||
      replace(replace(lower(error_type), ' ', '_'), '-', '_')
    WHEN entity_type IS NOT NULL THEN 'accuracy_entity_' || lower(entity_type) ELSE 'accuracy_overall' END AS metric,
    n AS rows, accuracy FROM g""")
def accuracy_of_scorers(spark, sf):
    """All three scorers as one job."""
    configs = [_lev(), ev.RunConfig("ratio"), ev.RunConfig("cascade", "cascade")]
    return ev.accuracy_by(ev.predictions(_rows(spark, sf), configs))


@query(f"""WITH {_PREDICTED_SQL}
  SELECT 'levenshtein' AS run_name, 'none.txt' AS prompt_file, {K}::BIGINT AS num_distractors, {SEED}::BIGINT AS seed,
    0.85::DOUBLE AS similarity_threshold, (SELECT count(*) FROM pool)::BIGINT AS candidate_pool_size,
    (SELECT count(*) FROM predicted)::BIGINT AS rows, (SELECT avg(correct) FROM predicted) AS accuracy_overall,
    CASE WHEN error_type IS NULL THEN 'entity_type' ELSE 'error_type' END AS kind, coalesce(error_type, entity_type) AS cell,
    avg(correct) AS accuracy FROM predicted GROUP BY GROUPING SETS ((error_type), (entity_type))""")
def run_summary(spark, sf):
    rows = _rows(spark, sf)
    summary = ev.run_summary(ev.predictions(rows, [_lev()]), rows, [_lev()])
    maps = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"accuracy_by_{k}").alias("cells")) for k in ("error_type", "entity_type")])
    summary = summary.withColumn("m", F.explode(maps))
    return summary.select(
        "run_name", "prompt_file", F.col("num_distractors").cast("bigint").alias("num_distractors"),
        F.col("seed").cast("bigint").alias("seed"), "similarity_threshold", "candidate_pool_size", "rows",
        "accuracy_overall", F.col("m.kind").alias("kind"), F.explode("m.cells").alias("cell", "accuracy"))


@query(f"""WITH {_OFFERS_SQL}
  SELECT row_id, replace(replace('{PROMPT}', '{{input_name}}', input_name), '{{candidates}}',
    string_agg(candidate, ' | ' ORDER BY cand_ord, candidate)) AS prompt
  FROM offered JOIN labelled USING (row_id) WHERE candidate <> input_name GROUP BY row_id, input_name""")
def prompt_requests(spark, sf):
    rows = _rows(spark, sf)
    offered = ev.offers(rows, _lev())
    return rq.prompt_requests(offered, ["row_id"], PROMPT).select("row_id", "prompt")


@query(f"""WITH {_OFFERS_SQL}
  SELECT row_id, CASE WHEN EXISTS (SELECT 1 FROM offered o WHERE o.row_id = l.row_id AND o.candidate = l.answer) THEN answer END AS match
  FROM (SELECT *, CASE length(input_name) % 6 WHEN 0 THEN input_name WHEN 2 THEN ground_truth WHEN 5 THEN ground_truth END AS answer
    FROM labelled) l""")
def accept_responses(spark, sf):
    """Echoed, null, bare, wrong, cut-off and right answers."""
    rows = _rows(spark, sf)
    answers = rows.select("row_id", _mixed_response().alias("response"))
    return rq.accept_responses(answers, ev.listed(rows, _lev()), ["row_id"]).select("row_id", "match")


def _mixed_response():
    kind = F.length("input_name") % 6
    return (
        F.when(kind == 0, F.to_json(F.struct(F.col("input_name").alias("match")))).when(kind == 1, '{"match": null}')
        .when(kind == 2, F.concat(F.lit('"'), "ground_truth", F.lit('"'))).when(kind == 3, "nobody of that name")
        .when(kind == 4, F.concat(F.lit('{"match": "'), "ground_truth"))
        .otherwise(F.to_json(F.struct(F.col("ground_truth").alias("match")))))


@query(f"""WITH {_OFFERS_SQL},
  answers AS (
    SELECT 'plain' AS run_name, l.*,
      CASE length(input_name) % 6 WHEN 0 THEN input_name WHEN 2 THEN ground_truth WHEN 5 THEN ground_truth END AS answer FROM labelled l
    UNION ALL SELECT 'terse', l.*, CASE length(input_name) % 2 WHEN 0 THEN ground_truth END FROM labelled l),
  predicted AS (
    SELECT a.*, CASE WHEN EXISTS (SELECT 1 FROM offered o WHERE o.row_id = a.row_id AND o.candidate = a.answer) THEN answer END AS prediction
    FROM answers a),
  judged AS (SELECT *, CASE WHEN negative THEN (prediction IS NULL)::INT ELSE coalesce(prediction = ground_truth, false)::INT END AS correct
    FROM predicted),
  g AS (SELECT run_name, error_type, entity_type, count(*)::BIGINT AS n, avg(correct) AS accuracy FROM judged
    GROUP BY GROUPING SETS ((run_name), (run_name, error_type), (run_name, entity_type)))
  SELECT run_name, CASE WHEN error_type IS NOT NULL THEN 'accuracy_error_' ||
      replace(replace(lower(error_type), ' ', '_'), '-', '_')
    WHEN entity_type IS NOT NULL THEN 'accuracy_entity_' || lower(entity_type) ELSE 'accuracy_overall' END AS metric,
    n AS rows, accuracy FROM g""")
def accuracy_of_prompts(spark, sf):
    """Answers to two prompts over the same draws: overall, by kind of error and of body."""
    rows = _rows(spark, sf)
    terse = F.when(F.length("input_name") % 2 == 0, F.to_json(F.struct(F.col("ground_truth").alias("match"))))
    responses = rows.select(F.lit("plain").alias("run_name"), "row_id", _mixed_response().alias("response")).union(
        rows.select(F.lit("terse"), "row_id", terse))
    runs = [ev.RunConfig("plain", prompt_file="plain.txt"), ev.RunConfig("terse", prompt_file="terse.txt")]
    return ev.accuracy_by(ev.predictions_from_responses(rows, responses, runs))


_MANIFEST_SQL = """SELECT o_orderpriority AS prompt_file, md5(o_custkey::VARCHAR) AS prompt_sha, o_orderstatus AS dataset_sha,
    20 AS num_distractors, year(o_orderdate) AS seed, 0.85::DOUBLE AS similarity_threshold"""


@query(f"""WITH manifest AS ({_MANIFEST_SQL}, o_orderkey FROM orders),
  ledger AS ({_MANIFEST_SQL} FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R' AND l_quantity > 40)
  SELECT o_orderkey, prompt_file, seed::BIGINT AS seed FROM manifest m WHERE NOT EXISTS (SELECT 1 FROM ledger l
    WHERE l.prompt_file = m.prompt_file AND l.prompt_sha = m.prompt_sha AND l.dataset_sha = m.dataset_sha
    AND l.num_distractors = m.num_distractors AND l.seed = m.seed AND l.similarity_threshold = m.similarity_threshold)""")
def pending_runs(spark, sf):
    def runs(df):
        return df.select(
            F.col("o_orderpriority").alias("prompt_file"), F.md5(F.col("o_custkey").cast("string").cast("binary")).alias("prompt_sha"),
            F.col("o_orderstatus").alias("dataset_sha"), F.lit(20).alias("num_distractors"),
            F.year("o_orderdate").alias("seed"), F.lit(0.85).alias("similarity_threshold"), "o_orderkey")

    orders = sh.table(spark, sf, "orders")
    done = sh.table(spark, sf, "lineitem").where("l_returnflag = 'R' and l_quantity > 40")
    ledger = runs(orders.join(done, orders.o_orderkey == done.l_orderkey))
    return not_yet_run(runs(orders), ledger, RUN_KEYS).select(
        "o_orderkey", "prompt_file", F.col("seed").cast("bigint").alias("seed"))


@query("""SELECT p_partkey, coalesce(nullif(trim(d), ''), replace(p_name, ' ', '_')) AS run_name FROM part
  LEFT JOIN (SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN ' ' ELSE s_name || ' ' END AS d FROM supplier)
  ON p_partkey = s_suppkey""")
def run_names(spark, sf):
    runs = sh.table(spark, sf, "part").select(
        "p_partkey", F.col("p_partkey").alias("run_key"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".txt")).alias("prompt_file"))
    described = sh.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("run_key"),
        F.when(F.col("s_acctbal") > 5000, " ").otherwise(F.concat("s_name", F.lit(" "))).alias("run_name"))
    return with_default(runs, described, "run_key", "run_name", file_stem()).select("p_partkey", "run_name")
