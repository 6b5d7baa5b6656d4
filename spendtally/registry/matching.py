"""Name matching over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..functions.json_text import response_match
from ..operators.joins import keep_valid
from ..operators.matchers import CascadeMatcher, LevenshteinMatcher, RatioMatcher, RuleMatcher
from . import shapes as sh
from .book import Book

query = Book()


def _names(spark, sf):
    return sh.part_names(spark, sf)


def _candidates(spark, sf):
    return _names(spark, sf).select(F.col("name").alias("candidate"), F.col("name").alias("cand_ord"))


def _result(df):
    return df.select("name", "match", F.round("score", 9).alias("score"), "rule")


# ---- similarity --------------------------------------------------------------

_MISSPELT = "substr(name, 1, 2) || substr(name, 4)"


@query(f"""WITH {sh.PART_NAMES_SQL}, asked AS (SELECT DISTINCT {_MISSPELT} AS name FROM names),
  scored AS (SELECT a.name, n.name AS match, 1.0::DOUBLE - levenshtein(lower(a.name), lower(n.name))::DOUBLE
      / greatest(length(a.name), length(n.name))::DOUBLE AS score
    FROM asked a CROSS JOIN names n WHERE a.name <> n.name)
  SELECT name, match, round(score, 9) AS score, 'levenshtein' AS rule FROM scored WHERE score >= 0.85
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY score DESC, match) = 1""")
def fuzzy_levenshtein(spark, sf):
    asked = _names(spark, sf).select(F.expr("concat(substr(name, 1, 2), substr(name, 4))").alias("name")).distinct()
    return _result(LevenshteinMatcher()(asked, _candidates(spark, sf)))


@query(f"""WITH RECURSIVE {sh.PART_NAMES_SQL}, asked AS (SELECT DISTINCT {_MISSPELT} AS name FROM names),
  offered AS (SELECT a.name, n.name AS match, lower(a.name) AS p, lower(n.name) AS q
    FROM asked a CROSS JOIN names n WHERE a.name <> n.name), {sh.ratios_sql()}
  SELECT name, match, round(ratio, 9) AS score, 'ratio' AS rule FROM offered JOIN ratios USING (p, q) WHERE ratio >= 0.85
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY ratio DESC, match) = 1""")
def fuzzy_ratio(spark, sf):
    asked = _names(spark, sf).select(F.expr("concat(substr(name, 1, 2), substr(name, 4))").alias("name")).distinct()
    return _result(RatioMatcher()(asked, _candidates(spark, sf)))


@query(f"""WITH {sh.AWARDS_SQL}, b AS (SELECT DISTINCT buyer FROM buyers),
  asked AS (SELECT DISTINCT upper(substr(buyer, 1, length(buyer) - 1)) AS name FROM b),
  scored AS (SELECT name, buyer AS match, 1.0::DOUBLE - levenshtein(lower(name), lower(buyer))::DOUBLE
      / greatest(length(name), length(buyer))::DOUBLE AS score FROM asked CROSS JOIN b WHERE name <> buyer)
  SELECT name, match, round(score, 9) AS score, 'levenshtein' AS rule FROM scored WHERE score >= 0.7
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY score DESC, match) = 1""")
def fuzzy_low_threshold(spark, sf):
    b = sh.buyers(spark, sf).select("buyer").distinct()
    asked = b.select(F.expr("upper(substr(buyer, 1, length(buyer) - 1))").alias("name")).distinct()
    cands = b.select(F.col("buyer").alias("candidate"), F.col("buyer").alias("cand_ord"))
    return _result(LevenshteinMatcher(threshold=0.7)(asked, cands))


@query(f"""WITH RECURSIVE {sh.PART_NAMES_SQL}, asked AS (SELECT DISTINCT upper(p_type) || ' ' || p_name AS name FROM part),
  cands AS (SELECT DISTINCT p_name || ' ' || lower(p_type) AS candidate FROM part),
  offered AS (SELECT name, candidate, lower(name) AS p, candidate AS q FROM asked CROSS JOIN cands WHERE name <> candidate),
  edits AS (SELECT a.name, n.name AS candidate, 1.0::DOUBLE - levenshtein(lower(a.name), lower(n.name))::DOUBLE
      / greatest(length(a.name), length(n.name))::DOUBLE AS score FROM asked a CROSS JOIN names n),
  {sh.ratios_sql("true")},
  scored AS (SELECT 'levenshtein' AS rule, name, candidate, score FROM edits
    UNION ALL SELECT 'ratio', name, candidate, ratio FROM offered JOIN ratios USING (p, q))
  SELECT rule, name, candidate AS match, round(score, 9) AS score FROM scored WHERE score >= 0.4
  QUALIFY row_number() OVER (PARTITION BY rule, name ORDER BY score DESC, candidate) = 1""")
def fuzzy_any_threshold(spark, sf):
    """Type before name against name before type: best matches far below what a surviving piece can find."""
    part = sh.table(spark, sf, "part")
    asked = part.select(F.concat(F.upper("p_type"), F.lit(" "), "p_name").alias("name")).distinct()
    short = part.select(F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("candidate")).distinct()
    edits = LevenshteinMatcher(0.4)(asked, _candidates(spark, sf))
    blocks = RatioMatcher(0.4)(asked, short.withColumn("cand_ord", F.col("candidate")))
    return _result(edits.unionByName(blocks))


# ---- rules -------------------------------------------------------------------

def _equal_rule_sql(dirty: str, key: str, rule: str) -> str:
    return f"""WITH {sh.PART_NAMES_SQL}, asked AS (SELECT DISTINCT {dirty} AS name FROM names),
      hits AS (SELECT a.name, n.name AS match FROM asked a JOIN names n
        ON {key.replace('{x}', 'a.name')} = {key.replace('{x}', 'n.name')} AND a.name <> n.name)
      SELECT name, min(match) AS match, 1.0::DOUBLE AS score, '{rule}' AS rule FROM hits
      GROUP BY name HAVING count(DISTINCT match) = 1"""


def _rule(spark, sf, dirty, *rules):
    asked = _names(spark, sf).select(dirty.alias("name")).distinct()
    return _result(RuleMatcher(rules)(asked, _candidates(spark, sf)))


@query(_equal_rule_sql("upper(replace(name, ' ', '  ')) || '.'", sh.NAME_KEY_SQL, "normalised"))
def normalised_match(spark, sf):
    return _rule(spark, sf, F.concat(F.upper(F.replace("name", F.lit(" "), F.lit("  "))), F.lit(".")), "normalised")


@query(_equal_rule_sql("name || ' (' || upper(substr(name, 1, 3)) || ')'", sh.BRACKET_KEY_SQL, "brackets"))
def bracket_match(spark, sf):
    tag = F.concat(F.lit(" ("), F.upper(F.substring("name", 1, 3)), F.lit(")"))
    return _rule(spark, sf, F.concat("name", tag), "brackets")


@query(_equal_rule_sql("CASE WHEN length(name) % 2 = 0 THEN name || ' Ltd' ELSE name || ' PLC' END", sh.SUFFIX_KEY_SQL, "suffix"))
def suffix_match(spark, sf):
    form = F.when(F.length("name") % 2 == 0, " Ltd").otherwise(" PLC")
    return _rule(spark, sf, F.concat("name", form), "suffix")


@query(f"""WITH {sh.PART_NAMES_SQL}, keyed AS (SELECT name, {sh.NAME_KEY_SQL.replace('{x}', 'name')} AS k FROM names),
  c AS (SELECT name AS match, upper(array_to_string(list_transform(string_split(k, ' '), lambda w: substr(w, 1, 1)), '')) AS acronym
    FROM keyed),
  asked AS (SELECT DISTINCT lower(acronym) AS name FROM c)
  SELECT name, min(match) AS match, 1.0::DOUBLE AS score, 'acronym' AS rule FROM asked JOIN c ON upper(name) = acronym
  GROUP BY name HAVING count(DISTINCT match) = 1""")
def acronym_match(spark, sf):
    letters = F.array_join(F.transform(F.split(text.name_key("name"), " "), lambda w: F.substring(w, 1, 1)), "")
    return _rule(spark, sf, letters, "acronym")


@query(f"""WITH {sh.PART_NAMES_SQL}, asked AS (SELECT DISTINCT 'national ' || name || ' body' AS name FROM names),
  a AS (SELECT name, list_distinct(string_split({sh.SUFFIX_KEY_SQL.replace('{x}', 'name')}, ' ')) AS nt FROM asked),
  c AS (SELECT name AS match, list_distinct(string_split({sh.SUFFIX_KEY_SQL.replace('{x}', 'name')}, ' ')) AS ct FROM names),
  fits AS (SELECT name, match, len(ct) AS fit FROM a JOIN c ON list_has_all(nt, ct) AND len(ct) < len(nt)),
  best AS (SELECT name, match FROM fits QUALIFY fit = max(fit) OVER (PARTITION BY name))
  SELECT name, min(match) AS match, 1.0::DOUBLE AS score, 'descriptor' AS rule FROM best GROUP BY name HAVING count(*) = 1""")
def descriptor_match(spark, sf):
    return _rule(spark, sf, F.concat(F.lit("national "), "name", F.lit(" body")), "descriptor")


@query(f"""WITH {sh.PART_NAMES_SQL},
  k AS (SELECT name, {sh.SUFFIX_KEY_SQL.replace('{x}', 'name')} AS k FROM names),
  asked AS (SELECT DISTINCT substr(k, strpos(k, ' ') + 1) AS name FROM k),
  hits AS (SELECT a.name, k.name AS match FROM asked a JOIN k ON {sh.SUFFIX_KEY_SQL.replace('{x}', 'a.name')} <> k.k
    AND (starts_with(k.k, a.name || ' ') OR ends_with(k.k, ' ' || a.name)))
  SELECT name, min(match) AS match, 1.0::DOUBLE AS score, 'shortened' AS rule FROM hits GROUP BY name
  HAVING count(DISTINCT match) = 1""")
def shortened_match(spark, sf):
    k = text.suffix_key("name")
    return _rule(spark, sf, F.substr(k, F.instr(k, " ") + 1), "shortened")


@query(f"""WITH {sh.PART_NAMES_SQL},
  aliases AS (SELECT DISTINCT 'old ' || p_name || ' ' || p_brand AS alias, p_name || ' ' || p_brand || ' ' || lower(p_type) AS candidate FROM part),
  known AS (SELECT alias, min(candidate) AS match FROM aliases GROUP BY alias HAVING count(DISTINCT candidate) = 1)
  SELECT upper(alias) AS name, match, 1.0::DOUBLE AS score, 'alias' AS rule FROM known""")
def alias_match(spark, sf):
    aliases = sh.table(spark, sf, "part").select(
        F.concat_ws(" ", F.lit("old"), "p_name", "p_brand").alias("alias"),
        F.concat_ws(" ", "p_name", "p_brand", F.lower("p_type")).alias("candidate")).distinct()
    asked = aliases.select(F.upper("alias").alias("name")).distinct()
    return _result(RuleMatcher(("alias",), aliases)(asked, _candidates(spark, sf)))


_LINKS = (
    ("'once ' || b", "name", "true"), ("'twice ' || b", "'ONCE ' || b", "true"), ("'thrice ' || b", "'Twice: ' || b", "true"),
    ("'once ' || b", "'thrice ' || b", "length(b) % 5 = 0"), ("'lost ' || b", "'nowhere ' || b", "true"),
    ("'round ' || b", "'square ' || b", "true"), ("'square ' || b", "'round ' || b", "true"),
)
_ASKED = ("upper('thrice ' || b)", "'twice ' || b", "'lost ' || b", "'round ' || b")
_BRANDED = "p_name || ' ' || p_brand AS b, p_name || ' ' || p_brand || ' ' || lower(p_type) AS name"


@query(f"""WITH RECURSIVE {sh.PART_NAMES_SQL}, p AS (SELECT DISTINCT {_BRANDED} FROM part),
  links AS ({' UNION '.join(f"SELECT {sh.NAME_KEY_SQL.replace('{x}', a)} AS k, {sh.NAME_KEY_SQL.replace('{x}', c)} AS t FROM p WHERE {w}" for a, c, w in _LINKS)}),
  offered AS (SELECT {sh.NAME_KEY_SQL.replace('{x}', 'name')} AS k, name AS match FROM names),
  asked AS ({' UNION '.join(f"SELECT {a} AS name FROM p" for a in _ASKED)}),
  reach AS (SELECT name, t FROM asked JOIN links ON k = {sh.NAME_KEY_SQL.replace('{x}', 'name')}
    UNION SELECT name, l.t FROM reach r JOIN links l ON l.k = r.t WHERE r.t NOT IN (SELECT k FROM offered))
  SELECT name, min(match) AS match, 1.0::DOUBLE AS score, 'alias_chain' AS rule FROM reach JOIN offered ON t = k
  GROUP BY name HAVING count(DISTINCT match) = 1""")
def alias_chain_match(spark, sf):
    """Chains of two to three names, some with a way back, some with several ends, dead ends and plain cycles."""
    parts = sh.table(spark, sf, "part").selectExpr(*_BRANDED.split(", ")).distinct()
    links = None
    for alias, candidate, when in _LINKS:
        some = parts.where(when).selectExpr(f"{alias} AS alias", f"{candidate} AS candidate")
        links = some if links is None else links.union(some)
    asked = parts.select(F.explode(F.expr(f"array({', '.join(_ASKED)})")).alias("name")).distinct()
    return _result(RuleMatcher(("alias_chain",), links)(asked, _candidates(spark, sf)))


_DIRTY_SQL = """CASE length(name) % 4 WHEN 0 THEN upper(name) WHEN 1 THEN name || ' (UK) Ltd'
    WHEN 2 THEN substr(name, 1, 2) || substr(name, 4) ELSE name || ' public body' END"""


def _dirty_names(spark, sf):
    """Every kind of dirt at once."""
    size = F.pmod(F.length("name"), F.lit(4))
    dirty = (
        F.when(size == 0, F.upper("name")).when(size == 1, F.concat("name", F.lit(" (UK) Ltd")))
        .when(size == 2, F.expr("concat(substr(name, 1, 2), substr(name, 4))"))
        .otherwise(F.concat("name", F.lit(" public body"))))
    return _names(spark, sf).select(dirty.alias("name")).distinct()


_RULED_SQL = f"""{sh.PART_NAMES_SQL}, asked AS (SELECT DISTINCT {_DIRTY_SQL} AS name FROM names),
  a AS (SELECT name, {sh.NAME_KEY_SQL.replace('{x}', 'name')} AS k1, {sh.BRACKET_KEY_SQL.replace('{x}', 'name')} AS k2,
    {sh.SUFFIX_KEY_SQL.replace('{x}', 'name')} AS k3 FROM asked),
  c AS (SELECT name AS match, {sh.NAME_KEY_SQL.replace('{x}', 'name')} AS k1, {sh.BRACKET_KEY_SQL.replace('{x}', 'name')} AS k2,
    {sh.SUFFIX_KEY_SQL.replace('{x}', 'name')} AS k3 FROM names),
  fits AS (SELECT name, match, len(list_distinct(string_split(c.k3, ' '))) AS fit FROM a JOIN c
    ON list_has_all(string_split(a.k3, ' '), string_split(c.k3, ' '))
      AND len(list_distinct(string_split(c.k3, ' '))) < len(list_distinct(string_split(a.k3, ' ')))),
  hits AS (
    SELECT 1 AS rule_no, 'normalised' AS rule, name, match FROM a JOIN c USING (k1) WHERE name <> match
    UNION ALL SELECT 2, 'brackets', name, match FROM a JOIN c USING (k2) WHERE name <> match
    UNION ALL SELECT 3, 'suffix', name, match FROM a JOIN c USING (k3) WHERE name <> match
    UNION ALL SELECT 6, 'descriptor', name, match FROM fits QUALIFY fit = max(fit) OVER (PARTITION BY name)
    UNION ALL SELECT 7, 'shortened', name, match FROM a JOIN c
      ON starts_with(c.k3, a.k3 || ' ') OR ends_with(c.k3, ' ' || a.k3)),
  single AS (SELECT rule_no, rule, name, min(match) AS match FROM hits GROUP BY rule_no, rule, name
    HAVING count(DISTINCT match) = 1),
  ruled AS (SELECT name, match, 1.0::DOUBLE AS score, rule FROM single
    QUALIFY row_number() OVER (PARTITION BY name ORDER BY rule_no) = 1)"""


@query(f"""WITH RECURSIVE {_RULED_SQL},
  offered AS (SELECT a.name, n.name AS match, lower(a.name) AS p, lower(n.name) AS q
    FROM asked a CROSS JOIN names n WHERE a.name <> n.name AND a.name NOT IN (SELECT name FROM ruled)), {sh.ratios_sql()}
  SELECT name, match, score, rule FROM ruled
  UNION ALL
  SELECT name, match, round(ratio, 9), 'ratio' FROM offered JOIN ratios USING (p, q) WHERE ratio >= 0.85
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY ratio DESC, match) = 1""")
def rule_cascade(spark, sf):
    """Rules first, matching-blocks ratio for the rest."""
    return _result(CascadeMatcher()(_dirty_names(spark, sf), _candidates(spark, sf)))


@query(f"""WITH {_RULED_SQL},
  scored AS (SELECT a.name, n.name AS match, 1.0::DOUBLE - levenshtein(lower(a.name), lower(n.name))::DOUBLE
      / greatest(length(a.name), length(n.name))::DOUBLE AS score
    FROM asked a CROSS JOIN names n WHERE a.name <> n.name AND a.name NOT IN (SELECT name FROM ruled))
  SELECT name, match, score, rule FROM ruled
  UNION ALL
  SELECT name, match, round(score, 9), 'levenshtein' FROM scored WHERE score >= 0.85
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY score DESC, match) = 1""")
def rules_then_levenshtein(spark, sf):
    matcher = CascadeMatcher((RuleMatcher(), LevenshteinMatcher()))
    return _result(matcher(_dirty_names(spark, sf), _candidates(spark, sf)))


# ---- answers -----------------------------------------------------------------

@query("""SELECT event_id, CASE WHEN event_type IN ('click', 'purchase') THEN user_id::VARCHAR
    WHEN event_type IN ('error', 'signup') THEN NULL ELSE props END AS answer FROM events""")
def parse_response(spark, sf):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    response = (
        F.when(kind == "click", F.concat(F.lit('{"match": " '), user, F.lit(' ", "raw": 1}')))
        .when(kind == "purchase", F.concat(F.lit('"'), user, F.lit('"')))
        .when(kind == "error", '{"match": null}').when(kind == "signup", " N/A ")
        .otherwise(F.col("props")))
    return sh.table(spark, sf, "events").select("event_id", response_match(response).alias("answer"))


@query("""WITH offer AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS offered FROM events GROUP BY user_id)
  SELECT event_id, array_to_string(list_filter(offered, lambda x: x <> event_type), ' | ') AS other_offers,
    CASE WHEN value > 10 THEN event_type END AS valid FROM events JOIN offer USING (user_id)""")
def offer_and_validate(spark, sf):
    ev = sh.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    offer = ev.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("offered"))
    answer = F.when(F.col("value") > 10, F.col("event_type")).otherwise("somebody else")
    return ev.join(offer, "user_id").select(
        "event_id", F.array_join(text.offer_without_input("offered", "event_type"), " | ").alias("other_offers"),
        text.valid_answer(answer, "offered").alias("valid"))


@query("""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey FROM lineitem l
  WHERE EXISTS (SELECT 1 FROM orders o JOIN supplier s ON s_nationkey = o_custkey % 25
    WHERE o_orderkey = l_orderkey AND s_suppkey = l_suppkey)""")
def validate_match(spark, sf):
    orders, supplier = sh.table(spark, sf, "orders"), sh.table(spark, sf, "supplier")
    # an order offers the suppliers of one nation: the answer's nation is looked up, not the offers listed
    offered = orders.select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 25).cast("long").alias("nation"))
    nations = supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("long").alias("nation"))
    answers = sh.table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey")
    return keep_valid(answers.join(nations, "l_suppkey"), offered, ["l_orderkey"], "nation").drop("nation")
