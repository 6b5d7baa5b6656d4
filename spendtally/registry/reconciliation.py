"""Contracts against spend reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregates import count_unique, first_non_null, latest_per_group, sum_or_zero, with_group_max
from ..operators.joins import attach_supplier_key, explode_join, filter_prefixes
from ..operators.matchers import LevenshteinMatcher
from ..plans import line_level as ll
from ..plans import reconcile as rc
from ..plans import summary as sm
from ..sources.tables import shared_table
from . import shapes as sh
from .book import Book

query = Book()


def _keyed(spark, sf):
    return rc.key_contracts(sh.contracts(spark, sf), sh.regkeys(spark, sf)), rc.key_mi(sh.mi(spark, sf))


# ---- line level --------------------------------------------------------------

_LATEST_SQL = """
latest AS (
  SELECT *, CASE WHEN max(contract_start) OVER (PARTITION BY buyer, suppliers) = contract_start
    THEN 1 ELSE 0 END AS newest FROM contracts),
recent AS (SELECT * FROM latest WHERE newest = 1)
"""
_FIRSTS = ["contract_end", "contract_months", "award_value", "framework_title", "source",
           "contract_title", "latest_employees", "awarded", "contract_description"]
_ROLL_SQL = ",\n".join(
    f"first({c} ORDER BY match_pass, contract_ord, mi_ord) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    for c in _FIRSTS)


def _rolled_sql(joined: str) -> str:
    return f"""
    rolled AS (
      SELECT buyer, suppliers, max(contract_start) AS contract_start,
        coalesce(sum(spend), 0) AS spend, {_ROLL_SQL},
        first(customer_group ORDER BY match_pass, contract_ord, mi_ord, customer_group)
          FILTER (WHERE customer_group IS NOT NULL) AS customer_group
      FROM {joined} GROUP BY buyer, suppliers),
    lines AS (
      SELECT *, (2000 - year(contract_start)) * 12 + (1 - month(contract_start)) AS months_run,
        coalesce(contract_end < DATE '2000-01-01', false) AS expired FROM rolled)
    """


_JOIN1 = """joined AS (
  SELECT c.*, 1 AS match_pass, m.mi_ord, m.spend, m.customer_group
  FROM recent c LEFT JOIN mi_keyed m ON c.pair_id IS NOT DISTINCT FROM m.mi_pair)"""
_LINE_COLS = """
  SELECT buyer, suppliers, contract_start::VARCHAR AS contract_start, contract_end::VARCHAR AS contract_end,
    contract_months::BIGINT AS contract_months, award_value::DOUBLE AS award_value, spend::DOUBLE AS spend,
    framework_title, source, contract_title, latest_employees::BIGINT AS latest_employees, customer_group,
    awarded::VARCHAR AS awarded, contract_description, months_run::BIGINT AS months_run, expired FROM lines"""
_EXACT_LINES = f"WITH {sh.DOMAIN_SQL}, {_LATEST_SQL}, {_JOIN1}, {_rolled_sql('joined')}"

# second pass: best Levenshtein similarity of at least .85, by brute force
_MATCH_SQL = """
first_seen AS (SELECT buyer, min(contract_ord) AS cand_ord FROM contracts GROUP BY buyer),
unmatched AS (SELECT * FROM mi_keyed m
  WHERE NOT EXISTS (SELECT 1 FROM contracts c WHERE c.pair_id IS NOT DISTINCT FROM m.mi_pair)),
unknown AS (SELECT * FROM unmatched u WHERE NOT EXISTS (SELECT 1 FROM first_seen b WHERE b.buyer = u.customer_name)),
asked AS (SELECT DISTINCT customer_name FROM unknown),
scored AS (
  SELECT customer_name, buyer, cand_ord,
    1.0::DOUBLE - levenshtein(lower(customer_name), lower(buyer))::DOUBLE
      / greatest(length(customer_name), length(buyer))::DOUBLE AS score
  FROM asked CROSS JOIN first_seen),
name_map AS (
  SELECT customer_name, buyer AS matched, score FROM scored WHERE score >= 0.85
  QUALIFY row_number() OVER (PARTITION BY customer_name ORDER BY score DESC, cand_ord) = 1),
remapped AS (
  SELECT u.*, matched, coalesce(mi_supplier_key::VARCHAR, '<NA>') || '+' || lower(matched) AS new_pair
  FROM unknown u JOIN name_map USING (customer_name))
"""
_JOIN2 = """joined AS (
  SELECT c.*, 1 AS match_pass, m.mi_ord, m.spend, m.customer_group
  FROM recent c LEFT JOIN mi_keyed m ON c.pair_id IS NOT DISTINCT FROM m.mi_pair
  UNION ALL
  SELECT c.*, 2, m.mi_ord, m.spend, m.customer_group FROM recent c JOIN remapped m ON c.pair_id = m.new_pair)"""
_TWO_PASS_LINES = f"WITH {sh.DOMAIN_SQL}, {_LATEST_SQL}, {_MATCH_SQL}, {_JOIN2}, {_rolled_sql('joined')}"


def _line_columns(df):
    return df.select(
        "buyer", "suppliers", sh.text_date("contract_start"), sh.text_date("contract_end"),
        F.col("contract_months").cast("bigint").alias("contract_months"), sh.money("award_value"),
        F.col("EvidencedSpend").cast("double").alias("spend"), "framework_title", "source", "contract_title",
        F.col("latest_employees").cast("bigint").alias("latest_employees"),
        F.col("CustomerGroup").alias("customer_group"), sh.text_date("awarded"), "contract_description",
        F.col("months_run").cast("bigint").alias("months_run"), "expired")


@query(_EXACT_LINES + _LINE_COLS)
def line_level(spark, sf):
    c, m = _keyed(spark, sf)
    return _line_columns(ll.line_level(c, m, sh.AS_OF))


@query(_EXACT_LINES + _LINE_COLS)
def line_level_from_combined(spark, sf):
    c, m = _keyed(spark, sf)
    c, m = c.drop("SupplierCompanyRegistrationNumber", "contract_supplier_key"), m.select("PairID", "mi_ord", "CustomerGroup", "EvidencedSpend")
    return _line_columns(ll.line_level_from_combined(rc.reconcile_exact(c, m), sh.AS_OF))


@query(_TWO_PASS_LINES + _LINE_COLS)
def line_level_two_pass(spark, sf):
    c, m = _keyed(spark, sf)
    return _line_columns(ll.line_level(c, m, sh.AS_OF, LevenshteinMatcher()))


@query(f"""WITH {sh.DOMAIN_SQL}, {_LATEST_SQL},
  ties AS (SELECT buyer, suppliers, pair_id, max(contract_start) AS contract_start FROM recent GROUP BY ALL)
  SELECT buyer, suppliers, contract_start::VARCHAR AS contract_start, coalesce(sum(spend), 0)::DOUBLE AS spend
  FROM ties LEFT JOIN mi_keyed ON pair_id IS NOT DISTINCT FROM mi_pair GROUP BY ALL""")
def line_level_ties_once(spark, sf):
    c, m = _keyed(spark, sf)
    return ll.line_level(c, m, sh.AS_OF, dedupe_ties=True).select(
        "buyer", "suppliers", sh.text_date("contract_start"), F.col("EvidencedSpend").cast("double").alias("spend"))


@query(_EXACT_LINES + """
  SELECT buyer, suppliers, spend::DOUBLE AS spend, spend > 0 AS has_spend, spend = 0 AS no_spend,
    expired AND spend = 0 AS red, NOT expired AND months_run > 3 AND spend = 0 AS amber FROM lines""")
def red_amber_flags(spark, sf):
    from ..functions.status import has_spend, no_spend

    c, m = _keyed(spark, sf)
    return ll.add_flags(ll.line_level(c, m, sh.AS_OF)).select(
        "buyer", "suppliers", F.col("EvidencedSpend").cast("double").alias("spend"),
        has_spend("EvidencedSpend").alias("has_spend"), no_spend("EvidencedSpend").alias("no_spend"),
        "red", "amber")


@query(_EXACT_LINES + """
  SELECT buyer AS "Contracting Authority", suppliers AS "Supplier", award_value::DOUBLE AS "Award Value",
    contract_start::VARCHAR AS "Contract Start Date", contract_end::VARCHAR AS "Contract End Date",
    contract_months::BIGINT AS "Contract Duration (Months)", customer_group AS "Customer Group",
    months_run::BIGINT AS "Total Months Run So Far", expired AS "Expired", spend::DOUBLE AS "EvidencedSpend", framework_title, source,
    contract_title, contract_description, awarded::VARCHAR AS awarded, latest_employees::BIGINT AS latest_employees FROM lines""")
def line_level_labels(spark, sf):
    c, m = _keyed(spark, sf)
    out = ll.line_level(c, m, sh.AS_OF).withColumns({
        **{x: F.col(x).cast("double") for x in ("award_value", "EvidencedSpend")},
        **{x: F.col(x).cast("string") for x in ("contract_start", "contract_end", "awarded")},
        **{x: F.col(x).cast("bigint") for x in ("contract_months", "months_run", "latest_employees")}})
    return ll.with_report_labels(out)


# ---- joins -------------------------------------------------------------------

_PAIR_COLS = """contract_ord::BIGINT AS contract_ord, buyer, suppliers, contract_supplier_key::BIGINT AS contract_supplier_key,
    pair_id, mi_ord::BIGINT AS mi_ord, mi_supplier_key::BIGINT AS mi_supplier_key, customer_name,
    customer_group, financial_year::BIGINT AS financial_year, financial_month::BIGINT AS financial_month,
    spend::DOUBLE AS spend"""


def _joined_columns(spark, sf):
    """Both sides with the columns that a row of the joined table shows, so that no others are written."""
    c, m = _keyed(spark, sf)
    return (c.select("contract_ord", "buyer", "suppliers", "contract_supplier_key", "PairID"),
            m.drop("SupplierName"))


def _pair_columns(df, *more):
    return df.select(
        "contract_ord", "buyer", "suppliers", "contract_supplier_key", F.col("PairID").alias("pair_id"), "mi_ord",
        "mi_supplier_key", F.col("CustomerName").alias("customer_name"),
        F.col("CustomerGroup").alias("customer_group"),
        F.col("FinancialYear").cast("bigint").alias("financial_year"),
        F.col("FinancialMonth").cast("bigint").alias("financial_month"),
        F.col("EvidencedSpend").cast("double").alias("spend"), *more)


@query(f"""WITH {sh.DOMAIN_SQL}
  SELECT {_PAIR_COLS} FROM contracts LEFT JOIN mi_keyed ON pair_id IS NOT DISTINCT FROM mi_pair""")
def reconcile_exact(spark, sf):
    c, m = _joined_columns(spark, sf)
    return _pair_columns(rc.reconcile_exact(c, m))


@query(f"""WITH {sh.DOMAIN_SQL}, {_MATCH_SQL}
  SELECT {_PAIR_COLS}, NULL::VARCHAR AS matched_name, 1::BIGINT AS match_pass
  FROM contracts LEFT JOIN mi_keyed ON pair_id IS NOT DISTINCT FROM mi_pair
  UNION ALL
  SELECT {_PAIR_COLS}, matched AS matched_name, 2::BIGINT AS match_pass
  FROM contracts LEFT JOIN remapped ON pair_id = new_pair""")
def reconcile_two_pass(spark, sf):
    c, m = _joined_columns(spark, sf)
    out = rc.reconcile_two_pass(c, m, LevenshteinMatcher())
    return _pair_columns(out, F.col("AIMatchedName").alias("matched_name"),
                         F.col("match_pass").cast("bigint").alias("match_pass"))


_MI_COLS = """mi_ord::BIGINT AS mi_ord, supplier_name, mi_supplier_key::BIGINT AS mi_supplier_key, customer_name,
    customer_group, mi_pair, spend::DOUBLE AS spend"""


def _mi_columns(df, *more):
    return df.select(
        "mi_ord", F.col("SupplierName").alias("supplier_name"), "mi_supplier_key",
        F.col("CustomerName").alias("customer_name"), F.col("CustomerGroup").alias("customer_group"),
        F.col("PairID").alias("mi_pair"), F.col("EvidencedSpend").cast("double").alias("spend"), *more)


@query(f"""WITH {sh.DOMAIN_SQL} SELECT {_MI_COLS} FROM mi_keyed m
  WHERE EXISTS (SELECT 1 FROM contracts c WHERE c.pair_id IS NOT DISTINCT FROM m.mi_pair)""")
def matched_mi(spark, sf):
    c, m = _keyed(spark, sf)
    return _mi_columns(rc.matched_mi(m, c))


@query(f"""WITH {sh.DOMAIN_SQL} SELECT {_MI_COLS} FROM mi_keyed m
  WHERE NOT EXISTS (SELECT 1 FROM contracts c WHERE c.pair_id IS NOT DISTINCT FROM m.mi_pair)""")
def unmatched_mi(spark, sf):
    c, m = _keyed(spark, sf)
    return _mi_columns(rc.unmatched_mi(m, c))


@query(f"""WITH {sh.DOMAIN_SQL}, {_MATCH_SQL}
  SELECT {_MI_COLS}, CASE WHEN EXISTS (SELECT 1 FROM first_seen b WHERE b.buyer = customer_name)
    THEN 'known buyer' ELSE 'unknown name' END AS reason FROM unmatched""")
def split_unmatched(spark, sf):
    c, m = _keyed(spark, sf)
    known, unknown = rc.split_unmatched(rc.unmatched_mi(m, c), c)
    return _mi_columns(known, F.lit("known buyer").alias("reason")).unionByName(
        _mi_columns(unknown, F.lit("unknown name").alias("reason")))


@query(f"WITH {sh.DOMAIN_SQL}, {_MATCH_SQL} SELECT customer_name, matched AS matched_name FROM name_map")
def name_map(spark, sf):
    c, m = _keyed(spark, sf)
    return rc.name_map(m, c, LevenshteinMatcher()).select(
        F.col("CustomerName").alias("customer_name"), F.col("AIMatchedName").alias("matched_name"))


@query(f"""WITH {sh.DOMAIN_SQL}, {_MATCH_SQL}
  SELECT {_MI_COLS}, matched AS matched_name FROM mi_keyed LEFT JOIN name_map USING (customer_name)""")
def apply_name_map(spark, sf):
    c, m = _keyed(spark, sf)
    mapping = rc.name_map(m, c, LevenshteinMatcher())
    return _mi_columns(rc.apply_name_map(m, mapping), F.col("AIMatchedName").alias("matched_name"))


@query(f"WITH {sh.DOMAIN_SQL}, {_MATCH_SQL} SELECT {_MI_COLS} FROM unmatched WHERE EXISTS (SELECT 1 FROM unknown)")
def residual_reference(spark, sf):
    c, m = _keyed(spark, sf)
    return _mi_columns(rc.residual_mi(c, m))


@query(f"""WITH {sh.DOMAIN_SQL}, {_MATCH_SQL}
  SELECT {_MI_COLS} FROM unmatched u LEFT JOIN name_map USING (customer_name)
  WHERE NOT EXISTS (SELECT 1 FROM contracts c
    WHERE c.pair_id = coalesce(u.mi_supplier_key::VARCHAR, '<NA>') || '+' || lower(matched))""")
def residual_strict(spark, sf):
    c, m = _keyed(spark, sf)
    names, index = rc.reduced_mi(m), rc.reduced_contracts(c)
    mapping = rc.name_map(names, index, LevenshteinMatcher())
    return _mi_columns(rc.residual_mi(index, m, mapping, "strict", names))


# ---- summary -----------------------------------------------------------------

@query(_EXACT_LINES + """,
  unmatched AS (SELECT * FROM mi_keyed m
    WHERE NOT EXISTS (SELECT 1 FROM contracts c WHERE c.pair_id IS NOT DISTINCT FROM m.mi_pair)),
  one AS (SELECT
    (SELECT count(*) FROM contracts) AS a, (SELECT count(*) FROM lines) AS b, (SELECT count(*) FROM unmatched) AS c,
    (SELECT count(*) FROM (SELECT DISTINCT supplier_name FROM unmatched)) AS d,
    (SELECT count(*) FROM (SELECT DISTINCT customer_name FROM unmatched)) AS e,
    (SELECT count(*) FROM lines WHERE spend > 0) AS f,
    (SELECT count(*) FROM lines WHERE expired AND spend = 0) AS g,
    (SELECT count(*) FROM lines WHERE NOT expired AND months_run > 3 AND spend = 0) AS h)
  SELECT 1::BIGINT AS position, 'Total Contracts' AS statistic, a::BIGINT AS value FROM one
  UNION ALL SELECT 2, 'Total Contracts with Supplier Key', b FROM one
  UNION ALL SELECT 3, 'Unmatched MI Entries', c FROM one
  UNION ALL SELECT 4, 'Unique Unmatched Suppliers', d FROM one
  UNION ALL SELECT 5, 'Unique Unmatched Buyers', e FROM one
  UNION ALL SELECT 6, 'Total Contracts with Spend', f FROM one
  UNION ALL SELECT 7, 'Total Contracts No Spend and Expired', g FROM one
  UNION ALL SELECT 8, 'Total Contracts No Spend and Running >3 Months', h FROM one""")
def summary_stats(spark, sf):
    raw = sh.contracts(spark, sf)
    # both are read twice
    c, m = map(shared_table, _keyed(spark, sf))
    index = rc.reduced_contracts(c)
    stats = sm.summary_stats(raw, ll.line_level(c, m, sh.AS_OF, spent=True), sm.unmatched_profile(index, m))
    return stats.select(F.col("position").cast("bigint").alias("position"),
                        F.col("Summary Statistic").alias("statistic"), F.col("Value").alias("value"))


# ---- operators on the plain tables -------------------------------------------

@query("""SELECT l_suppkey, l_linenumber::BIGINT AS l_linenumber, l_orderkey, l_shipdate::DATE::VARCHAR AS ship_day
  FROM lineitem QUALIFY rank() OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY l_shipdate DESC) = 1""")
def latest_row_per_group(spark, sf):
    li = sh.table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", "l_orderkey", "l_shipdate")
    return latest_per_group(li, ["l_suppkey", "l_linenumber"], "l_shipdate").select(
        "l_suppkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_orderkey",
        F.col("l_shipdate").cast("date").cast("string").alias("ship_day"))


@query("""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_suppkey, l_extendedprice,
  max(l_extendedprice) OVER (PARTITION BY l_suppkey) AS top_price FROM lineitem""")
def group_max(spark, sf):
    li = sh.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    return with_group_max(li, ["l_suppkey"], "l_extendedprice", "top_price").withColumn(
        "l_linenumber", F.col("l_linenumber").cast("bigint"))


@query("""SELECT l_suppkey, first(nullif(l_returnflag, 'N') ORDER BY l_orderkey, l_linenumber, l_returnflag)
    FILTER (WHERE l_returnflag <> 'N') AS first_flag,
  coalesce(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0)::DOUBLE AS returned,
  (count(DISTINCT nullif(l_returnflag, 'N')) + max(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END))::BIGINT AS flags
  FROM lineitem GROUP BY l_suppkey""")
def first_non_null_and_sums(spark, sf):
    li = sh.table(spark, sf, "lineitem").withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice").cast("decimal(18,2)"))
    return li.groupBy("l_suppkey").agg(
        first_non_null("flag", F.struct("l_orderkey", "l_linenumber", "flag")).alias("first_flag"),
        sum_or_zero(returned).cast("double").alias("returned"),
        count_unique("flag").cast("bigint").alias("flags"))


def _null_join_sides(spark, sf):
    # one or two suppliers a number, and two without: the join grows with the customers
    number = F.concat(F.lit("N"), F.floor(F.col("s_suppkey") / 2).cast("string"))
    reg = F.when(F.col("s_suppkey") > 2, number)
    keys = sh.table(spark, sf, "supplier").select(
        reg.alias("SupplierCompanyRegistrationNumber"), F.col("s_suppkey").alias("SupplierKey"))
    creg = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("N"), F.floor(F.col("c_custkey") / 20).cast("string")))
    left = sh.table(spark, sf, "customer").select(creg.alias("SupplierCompanyRegistrationNumber"), "c_custkey")
    return left, keys


_NULL_JOIN_SQL = """SELECT c.c_custkey, c.reg AS reg_no, s.s_suppkey AS supplier_key FROM
  (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'N' || (c_custkey // 20) END AS reg FROM customer) c
  JOIN (SELECT s_suppkey, CASE WHEN s_suppkey > 2 THEN 'N' || (s_suppkey // 2) END AS reg FROM supplier) s
  ON c.reg {op} s.reg"""


@query(_NULL_JOIN_SQL.format(op="IS NOT DISTINCT FROM"))
def null_safe_join(spark, sf):
    left, keys = _null_join_sides(spark, sf)
    return attach_supplier_key(left, keys).select(
        "c_custkey", F.col("SupplierCompanyRegistrationNumber").alias("reg_no"),
        F.col("SupplierKey").alias("supplier_key"))


@query(_NULL_JOIN_SQL.format(op="="))
def null_key_drop(spark, sf):
    left, keys = _null_join_sides(spark, sf)
    return attach_supplier_key(left, keys, null_keys="drop").select(
        "c_custkey", F.col("SupplierCompanyRegistrationNumber").alias("reg_no"),
        F.col("SupplierKey").alias("supplier_key"))


@query("""WITH lists AS (
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 7 THEN NULL WHEN l_quantity = 50 THEN '[]'
      ELSE '[' || l_suppkey || ',"' || l_partkey || '"]' END AS supplier_ids FROM lineitem),
  ids AS (SELECT * EXCLUDE (supplier_ids), unnest(from_json(supplier_ids, '["VARCHAR"]')) AS id FROM lists)
  SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, s_suppkey AS supplier_id, s_name
  FROM ids JOIN supplier ON id::BIGINT = s_suppkey""")
def json_explode_join(spark, sf):
    number, text = F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string")
    ids = F.when(F.col("l_linenumber") == 7, None).when(F.col("l_quantity") == 50, "[]").otherwise(
        F.concat(F.lit("["), number, F.lit(',"'), text, F.lit('"]')))
    lists = sh.table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", ids.alias("supplier_ids"))
    dim = sh.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("supplier_id"), "s_name")
    return explode_join(lists, "supplier_ids", dim, "supplier_id").drop("supplier_ids")


@query("""SELECT p_partkey, p_brand FROM part WHERE p_brand LIKE 'Brand#10%' OR p_brand LIKE 'Brand#11%'
  OR p_brand LIKE 'Brand#12%' OR p_brand LIKE 'Brand#13%' OR p_brand LIKE 'Brand#14%'""")
def prefix_filter(spark, sf):
    part = sh.table(spark, sf, "part")
    return filter_prefixes(part, "p_brand", [f"Brand#1{i}" for i in range(5)]).select("p_partkey", "p_brand")


@query("SELECT p_partkey, p_brand FROM part WHERE p_brand LIKE 'Brand#1%'")
def prefix_filter_single(spark, sf):
    return filter_prefixes(sh.table(spark, sf, "part"), "p_brand", ["Brand#1"]).select("p_partkey", "p_brand")


@query(f"""WITH {sh.DOMAIN_SQL}
  SELECT 'contracts' AS table_name, count(*)::BIGINT AS row_count FROM contracts
  UNION ALL SELECT 'spend reports', count(*) FROM mi
  UNION ALL SELECT 'registration keys', count(*) FROM supplier""")
def row_counts(spark, sf):
    from ..operators.aggregates import row_counts as counted

    return counted({"contracts": sh.contracts(spark, sf), "spend reports": sh.mi(spark, sf),
                    "registration keys": sh.regkeys(spark, sf)})
