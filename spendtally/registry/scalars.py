"""Text, key, date and money functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, keys, text
from ..operators.aggregates import fingerprint as table_fingerprint
from ..sources.tables import normalise_na
from . import shapes as sh
from .book import Book

query = Book()


def _line_id():
    return [F.col("l_orderkey"), F.col("l_linenumber").cast("bigint").alias("l_linenumber"), F.col("l_partkey")]


_LINE_ID = "l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey"


@query(f"""SELECT {_LINE_ID}, CASE l_linenumber WHEN 5 THEN NULL ELSE l_suppkey END AS supplier_key,
  coalesce(CASE l_linenumber WHEN 5 THEN NULL ELSE l_suppkey END::VARCHAR, '<NA>') || '+' ||
    lower(CASE WHEN l_quantity < 50 THEN 'Buyer ' || l_returnflag END) AS pair_id FROM lineitem""")
def nullable_key_and_pair_id(spark, sf):
    n = F.col("l_linenumber")
    raw = F.col("l_suppkey").cast("string")
    on_file = F.when(n == 5, "NaN").when(n % 2 == 0, F.concat(raw, F.lit(".0"))).otherwise(raw)
    key = keys.nullable_key(on_file)
    buyer = F.when(F.col("l_quantity") < 50, F.concat(F.lit("Buyer "), "l_returnflag"))
    return sh.table(spark, sf, "lineitem").select(
        *_line_id(), key.alias("supplier_key"), keys.pair_id(key, buyer).alias("pair_id"))


@query(f"""SELECT {_LINE_ID}, CASE WHEN l_linenumber IN (1, 2, 3) THEN NULL
    WHEN l_linenumber = 4 THEN 'none' ELSE l_returnflag END AS token,
  CASE WHEN l_linenumber IN (1, 2, 3) THEN '' WHEN l_linenumber = 4 THEN 'none' ELSE l_returnflag END AS filled
  FROM lineitem""")
def na_tokens(spark, sf):
    n = F.col("l_linenumber")
    raw = F.when(n == 1, "").when(n == 2, "N/A").when(n == 3, "nan").when(n == 4, "none").otherwise(F.col("l_returnflag"))
    df = sh.table(spark, sf, "lineitem").select(*_line_id(), raw.alias("token"), raw.alias("filled"))
    return normalise_na(normalise_na(df, ["token"]), ["filled"], fill="")


@query("""SELECT c_custkey,
  replace(trim(split_part(raw, '(', 1)), '&', 'and') AS group_key, trim(raw) AS trimmed,
  lower(trim(raw)) AS folded FROM (
  SELECT c_custkey, '  ' || c_mktsegment || CASE WHEN c_acctbal > 5000 THEN ' & Sons' ELSE '' END
    || CASE WHEN c_nationkey < 12 THEN ' (' || c_name || ')' ELSE '' END || '  ' AS raw FROM customer)""")
def buyer_normalise(spark, sf):
    raw = F.concat(
        F.lit(" \t"), "c_mktsegment", F.when(F.col("c_acctbal") > 5000, " & Sons").otherwise(""),
        F.when(F.col("c_nationkey") < 12, F.concat(F.lit(" ("), "c_name", F.lit(")"))).otherwise(""), F.lit(" \n"))
    return sh.table(spark, sf, "customer").select(
        "c_custkey", text.buyer_group_key(raw).alias("group_key"), text.trim_all(raw).alias("trimmed"),
        F.lower(text.trim_all(raw)).alias("folded"))


@query(f"""SELECT {_LINE_ID}, CASE l_linenumber WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN NULL
    ELSE 'Supplier ' || l_suppkey END AS prediction,
  l_linenumber = 6 OR l_returnflag = 'N' AS negative FROM lineitem""")
def clean_prediction(spark, sf):
    n, name = F.col("l_linenumber"), F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string"))
    raw = (
        F.when(n == 1, F.concat(F.lit('"'), name, F.lit(' "'))).when(n == 2, F.concat(F.lit(" '"), name, F.lit("'")))
        .when(n == 4, " N/A ").when(n == 5, '"').when(n == 6, "None").otherwise(name)
    )
    error_type = F.when(F.col("l_returnflag") == "N", " Negative control - spurious").otherwise("Typo")
    truth = F.when(n == 6, " N/A").otherwise(name)
    return sh.table(spark, sf, "lineitem").select(
        *_line_id(), text.clean_prediction(raw).alias("prediction"),
        text.is_negative_control(error_type, truth).alias("negative"))


@query("""SELECT p_partkey, replace(replace(lower(p_name || '-' || p_type), ' ', '_'), '-', '_') AS slug,
  CASE WHEN p_partkey % 2 = 1 THEN '-' ELSE '' END || '£' || format('{:,.2f}', p_retailprice) AS price_text
  FROM part""")
def slug_and_currency(spark, sf):
    signed = F.when(F.col("p_partkey") % 2 == 1, -F.col("p_retailprice")).otherwise(F.col("p_retailprice"))
    return sh.table(spark, sf, "part").select(
        "p_partkey", text.metric_slug(F.concat_ws("-", "p_name", "p_type")).alias("slug"),
        text.pounds(signed).alias("price_text"))


@query("""SELECT s_suppkey, 'Dear ' || s_name || ',' || chr(10) || chr(10) || 'We are writing to you regarding your agreement with '
  || n_name || '. Please can you check your records for any unreported spend.' || chr(10) || chr(10) || 'Best regards,'
  || chr(10) || 'Contract Team' AS letter FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def draft_letter(spark, sf):
    s, n = sh.table(spark, sf, "supplier"), sh.table(spark, sf, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        "s_suppkey", text.draft_letter("s_name", "n_name", "Contract Team").alias("letter"))


_KEY_SQL = """
  trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({x}), '&', ' and ', 'g'), '[''.]', '', 'g'),
    '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"""
_RAW_SQL = """SELECT p_partkey, CASE WHEN p_size > 40 THEN upper(p_name) WHEN p_size > 30 THEN p_name || ' & Co.'
    WHEN p_size > 20 THEN 'St. ' || p_name || '''s' ELSE p_name END
  || CASE WHEN p_size % 3 = 0 THEN ' (' || p_brand || ')' ELSE ' ' || p_brand END
  || CASE WHEN p_size % 5 = 0 THEN ' Ltd' WHEN p_size % 5 = 1 THEN '  PLC' WHEN p_size % 5 = 2 THEN ' Limited' ELSE '' END
  AS raw FROM part"""


@query(f"""WITH r AS ({_RAW_SQL}), k AS (SELECT p_partkey, raw, {_KEY_SQL.format(x='raw')} AS name_key,
    {_KEY_SQL.format(x="regexp_replace(raw, '[(][^)]*[)]', ' ', 'g')")} AS bracket_key FROM r)
  SELECT p_partkey, name_key, bracket_key,
    regexp_replace(bracket_key, '( (limited liability partnership|limited|ltd|plc|llp|alb))+$', '') AS suffix_key FROM k""")
def name_keys(spark, sf):
    size = F.col("p_size")
    raw = F.concat(
        F.when(size > 40, F.upper("p_name")).when(size > 30, F.concat("p_name", F.lit(" & Co.")))
        .when(size > 20, F.concat(F.lit("St. "), "p_name", F.lit("'s"))).otherwise(F.col("p_name")),
        F.when(size % 3 == 0, F.concat(F.lit(" ("), "p_brand", F.lit(")"))).otherwise(F.concat(F.lit(" "), "p_brand")),
        F.when(size % 5 == 0, " Ltd").when(size % 5 == 1, "  PLC").when(size % 5 == 2, " Limited").otherwise(""))
    return sh.table(spark, sf, "part").select(
        "p_partkey", text.name_key(raw).alias("name_key"), text.bracket_key(raw).alias("bracket_key"),
        text.suffix_key(raw).alias("suffix_key"))


_START = "o_orderdate::DATE"
_END = "(o_orderdate::DATE + to_months((6 * (1 + o_orderkey % 6))::INT))::DATE"
_M = "((year({b}) - year({a})) * 12 + month({b}) - month({a}))::BIGINT"


@query(f"""SELECT o_orderkey, {_M.format(a='s', b="DATE '2000-01-01'")} AS months_run,
  {_M.format(a='s', b="least(e, DATE '2000-01-01')")} AS months_capped,
  e < DATE '2000-01-01' AS expired_before, e <= DATE '2000-01-01' AS expired_on FROM (
  SELECT o_orderkey, {_START} AS s, {_END} AS e FROM orders)""")
def contract_dates(spark, sf):
    start_text = F.date_format("o_orderdate", "yyyy-M-d")
    df = sh.table(spark, sf, "orders").select(
        "o_orderkey", dates.parse_day(start_text).alias("s"),
        (6 * (1 + F.col("o_orderkey") % 6)).cast("int").alias("m")).withColumn("e", F.add_months("s", "m"))
    return df.select(
        "o_orderkey", dates.months_run("s", sh.AS_OF).cast("bigint").alias("months_run"),
        dates.months_run_capped("s", "e", sh.AS_OF).cast("bigint").alias("months_capped"),
        dates.expired("e", sh.AS_OF).alias("expired_before"),
        dates.expired("e", sh.AS_OF, inclusive=True).alias("expired_on"))


_FP_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_FP_PARTS = ", ".join(f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in _FP_COLS)


@query(f"""WITH d AS (SELECT md5(concat_ws('|', {_FP_PARTS})) AS h FROM orders)
  SELECT count(*)::BIGINT AS row_count,
    sum(('0x' || substr(h, 1, 15))::BIGINT::HUGEINT)::VARCHAR AS digest_a,
    sum(('0x' || substr(h, 16, 15))::BIGINT::HUGEINT)::VARCHAR AS digest_b FROM d""")
def fingerprint(spark, sf):
    return table_fingerprint(sh.table(spark, sf, "orders"), _FP_COLS)


@query("SELECT doc_id, sha256(text) AS text_sha FROM documents")
def text_sha256(spark, sf):
    return sh.table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha"))
