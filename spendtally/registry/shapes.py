"""The driver's order tables seen as contracts, spend reports and names.

Every order is a contract award with the suppliers of its lines; every line is
a spend report.  Names are dirtied by line number, some keys and spends are
missing.  Whole tables throughout.  The SQL text next to each shape says the
same for the SQL check.

Lines and orders both grow with the data, so neither is left to be broadcast
on a size guess: those joins ask for a sort-merge join.  Suppliers are counted, and sent to the lines if they are few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import sent_if_short

AS_OF = "2000-01-01"

# Declared, so that no job is spent on reading file footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

AWARDS_SQL = """
buyers AS (
  SELECT c_custkey, n_name || ' ' || c_mktsegment AS buyer, c_mktsegment
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
awards AS (
  SELECT o_orderkey, buyer, o_orderdate::DATE AS contract_start,
    6 * (1 + o_orderkey % 6) AS contract_months,
    (o_orderdate::DATE + to_months((6 * (1 + o_orderkey % 6))::INT))::DATE AS contract_end,
    o_orderdate::DATE AS awarded, 'Order ' || o_orderkey || ', ' || o_orderpriority AS contract_description,
    CAST(o_totalprice AS DECIMAL(18,2)) AS award_value, o_orderpriority AS framework_title,
    o_orderstatus AS source, 'Contract ' || o_orderkey AS contract_title
  FROM orders JOIN buyers ON o_custkey = c_custkey)
"""
CONTRACTS_SQL = AWARDS_SQL + """,
contracts AS (
  SELECT a.*, o_orderkey * 100000000 + s_suppkey AS contract_ord, s_name AS suppliers,
    'R' || lpad(s_suppkey::VARCHAR, 6, '0') AS reg_no,
    CASE WHEN s_acctbal > 0 THEN floor(s_acctbal)::INT END AS latest_employees,
    s_suppkey AS contract_supplier_key, s_suppkey || '+' || lower(buyer) AS pair_id
  FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) l
  JOIN awards a ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey)
"""
MI_SQL = """
mi AS (
  SELECT l_orderkey * 8 + l_linenumber AS mi_ord, s_name AS supplier_name,
    CASE WHEN l_quantity < 50 THEN l_suppkey END AS mi_supplier_key,
    CASE l_linenumber WHEN 1 THEN upper(buyer) WHEN 2 THEN buyer || ' LTD'
      WHEN 3 THEN substr(buyer, 1, 2) || substr(buyer, 4) WHEN 4 THEN buyer || ' (HQ)'
      ELSE buyer END AS customer_name,
    CASE WHEN l_returnflag <> 'N' THEN c_mktsegment || ' ' || l_returnflag END AS customer_group,
    year(l_shipdate)::INT AS financial_year, month(l_shipdate)::INT AS financial_month,
    CASE WHEN l_linestatus = 'O' THEN 0 WHEN l_returnflag = 'R' THEN NULL
      ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS spend
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN buyers ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey),
mi_keyed AS (
  SELECT *, coalesce(mi_supplier_key::VARCHAR, '<NA>') || '+' || lower(customer_name) AS mi_pair FROM mi)
"""
DOMAIN_SQL = CONTRACTS_SQL + "," + MI_SQL
PART_NAMES_SQL = """
names AS (SELECT DISTINCT p_name || ' ' || p_brand || ' ' || lower(p_type) AS name FROM part)
"""

_KEY_SQL = """trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({x}), '&', ' and ', 'g'),
    '[''.]', '', 'g'), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"""
NAME_KEY_SQL = _KEY_SQL.format(x="{x}")
BRACKET_KEY_SQL = _KEY_SQL.format(x="regexp_replace({x}, '[(][^)]*[)]', ' ', 'g')")
SUFFIX_KEY_SQL = ("regexp_replace(" + BRACKET_KEY_SQL
                  + ", '( (limited liability partnership|limited|ltd|plc|llp|alb))+$', '')")
_RATIOS_SQL = """
close AS (SELECT DISTINCT p, q FROM offered WHERE {near}),
parts AS (
  SELECT p, q, p AS x, q AS y, 0 AS m FROM close
  UNION ALL
  SELECT p, q, CASE side WHEN 'l' THEN substr(x, 1, i - 1) ELSE substr(x, i + k) END AS x,
    CASE side WHEN 'l' THEN substr(y, 1, strpos(y, substr(x, i, k)) - 1) ELSE substr(y, strpos(y, substr(x, i, k)) + k) END AS y,
    CASE side WHEN 'l' THEN k ELSE 0 END AS m
  FROM (
    SELECT p, q, x, y, longest[1] AS k, -longest[2] AS i FROM (
      SELECT *, list_max(list_transform(range(1, length(x) + 1), lambda i:
        [coalesce(list_max(list_filter(range(1, length(x) - i + 2), lambda k: contains(y, substr(x, i, k)))), 0), -i])) AS longest
      FROM parts WHERE x <> '' AND y <> '') WHERE longest[1] > 0), (SELECT unnest(['l', 'r']) AS side)),
ratios AS (SELECT p, q, 2.0::DOUBLE * sum(m) / (length(p) + length(q)) AS ratio FROM parts GROUP BY p, q)
"""


def ratios_sql(near: str = "levenshtein(p, q) <= 0.15 * (length(p) + length(q)) + 1e-6") -> str:
    """The matching-blocks ratio of the pairs (p, q) of ``offered`` that are near, by default those that may reach 0.85.

    The longest common run, the first of equals in p and then in q, and again what lies to its left and to its right.
    Needs WITH RECURSIVE.
    """
    return _RATIOS_SQL.replace("{near}", near)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def buyers(spark, sf) -> DataFrame:
    nation = table(spark, sf, "nation")
    customer = table(spark, sf, "customer")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", F.concat_ws(" ", "n_name", "c_mktsegment").alias("buyer"), "c_mktsegment")


def awards(spark, sf) -> DataFrame:
    orders = table(spark, sf, "orders")
    b = buyers(spark, sf)
    start = F.col("o_orderdate").cast("date")
    months = (6 * (1 + F.col("o_orderkey") % 6)).cast("int")
    return orders.join(b, orders.o_custkey == b.c_custkey).select(
        "o_orderkey", "buyer", start.alias("contract_start"), months.alias("contract_months"),
        F.add_months(start, months).alias("contract_end"), start.alias("awarded"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("award_value"),
        F.col("o_orderpriority").alias("framework_title"), F.col("o_orderstatus").alias("source"),
        F.concat(F.lit("Contract "), F.col("o_orderkey").cast("string")).alias("contract_title"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(", "), "o_orderpriority")
        .alias("contract_description"),
    )


def reg_no():
    return F.concat(F.lit("R"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0"))


def regkeys(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").select(
        reg_no().alias("SupplierCompanyRegistrationNumber"), F.col("s_suppkey").alias("SupplierKey"))


def contracts(spark, sf) -> DataFrame:
    """One contract per order and supplier; ``contract_ord`` is unique for up to 100 million suppliers.

    Lines are shuffled once, by order: rows that are apart by it are distinct, and the join finds them so.
    """
    pairs = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey").repartition("l_orderkey").distinct()
    supplier = table(spark, sf, "supplier")
    a = awards(spark, sf)
    employees = F.when(F.col("s_acctbal") > 0, F.floor("s_acctbal").cast("int"))
    return (
        pairs.join(a.hint("merge"), pairs.l_orderkey == a.o_orderkey)
        .join(sent_if_short(supplier), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(*[c for c in a.columns if c != "o_orderkey"], F.col("s_name").alias("suppliers"),
                reg_no().alias("SupplierCompanyRegistrationNumber"),
                employees.alias("latest_employees"),
                (F.col("o_orderkey") * 100_000_000 + F.col("s_suppkey")).alias("contract_ord"))
    )


def mi(spark, sf) -> DataFrame:
    """One spend row per order line; equal ``mi_ord`` values are possible."""
    line, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    supplier = table(spark, sf, "supplier")
    b = buyers(spark, sf)
    owner = orders.join(b, orders.o_custkey == b.c_custkey).select("o_orderkey", "buyer", "c_mktsegment")
    n = F.col("l_linenumber")
    name = (
        F.when(n == 1, F.upper("buyer")).when(n == 2, F.concat("buyer", F.lit(" LTD")))
        .when(n == 3, F.expr("concat(substr(buyer, 1, 2), substr(buyer, 4))"))
        .when(n == 4, F.concat("buyer", F.lit(" (HQ)"))).otherwise(F.col("buyer"))
    )
    spend = (
        F.when(F.col("l_linestatus") == "O", F.lit(0).cast("decimal(18,2)"))
        .when(F.col("l_returnflag") == "R", F.lit(None))
        .otherwise(F.col("l_extendedprice").cast("decimal(18,2)"))
    )
    return (
        line.join(owner.hint("merge"), line.l_orderkey == owner.o_orderkey)
        .join(sent_if_short(supplier.select("s_suppkey", "s_name")), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            (F.col("l_orderkey") * 8 + n).alias("mi_ord"), F.col("s_name").alias("SupplierName"),
            F.when(F.col("l_quantity") < 50, F.col("l_suppkey").cast("string")).alias("SupplierKey"),
            name.alias("CustomerName"),
            F.when(F.col("l_returnflag") != "N", F.concat_ws(" ", "c_mktsegment", "l_returnflag"))
            .alias("CustomerGroup"),
            F.year("l_shipdate").alias("FinancialYear"), F.month("l_shipdate").alias("FinancialMonth"),
            spend.alias("EvidencedSpend"))
    )


def part_names(spark, sf) -> DataFrame:
    """Distinct descriptive part names, used as organisation names: ``(name)``."""
    return table(spark, sf, "part").select(
        F.concat_ws(" ", "p_name", "p_brand", F.lower("p_type")).alias("name")).distinct()


def text_date(col: str):
    return F.col(col).cast("string").alias(col)


def money(col: str):
    return F.col(col).cast("double").alias(col)
